"""Words and tables that several operators of this subpackage share."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: str | None) -> list[bytes]:
    """Maximal runs of bytes outside x20 and x09-x0D of the UTF-8 form: bytes.split() takes exactly these as space."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def hexdigest(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


SLICE_BYTES = 4 << 20

_caches: dict[int, tuple[object, Callable[[], None]]] = {}  # in this worker: what holds caches, and how to empty them


def using(holder: object | None, empty: Callable[[], None] | None = None) -> None:
    """Empty the caches of every other holder: a worker goes from stage to stage, and what an earlier one looked up is of no use to the next."""
    for key, (other, forget) in list(_caches.items()):
        if other is not holder:
            del _caches[key]
            forget()
            pa.default_memory_pool().release_unused()
    if holder is not None:
        _caches[id(holder)] = (holder, empty)


def slices(batch: pa.RecordBatch, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in parts of about `size` bytes, so that long texts don't become Python objects all at once."""
    step = max(1, min(batch.num_rows, batch.num_rows * size // max(1, batch.nbytes)))
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str, caches: Callable[[], tuple] | None = None) -> DataFrame:
    """Apply fn to slices of the Arrow batches of df.  Rows stay in their partition; nothing is shuffled.  caches: what using() gets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        using(*caches() if caches else (None,))
        for batch in batches:
            for part in slices(batch):
                out = fn(part)
                if out is not None and out.num_rows:
                    yield out

    return df.mapInArrow(run, schema)
