"""Session helpers: one place for the Spark settings the engine expects, and for the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def local_session(cpus: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and benches; clusters bring their own session."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("xmarket")
    builder = builder.config("spark.driver.memory", memory).config("spark.sql.shuffle.partitions", str(cpus))
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir of the session.

    Where it is unset, a local session gets a folder of its own; a cluster has no folder that can be guessed, so it's an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    set_now = spark.sparkContext._jsc.sc().getCheckpointDir()
    if set_now.isDefined():
        return set_now.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    own = os.path.join(tempfile.gettempdir(), f"xmarket-{uuid.uuid4().hex[:8]}")
    spark.sparkContext.setCheckpointDir(own)
    return spark.sparkContext._jsc.sc().getCheckpointDir().get().rstrip("/")


_open: list[list[DataFrame]] = []  # tables written inside scratch(), the innermost last


def written(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage at df: write it as a Parquet table in the shared folder and read it back.

    The table survives the loss of executors, unlike a cached or locally checkpointed frame.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.written_path = path
    if _open:
        _open[-1].append(table)
    return table


def discard(table: DataFrame) -> None:
    """Remove a table that written() made and that nothing reads any more."""
    spark = table.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(table.written_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def scratch() -> Iterator[None]:
    """Remove the tables written inside once the block has ended; what is kept must be written again outside of it."""
    _open.append([])
    try:
        yield
    finally:
        for table in _open.pop():
            discard(table)


def kept(make: Callable[[], DataFrame], label: str) -> DataFrame:
    """make()'s result as a written table; the tables that it wrote on its way are removed."""
    outer, made = len(_open), None
    with scratch():
        made = written(make(), label)
        _open[outer].pop()  # this one stays
    if _open:
        _open[-1].append(made)
    return made
