"""Near copies in a corpus: SimHash links first, MinHash bands for what a fingerprint can't reach, all links verified.

Two texts are near copies if the sets of their shingles of five words have a Jaccard similarity of 0.8 or more.
At 0.8 the 64 bits of two SimHash fingerprints differ in about ten places, far outside any radius whose balls can
be shuffled, so the operator's exact links within three bits find the closer copies only.  What they leave apart
meets in one of BANDS bands of ROWS MinHash values each: 1 - (1 - s^5)^20 of the pairs of similarity s, 0.9996 at 0.8.

Nodes are distinct texts (64-bit hash of the text).  No link counts before it is verified on the texts' sets of
shingle hashes: a failed candidate joins nothing, and cuts nothing off.  Candidates are the SimHash links, texts of
one fingerprint, and in every bucket its smallest text with each of the others; heads that many texts are compared
with are dealt to several tasks, and a comparison holds one head's hashes and streams the others.  A bucket whose texts are
then in one component is done.  The texts of the others are compared in blocks: BLOCK texts against BLOCK texts as a product
of 0/1 matrices, of which only a spanning forest of the new links comes out.  So no pair of a bucket is left out
and none is written; the work of blocks grows with the square of the texts of a bucket that no link has joined.

Defined results: a null or wordless text has no shingles and is like any other such text; fewer words than a shingle
give one shingle; rows with a null id take part, and count as greater than any id; repeated rows are copies of each
other; extra columns, whatever their names, are kept by keep_first(); an empty table gives an empty result.  Whole texts
are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xmarket.llm.simhash import SEED, links, majority, shingle_hashes
from xmarket.llm.words import map_arrow
from xmarket.operators.graph import connected_components
from xmarket.session import written

BANDS, ROWS = 20, 5
COMPARISONS = 2000  # of one head in one task
BLOCK = 512
_COLUMNS = 4096
_PART = 1 << 9
_TIMES = np.random.default_rng(SEED).integers(0, 1 << 63, BANDS * ROWS, np.uint64) | np.uint64(1)
_XOR = np.random.default_rng(SEED + 1).integers(0, 1 << 63, BANDS * ROWS, np.uint64)


def shingle_set(text: str | None, shingle: int = 5) -> np.ndarray:
    """The distinct shingle hashes of a text in ascending order."""
    parts = list(shingle_hashes(text, shingle))
    return np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)


def similarity_of(x: np.ndarray, y: np.ndarray) -> float:
    """Jaccard similarity of two ascending arrays of distinct values; empty ones are alike."""
    if not len(x) or not len(y):
        return float(len(x) == len(y))
    short, long = (x, y) if len(x) <= len(y) else (y, x)
    both = int((long[np.minimum(np.searchsorted(long, short), len(long) - 1)] == short).sum())
    return both / (len(x) + len(y) - both)


def bands(hashes: np.ndarray) -> np.ndarray:
    """One number a band: the XXH64 value of the band's minima over the shingle hashes; equal sets have equal bands."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), _PART):
        least = np.minimum(least, ((hashes[at : at + _PART, None] ^ _XOR) * _TIMES).min(axis=0))
    return np.array([xxhash.xxh64_intdigest(part.tobytes(), k) for k, part in enumerate(least.reshape(BANDS, ROWS))], np.uint64)


def _text_key(text_col: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def _sketches(df: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(id, key, fp, bands) of every row."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps, flat = [], [np.zeros(0, np.uint64)]
        for text in batch.column(2).to_pylist():
            parts = list(shingle_hashes(text, shingle))
            fps.append(majority(parts))
            flat.append(bands(np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)))
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(fps) + 1, dtype=np.int32) * BANDS), pa.array(np.concatenate(flat).view(np.int64)))
        return pa.record_batch([batch.column(0), batch.column(1), pa.array(np.array(fps, np.uint64).view(np.int64)), lists], names=["id", "key", "fp", "bands"])

    keyed = df.select(F.col(id_col).alias("id"), _text_key(text_col).alias("key"), F.col(text_col).alias("text"))
    return map_arrow(keyed, run, f"id {kind}, key long, fp long, bands array<long>")


def _shingle_sets(df: DataFrame, text_col: str, keys: DataFrame, shingle: int) -> DataFrame:
    """(key, hashes binary) of the texts with these distinct keys, a written table (small ones are broadcast by its size)."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.record_batch([batch.column(0), pa.array([shingle_set(t, shingle).tobytes() for t in batch.column(1).to_pylist()], pa.binary())], names=["key", "hashes"])

    texts = df.select(_text_key(text_col).alias("key"), F.col(text_col).alias("text")).join(keys, "key", "left_semi").dropDuplicates(["key"])
    return map_arrow(texts, run, "key long, hashes binary")


def _verified(edges: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The distinct edges (a, b) whose shingle sets are similar; a is the head."""
    load = edges.groupBy("a").agg(F.count(F.lit(1)).alias("n")).select("a", F.ceil(F.col("n") / COMPARISONS).alias("parts"))
    heads = load.select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    heads = heads.join(sets, F.col("a") == F.col("key")).select("a", "part", F.lit(None).cast("long").alias("b"), "hashes")
    dealt = edges.join(load, "a").select("a", F.pmod(F.xxhash64("b", F.lit("part")), F.col("parts")).alias("part"), "b")
    others = dealt.join(sets, F.col("b") == F.col("key")).select("a", "part", "b", "hashes")
    rows = heads.unionByName(others).repartition("a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = None
        for batch in batches:
            found: list[tuple[int, int]] = []
            for a, b, hashes in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                own = np.frombuffer(hashes.as_buffer(), np.uint64)
                if b is None:
                    head = own.copy()
                elif min(len(own), len(head)) >= similarity * max(len(own), len(head)) and similarity_of(own, head) >= similarity:
                    found.append((a, b))
            if found:
                yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names=["a", "b"])

    return rows.select("a", "b", "hashes").mapInArrow(run, "a long, b long")


def _similar_forest(x: list[np.ndarray], y: list[np.ndarray], apart: np.ndarray, similarity: float) -> list[tuple[int, int]]:
    """(place in x, place in y) of a spanning forest of the similar pairs for which apart holds."""
    sizes = np.array([len(s) for s in x + y], np.int64)
    owner = np.repeat(np.arange(len(x) + len(y)), sizes)
    _, column, times = np.unique(np.concatenate(x + y), return_inverse=True, return_counts=True)
    shared = np.cumsum(times > 1) - 1  # what occurs once is in no intersection
    used = times[column] > 1
    owner, column = owner[used], shared[column[used]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    both = np.zeros((len(x), len(y)), np.float32)
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, _COLUMNS):
        lo, hi = np.searchsorted(column, [start, start + _COLUMNS])
        has = np.zeros((len(sizes), _COLUMNS), np.float32)
        has[owner[lo:hi], column[lo:hi] - start] = 1
        both += has[: len(x)] @ has[len(x) :].T
    both = both.astype(np.int64)  # exact: far below 2^24
    total = sizes[: len(x), None] + sizes[None, len(x) :]
    near = apart & ((total == 0) | (both / np.maximum(total - both, 1) >= similarity))
    root, out = list(range(len(sizes))), []

    def find(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    for i, j in np.argwhere(near).tolist():
        p, q = find(i), find(len(x) + j)
        if p != q:
            root[q] = p
            out.append((i, j))
    return out


def _in_blocks(members: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The links (a, b) between texts of one bucket (bucket, key, component) that are in different components."""
    size = members.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    dealt = members.join(size, "bucket").withColumn("block", F.pmod(F.xxhash64("key", F.lit("block")), F.col("blocks")).cast("int"))
    met = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(F.least("block", j).alias("i"), F.greatest("block", j).alias("j")))
    rows = dealt.join(sets, "key").select("bucket", "block", "key", "component", "hashes", F.explode(met).alias("t")).select("bucket", "t.i", "t.j", "block", "key", "component", "hashes")

    def close(task: tuple, held: list[tuple]) -> list[tuple[int, int]]:
        _, i, j = task
        left, right = [r for r in held if r[0] == i], [r for r in held if r[0] == j]
        if not left or not right:
            return []
        apart = np.array([r[2] for r in left])[:, None] != np.array([r[2] for r in right])[None, :]
        found = _similar_forest([r[3] for r in left], [r[3] for r in right], apart, similarity)
        return [(min(p, q), max(p, q)) for p, q in ((left[m][1], right[n][1]) for m, n in found)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, held, found = None, [], []
        for batch in batches:
            names = [batch.column(c).to_pylist() for c in range(6)]
            for bucket, i, j, block, key, component, hashes in zip(*names, batch.column(6), strict=True):
                if (bucket, i, j) != task:
                    if held:
                        found += close(task, held)
                    task, held = (bucket, i, j), []
                held.append((block, key, component, np.frombuffer(hashes.as_buffer(), np.uint64)))
            held = [(b, k, c, h.copy()) for b, k, c, h in held]
            if found:
                yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names=["a", "b"])
                found = []
        if held and (found := close(task, held)):
            yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names=["a", "b"])

    return rows.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j").mapInArrow(run, "a long, b long")


def _apart(members: DataFrame) -> DataFrame:
    """The rows (bucket, key, component) of buckets that hold more than one component."""
    mixed = members.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("bucket")
    return members.join(mixed, "bucket", "left_semi").select("bucket", "key", "component")


def _labelled(nodes: DataFrame, parts: DataFrame) -> DataFrame:
    """nodes with the column component: the node's own key where no link joins it to others."""
    return nodes.join(parts, F.col("key") == F.col("node"), "left").select(*nodes.columns, F.coalesce("component", "key").alias("component"))


def _texts_in_components(df: DataFrame, id_col: str, text_col: str, shingle: int, similarity: float) -> DataFrame:
    """(id, key, component) of every row."""
    rows = written(_sketches(df, id_col, text_col, shingle), "sketches")
    fps = written(rows.groupBy("fp").agg(F.min("key").alias("first")), "nodes")
    first = lambda fp, key: fps.select(F.col("fp").alias(fp), F.col("first").alias(key))
    linked = written(links(fps), "fingerprints").join(first("src", "b"), "src").join(first("dst", "a"), "dst").select("a", "b")
    texts = rows.groupBy("key").agg(F.first("fp").alias("fp"), F.first("bands").alias("bands"))  # a text's rows have the same
    same = texts.select("fp", F.col("key").alias("b")).join(first("fp", "a"), "fp").select("a", "b")

    buckets = texts.select("key", F.explode("bands").alias("bucket"))
    heads = buckets.groupBy("bucket").agg(F.min("key").alias("head"), F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket", "head")
    members = written(buckets.join(heads, "bucket"), "buckets")
    edges = linked.unionByName(same).unionByName(members.select(F.col("head").alias("a"), F.col("key").alias("b"))).where("a <> b")
    edges = written(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "candidates")
    keys = edges.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    sets = written(_shingle_sets(df, text_col, written(keys, "keys"), shingle), "sets")
    good = written(_verified(edges, sets, similarity), "links")
    parts = written(connected_components(good, "a", "b"), "components")

    left = written(_apart(_labelled(members.where("key <> head").select("bucket", "key"), parts)), "members")
    more = written(_in_blocks(left, sets, similarity), "links")
    if more.limit(1).count():
        parts = written(connected_components(good.unionByName(more), "a", "b"), "components")
    return _labelled(rows.select("id", "key"), parts)


def near_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """(id, component_id) of every row: the smallest id of its group of near copies, null if the group has null ids only."""
    rows = _texts_in_components(df, id_col, text_col, shingle, similarity)
    least = rows.groupBy("component").agg(F.min("id").alias("component_id"))
    return rows.join(least, "component").select(F.col("id").alias(id_col), "component_id")


def keep_first(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """One row of each group of near copies, unchanged: the one with the smallest id (null ids last).

    Rows of one id whose texts differ are told apart by the text; of rows alike in both, any one stays.
    """
    rows = written(_texts_in_components(df, id_col, text_col, shingle, similarity), "labels")
    least = rows.groupBy("component").agg(F.min(F.struct(F.col("id").isNull(), "id", "key")).alias("least"))
    every = rows.groupBy("id", "key", "component").agg(F.count(F.lit(1)).alias("n")).join(least, "component")
    is_first = F.col("id").eqNullSafe(F.col("least.id")) & (F.col("key") == F.col("least.key"))
    # narrow tables, broadcast if their size allows; texts move only beyond that, and those of rows that are alike
    gone = written(every.where(~is_first | (F.col("n") > 1)).select(F.col("id").alias("gone_id"), F.col("key").alias("gone_key"), is_first.alias("alike")), "gone")
    names = [f"c{i}" for i in range(len(df.columns))]  # given names may clash with those used here
    given = df.toDF(*names)
    at_id, at_text = (names[df.columns.index(c)] for c in (id_col, text_col))
    keyed = given.withColumn("key", _text_key(at_text))
    matches = F.col(at_id).eqNullSafe(F.col("gone_id")) & (F.col("key") == F.col("gone_key"))
    alone = keyed.join(gone, matches, "left_anti")
    alike = keyed.join(gone.where("alike"), matches, "left_semi").dropDuplicates([at_id, "key"])
    return alone.unionByName(alike).select(*names).toDF(*df.columns)
