"""Substring dedup by prefix-partitioned suffix trees over words.

A window is WINDOW consecutive words.  A window whose word sequence also starts elsewhere is a repeat, and the
words it covers are removed.  Suffixes (one per word) are too many to shuffle with their contents, so they are
grouped without loss before any text moves:

1. *Anchors.*  Among the k-word prefixes of the suffixes that start inside a window, the one with the
   smallest hash is the window's anchor.  Equal windows have equal anchors, and neighbouring windows mostly
   share theirs, so a run of windows with one place of their anchor is one row (about one for twelve words).
2. *Groups.*  An anchor that occurs once in the corpus has no repeat and drops out (counts with partial sums, so
   a hot anchor is combined before the shuffle).  Runs of one anchor whose words are all alike (by hash) are one
   variant; a variant that occurs twice is a repeat as a whole, and needs no tree.  Anchor and variant are hashes of
   64 bits each.
3. *Trees.*  Where an anchor has several variants, one segment of text per variant goes to the anchor's group.
   Groups are packed into memory-sized chunks and each chunk builds the levels of its suffix tree by doubling:
   a node at depth d holds the suffixes that agree on d words, leaves are dropped, and nodes at depth WINDOW
   with two suffixes or more are the repeats.  Here words are compared exactly.
4. *Longer prefixes.*  A group with more than GROUP_LIMIT variants, more than one tree holds, is divided: the runs of
   its variants get new anchors with a prefix of twice the length, and pass through 1 to 3 again, until the group
   fits or the prefix is a whole window, where a group is one node of the tree.

Repeats go back to their documents as ranges of words.  Rows are known by a 64-bit hash of id and text.

Defined results: a null or empty text has no words; a text shorter than the window keeps all; rows repeated as a
whole count as two places, so a repeated text of WINDOW words or more is removed from all of them; ids may be
null; extra columns are ignored by ranges() and kept by deduplicate(); an empty table gives an empty result.  Whole
texts are read, whatever their length.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from xmarket.llm.words import map_arrow, words_of
from xmarket.session import written

WINDOW, PREFIX = 35, 12
GROUP_LIMIT = 5_000
HEAVY = 1_000
_CHUNK_WORDS, _SLICE_WORDS = 1_500_000, 400_000
_A, _B, _Q = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * _B
    return x ^ (x >> np.uint64(32))


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _mix(a * _A + (b ^ (b >> np.uint64(31))))


def _prefix_hashes(h: np.ndarray, length: int) -> np.ndarray:
    """Hash of the `length` words from each place, by doubling."""
    if len(h) < length:
        return h[:0]
    by, size, out, done = h, 1, None, 0
    while True:
        if length & size:
            out = by[: len(h) - length + 1] if out is None else _pair(out, by[done : done + len(h) - length + 1])
            done += size
        if done == length:
            return out
        by = _pair(by[:-size], by[size:])
        size *= 2


def _sliding_argmin(x: np.ndarray, width: int) -> np.ndarray:
    """For each place, where the leftmost smallest of the next `width` values is."""
    by, size = np.arange(len(x)), 1

    def lower(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.where(x[a] <= x[b], a, b)

    while size * 2 <= width:
        by = lower(by[:-size], by[size:])
        size *= 2
    n = len(x) - width + 1
    return lower(by[:n], by[width - size :][:n]) if size < width else by


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(_Q), -1, 1 << 64))
    up, down = np.full(n, _Q), np.full(n, inverse)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def runs(words: list[bytes], window: int = WINDOW, prefix: int = PREFIX) -> list[tuple[np.ndarray, ...]]:
    """Runs of windows with one anchor, in slices of bounded memory: (anchor, hash of all words, first window, windows)."""
    out = []
    for at in range(0, max(0, len(words) - window + 1), _SLICE_WORDS):
        h = word_hashes(words[at : at + _SLICE_WORDS + window - 1])
        prefixes = _prefix_hashes(h, prefix)
        place = _sliding_argmin(prefixes, window - prefix + 1)
        first = np.concatenate(([0], np.flatnonzero(place[1:] != place[:-1]) + 1))
        n = np.diff(np.append(first, len(place)))
        up, down = _powers(_SLICE_WORDS + window)
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_mix(h) * up[: len(h)])))
        whole = _mix((total[first + n + window - 1] - total[first]) * down[first])
        out.append((prefixes[place[first]], whole, first + at, n))
    return out


_RUN = "anchor long, whole long, key long, first int, n int"


def _run_rows(parts: list[tuple]) -> pa.RecordBatch:
    """Rows of _RUN from (key, anchor, whole, first, n)."""
    key, anchor, whole, first, n = (np.concatenate(c) for c in zip(*parts, strict=True))
    return pa.record_batch(
        [pa.array(anchor.view(np.int64)), pa.array(whole.view(np.int64)), pa.array(key), pa.array(first.astype(np.int32)), pa.array(n.astype(np.int32))],
        names=["anchor", "whole", "key", "first", "n"],
    )


def _runs_of(docs: DataFrame, window: int, prefix: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                parts: list[tuple] = []
                for key, text in zip(batch.column(0)[at : at + 500].to_pylist(), batch.column(1)[at : at + 500].to_pylist(), strict=True):
                    parts += [(np.full(len(x[0]), key), *x) for x in runs(words_of(text), window, prefix)]
                if parts:
                    yield _run_rows(parts)

    return docs.select("key", "text").mapInArrow(run, _RUN)


def repeats_in_tree(segments: list[list[bytes]], windows: list[int], window: int = WINDOW) -> list[np.ndarray]:
    """For each segment, which of its first `windows` windows also start elsewhere among the segments.

    The suffix tree is built level by level: rank[p] names the node at the present depth on the path of the
    suffix at p, -1 where the suffix is a leaf or too short.
    """
    names: dict[bytes, int] = {}
    lengths = np.array([len(s) for s in segments], np.int64)
    ends = np.cumsum(lengths)
    rank = np.fromiter((names.setdefault(w, len(names)) for s in segments for w in s), np.int64, int(lengths.sum()))
    left = np.repeat(ends, lengths) - np.arange(len(rank))  # words from here to the end of the segment

    def level(rank: np.ndarray, step: int, depth: int) -> np.ndarray:
        at = np.flatnonzero((left >= depth) & (rank >= 0))
        at = at[rank[at + step] >= 0]
        pairs = rank[at] * np.int64(len(rank) + 1) + rank[at + step]
        _, node, size = np.unique(pairs, return_inverse=True, return_counts=True)
        out = np.full(len(rank), -1, np.int64)
        inner = size[node] > 1
        out[at[inner]] = node[inner]
        return out

    depth = 1
    while depth * 2 <= window:
        rank = level(rank, depth, depth * 2)
        depth *= 2
    if depth < window:
        rank = level(rank, window - depth, window)
    found = rank >= 0
    starts = ends - lengths
    # a node may hold one window start and places in the tails of segments only: count starts
    is_start = np.zeros(len(rank), bool)
    for s, n in zip(starts.tolist(), windows, strict=True):
        is_start[s : s + n] = True
    own = rank[found & is_start]
    times = np.bincount(own, minlength=int(own.max()) + 1) if len(own) else np.zeros(1, np.int64)
    return [(rank[s : s + n] >= 0) & (times[np.maximum(rank[s : s + n], 0)] > 1) for s, n in zip(starts.tolist(), windows, strict=True)]


def _ranges_where(mask: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8), [0]))))
    return [(int(a), int(b - a)) for a, b in zip(edge[::2], edge[1::2], strict=True)]


_MARK = "key long, first int, n int"


def _trees(segments: DataFrame, window: int) -> DataFrame:
    def close(rows: list[tuple]) -> pa.RecordBatch | None:
        found = repeats_in_tree([r[4].split() for r in rows], [r[2] for r in rows], window)
        marks = [(key, first + a, n) for (key, first, _, done, _), mask in zip(rows, found, strict=True) if not done for a, n in _ranges_where(mask)]
        if not marks:
            return None
        key, first, n = zip(*marks, strict=True)
        return pa.record_batch([pa.array(key, pa.int64()), pa.array(first, pa.int32()), pa.array(n, pa.int32())], names=["key", "first", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        last, size = None, 0
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in range(6)]
            for anchor, *row in zip(*columns, strict=True):
                if anchor != last and size > _CHUNK_WORDS:  # whole groups only
                    if (out := close(rows)) is not None:
                        yield out
                    rows, size = [], 0
                rows.append(tuple(row))
                last, size = anchor, size + row[1 + 1] + window
        if rows and (out := close(rows)) is not None:
            yield out

    return segments.select("anchor", "key", "first", "n", "done", "words").repartition("anchor").sortWithinPartitions("anchor").mapInArrow(run, _MARK)


def _asked_runs(part: pa.RecordBatch, hot: bool) -> Iterator[tuple[int, dict, list[bytes]]]:
    """(key, run, its words) of the asked runs of a batch of (key, text, asked)."""
    for key, text, asked in zip(*(c.to_pylist() for c in part.columns), strict=True):
        words = words_of(text)
        for x in asked:
            if x["hot"] == hot:
                yield key, x, words


def _segments(joined: DataFrame, window: int) -> DataFrame:
    """Texts of the asked runs whose groups fit a tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                asked = _asked_runs(batch.slice(at, 500), False)
                out = [(x["anchor"], key, x["first"], x["n"], x["done"], b" ".join(words[x["first"] : x["first"] + x["n"] + window - 1])) for key, x, words in asked]
                if out:
                    c = list(zip(*out, strict=True))
                    yield pa.record_batch(
                        [pa.array(c[0], pa.int64()), pa.array(c[1], pa.int64()), pa.array(c[2], pa.int32()), pa.array(c[3], pa.int32()), pa.array(c[4], pa.bool_()), pa.array(c[5], pa.binary())],
                        names=["anchor", "key", "first", "n", "done", "words"],
                    )

    return joined.select("key", "text", "asked").mapInArrow(run, "anchor long, key long, first int, n int, done boolean, words binary")


def _longer_runs(joined: DataFrame, window: int, prefix: int) -> DataFrame:
    """The asked runs of groups that don't fit, divided by the anchors of a longer prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                parts: list[tuple] = []
                for key, x, words in _asked_runs(batch.slice(at, 500), True):
                    own = words[x["first"] : x["first"] + x["n"] + window - 1]
                    parts += [(np.full(len(a), key), a, whole, first + x["first"], n) for a, whole, first, n in runs(own, window, prefix)]
                if parts:
                    yield _run_rows(parts)

    return joined.select("key", "text", "asked").mapInArrow(run, _RUN)


def _level(rows: DataFrame, group_limit: int | None) -> tuple[DataFrame, DataFrame]:
    """Runs that repeat as a whole (key, first, n), and per text the runs whose words are to be compared."""
    shared = rows.groupBy("anchor").agg(F.count(F.lit(1)).alias("c"), F.min("whole").alias("lo"), F.max("whole").alias("hi")).where("c > 1")
    shared = written(shared, "shared")  # a table of its own, so that a hot anchor's rows can be split in the join
    held = written(rows.join(shared.select("anchor", (F.col("lo") == F.col("hi")).alias("single")), "anchor"), "runs")
    whole_single = held.where("single").select("key", "first", "n")

    many = held.where("not single").select("anchor", "whole", "key", "first", "n")
    variants = many.groupBy("anchor", "whole", "n").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("key", "first")).alias("one"))
    variants = written(variants.select("anchor", "whole", "n", "c", (F.col("c") > 1).alias("done"), "one.key", "one.first"), "variants")
    again, same = variants.where("done"), ["anchor", "whole", "n"]
    # a variant with over 1/HEAVY of all runs would be one key of a shuffle; there are fewer than HEAVY, so they are broadcast
    least = (variants.agg(F.sum("c")).first()[0] or 0) / HEAVY
    heavy = F.broadcast(again.where(F.col("c") > least).select(*same))
    light = again.where(F.col("c") <= least).select(*same)
    whole_many = many.join(heavy, same, "left_semi").unionByName(many.join(heavy, same, "left_anti").join(light, same, "left_semi")).select("key", "first", "n")

    groups = variants.groupBy("anchor").agg(F.count(F.lit(1)).alias("v"), F.max(~F.col("done")).alias("open")).where("open and v > 1")
    hot = F.lit(False) if group_limit is None else F.col("v") > group_limit
    asked = variants.join(written(groups, "groups").select("anchor", hot.alias("hot")), "anchor")
    asked = asked.groupBy("key").agg(F.collect_list(F.struct("anchor", "first", "n", "done", "hot")).alias("asked"))  # at most the runs of one text
    return whole_single.unionByName(whole_many), written(asked, "asked")


def marks(docs: DataFrame, window: int = WINDOW, prefix: int = PREFIX, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """(key, first, n): runs of repeated windows of docs (key, text)."""
    rows, found = _runs_of(docs, window, prefix), []
    while True:  # the prefix doubles, so there are few rounds
        whole, asked = _level(rows, group_limit if prefix < window else None)
        joined = docs.join(asked, "key")
        found += [whole, _trees(_segments(joined, window), window)]
        # where most groups fit, few texts are read again; runs done elsewhere are places too and go along
        if prefix >= window or not asked.where(F.exists("asked", lambda x: x["hot"])).limit(1).count():
            return reduce(DataFrame.unionByName, found)
        prefix = min(2 * prefix, window)
        rows = _longer_runs(joined.where(F.exists("asked", lambda x: x["hot"])), window, prefix)


def _covered(n_words: int, spans: list[dict] | None, window: int) -> np.ndarray:
    change = np.zeros(n_words + 1, np.int64)
    for x in spans or ():
        change[x["first"]] += 1
        change[x["first"] + x["n"] + window - 1] -= 1
    return np.cumsum(change[:-1]) > 0


def _with_spans(docs: DataFrame, window: int, prefix: int, group_limit: int) -> DataFrame:
    found = marks(docs.select("key", "text"), window, prefix, group_limit)
    per_doc = found.groupBy("key").agg(F.collect_set(F.struct("first", "n")).alias("spans"))  # at most the windows of one text
    return docs.join(per_doc, "key", "left")


def _known(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).select("id", "text", F.xxhash64("id", "text").alias("key"))


def ranges(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, prefix: int = PREFIX, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """(id, n_words, removed array<struct<start,end>>, kept string) of every row; ranges are of word numbers, ends exclusive."""
    kind = df.schema[id_col].dataType.simpleString()
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        n, removed, kept = [], [], []
        for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            words = words_of(text)
            cover = _covered(len(words), spans, window)
            n.append(len(words))
            removed.append([{"start": a, "end": a + k} for a, k in _ranges_where(cover)])
            kept.append(b" ".join(words if not spans else [w for w, c in zip(words, cover.tolist(), strict=True) if not c]).decode("utf-8", "surrogatepass"))
        return pa.record_batch([batch.column(0), pa.array(n, pa.int64()), pa.array(removed, spans_type), pa.array(kept, pa.string())], names=[id_col, "n_words", "removed", "kept"])

    joined = _with_spans(_known(df, id_col, text_col), window, prefix, group_limit).select(F.col("id").alias(id_col), "text", "spans")
    return map_arrow(joined, run, f"`{id_col}` {kind}, n_words long, removed array<struct<start:bigint,end:bigint>>, kept string")


def deduplicate(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = "n_chars", window: int = WINDOW, prefix: int = PREFIX) -> DataFrame:
    """df with repeated words cut out of its texts: what is between removed ranges keeps its own white space."""
    at = df.columns.index(text_col)
    length = df.columns.index(length_col) if length_col in df.columns else None

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, spans = batch.column(at).to_pylist(), batch.column(len(batch.columns) - 1).to_pylist()
        clean = [cut(t, s, window) for t, s in zip(texts, spans, strict=True)]
        columns = list(batch.columns)[:-1]
        columns[at] = pa.array(clean, batch.schema.field(at).type)
        if length is not None:
            old = batch.column(length).to_pylist()
            columns[length] = pa.array([len(c) if s else n for n, c, s in zip(old, clean, spans, strict=True)], batch.schema.field(length).type)
        return pa.RecordBatch.from_arrays(columns, schema=pa.schema([batch.schema.field(i) for i in range(len(columns))]))

    found = marks(_known(df, id_col, text_col).select("key", "text"), window, prefix)
    per_doc = found.groupBy("key").agg(F.collect_set(F.struct("first", "n")).alias("spans"))  # at most the windows of one text
    names = [f"c{i}" for i in range(len(df.columns))]  # given names may clash with those used here
    keyed = df.toDF(*names).withColumn("key", F.xxhash64(names[df.columns.index(id_col)], names[at]))
    joined = keyed.join(per_doc, "key", "left").select(*names, "spans")
    return map_arrow(joined, run, df.toDF(*names).schema).toDF(*df.columns)


def cut(text: str | None, spans: list[dict] | None, window: int = WINDOW) -> str | None:
    """The text without the words that the spans of windows cover, and without the space that follows each of them."""
    if not text or not spans:
        return text
    data = text.encode("utf-8", "surrogatepass")
    space = np.isin(np.frombuffer(data, np.uint8), np.frombuffer(b" \t\n\v\f\r", np.uint8))
    starts = np.flatnonzero(~space & np.concatenate(([True], space[:-1])))
    follow = np.append(starts[1:], len(data))
    out, last = [], 0
    for a, n in _ranges_where(_covered(len(starts), spans, window)):
        out.append(data[last : starts[a]])
        last = int(follow[a + n - 1])
    out.append(data[last:])
    return b"".join(out).decode("utf-8", "surrogatepass")


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["start"])
    return found.select(id_col, "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


