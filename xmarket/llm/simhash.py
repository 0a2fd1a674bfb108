"""SimHash near-dedup by meet-in-the-middle ball hashing.

Fingerprints within a radius link.  A ball of one bit around each of two fingerprints meets if they differ in
two bits; what the radius has beyond that is absorbed by a mask: the 64 bits are cut into blocks, each block in
turn is masked, and the fingerprint emits the masked value and all its variants one flipped bit away.  Of r
differing bits the fullest of b blocks holds at least r / b, so with r - ceil(r / b) <= 2 the balls meet under
some mask: 4 blocks serve a radius of 3, 2 blocks one of 5.  Variants are shuffled, members of a bucket are
verified on all 64 bits, and a bucket gives a spanning forest of its links instead of all its pairs.
Components come from alternating stars.

Bounds: only distinct fingerprints are emitted, 196 rows each for 4 blocks and 66 for 2.  With 4 blocks a bucket's
members lie within one bit of one masked value, so it holds at most 49 * 2^16 fingerprints whatever the input, and
a search in it looks neighbours up by their bits instead of comparing all pairs.

Defined results: a null or wordless text has fingerprint zero and links like any other; fewer words than
a shingle give one shingle; rows with a null id take part, and a component of null ids alone has a null
component id; repeated rows share their fingerprint; extra columns are ignored; an empty table gives an
empty result.  Whole texts are read, in slices of bounded memory.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from xmarket.operators.graph import connected_components
from xmarket.session import written
from xmarket.llm.words import map_arrow

SEED = 42
_SLICE = 1 << 16
_DENSE = 1 << 11  # buckets above this size look neighbours up by bits


@dataclass(frozen=True)
class Ball:
    """A radius and the number of blocks that are masked in turn."""

    radius: int = 3
    blocks: int = 4

    def __post_init__(self) -> None:
        if 64 % self.blocks or self.radius - math.ceil(self.radius / self.blocks) > 2:
            raise ValueError("the balls would not meet: radius - ceil(radius / blocks) must be at most 2")

    @property
    def width(self) -> int:
        return 64 // self.blocks


BALL = Ball()


def shingle_hashes(text: str | None, shingle: int = 3, seed: int = SEED) -> Iterator[np.ndarray]:
    """The XXH64 values of a text's word shingles, ASCII upper case lowered, in slices of bounded memory; no words, no slices."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle:
        yield np.array([digest(joined, seed)], np.uint64)
        return
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - shingle + 1]
    ends = ends[shingle - 1 :]
    for at in range(0, len(starts), _SLICE):
        spans = zip(starts[at : at + _SLICE].tolist(), ends[at : at + _SLICE].tolist(), strict=True)
        yield np.array([digest(joined[a:b], seed) for a, b in spans], np.uint64)


def majority(parts: Iterable[np.ndarray]) -> int:
    """The bits set in over half of the hashes; zero if there are none."""
    counts, n = np.zeros(64, np.int64), 0
    for h in parts:
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(h)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def fingerprint(text: str | None, shingle: int = 3, seed: int = SEED) -> int:
    """SimHash of the XXH64 values of word shingles, ASCII upper case lowered; unsigned 64 bits."""
    return majority(shingle_hashes(text, shingle, seed))


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", of: Callable[[str | None], int] = fingerprint) -> DataFrame:
    """(id, fp long) of every row; fp holds the unsigned fingerprint's bits."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        fp = np.array([of(t) for t in batch.column(1).to_pylist()], np.uint64)
        return pa.record_batch([batch.column(0), pa.array(fp.view(np.int64))], names=[id_col, "fp"])

    return map_arrow(df.select(id_col, text_col), run, f"`{id_col}` {kind}, fp long")


def variants(nodes: DataFrame, ball: Ball = BALL) -> DataFrame:
    """(block, variant, fp): every fingerprint's one-bit ball under each mask."""
    balls = []
    for block in range(ball.blocks):
        keep = ~(((1 << ball.width) - 1) << (block * ball.width)) & (1 << 64) - 1
        flips = [0, *(1 << i for i in range(64) if i // ball.width != block)]
        balls += [(block, *(x - (1 << 64) if x >> 63 else x for x in (keep, flip))) for flip in flips]
    every = F.array(*(F.struct(F.lit(b).cast("tinyint").alias("block"), F.lit(k).cast("long").alias("keep"), F.lit(f).cast("long").alias("flip")) for b, k, f in balls))
    # few rows come in and many go out: deal them by a hash of their own, which isn't taken for the one of the grouping above
    spread = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = nodes.select("fp").repartition(spread, F.xxhash64("fp")).select("fp", F.explode(every).alias("b"))
    return rows.select("b.block", F.col("fp").bitwiseAND(F.col("b.keep")).bitwiseXOR(F.col("b.flip")).alias("variant"), "fp")


def bucket_forest(fps: np.ndarray, block: int, ball: Ball = BALL) -> list[tuple[int, int]]:
    """(member, neighbour) edges of a spanning forest of the links among a bucket's distinct fingerprints."""
    return _by_bits(fps, block, ball) if len(fps) > _DENSE and ball.width <= 16 else _by_scan(fps, ball.radius)


def _by_scan(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    edges, rest = [], fps
    while len(rest) > 1:
        todo, rest = [int(rest[0])], rest[1:]
        while todo and len(rest):
            here = todo.pop()
            near = np.bitwise_count(rest ^ np.uint64(here)) <= radius
            found = rest[near].tolist()
            rest = rest[~near]
            todo += found
            edges += [(x, here) for x in found]
    return edges


def _by_bits(fps: np.ndarray, block: int, ball: Ball) -> list[tuple[int, int]]:
    size, start_bit = 1 << ball.width, block * ball.width
    offsets = [np.array([sum(1 << i for i in c) for k in range(r + 1) for c in combinations(range(ball.width), k)], np.int64) for r in range(ball.radius + 1)]
    inner = ((fps >> np.uint64(start_bit)) & np.uint64(size - 1)).astype(np.int64)
    outer, group = np.unique(fps & ~np.uint64((size - 1) << start_bit), return_inverse=True)
    apart = np.bitwise_count(outer[:, None] ^ outer[None, :])
    here = np.zeros((len(outer), size), bool)
    here[group, inner] = True
    whole = lambda g, x: int(outer[g]) | x << start_bit
    edges = []
    for start in range(len(fps)):
        if not here[group[start], inner[start]]:
            continue
        here[group[start], inner[start]] = False
        todo = [(int(group[start]), int(inner[start]))]
        while todo:
            g, x = todo.pop()
            for other in np.flatnonzero(apart[g] <= ball.radius).tolist():
                near = x ^ offsets[ball.radius - int(apart[g, other])]
                found = near[here[other, near]]
                if len(found):
                    here[other, found] = False
                    todo += [(other, y) for y in found.tolist()]
                    edges += [(whole(other, y), whole(g, x)) for y in found.tolist()]
    return edges


def links(nodes: DataFrame, ball: Ball = BALL) -> DataFrame:
    """(src, dst): per bucket a spanning forest of the fingerprints that link in it; every row is a link itself."""
    dealt = variants(nodes, ball).repartition("block", "variant").sortWithinPartitions("block", "variant")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []  # the bucket that may go on in the next batch
        key = None
        for batch in batches:
            if not batch.num_rows:
                continue
            block, variant = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            fp = batch.column(2).to_numpy().view(np.uint64)
            cuts = np.flatnonzero((variant[1:] != variant[:-1]) | (block[1:] != block[:-1])) + 1
            starts, ends = np.concatenate(([0], cuts)), np.concatenate((cuts, [len(fp)]))
            edges: list[tuple[int, int]] = []
            first, last = (int(block[0]), int(variant[0])), (int(block[-1]), int(variant[-1]))
            if key is not None and key != first:
                edges += _closed(held, key[0], ball)
                held, key = [], None
            if len(starts) == 1:
                held, key = [*held, fp.copy()], last
            else:
                if key == first:
                    edges += _closed([*held, fp[: ends[0]]], key[0], ball)
                else:
                    edges += _closed([fp[: ends[0]]], first[0], ball)
                sizes = (ends - starts)[1:-1]
                twos = starts[1:-1][sizes == 2]
                a, b = fp[twos], fp[twos + 1]
                near = np.bitwise_count(a ^ b) <= ball.radius
                edges += zip(a[near].tolist(), b[near].tolist(), strict=True)
                for s, e in zip(starts[1:-1][sizes > 2].tolist(), ends[1:-1][sizes > 2].tolist(), strict=True):
                    edges += bucket_forest(fp[s:e], int(block[s]), ball)
                held, key = [fp[starts[-1] :].copy()], last
            if edges:
                yield _edge_batch(edges)
        if key is not None and (edges := _closed(held, key[0], ball)):
            yield _edge_batch(edges)

    return dealt.mapInArrow(run, "src long, dst long")


def _closed(parts: list[np.ndarray], block: int, ball: Ball) -> list[tuple[int, int]]:
    fps = np.concatenate(parts) if len(parts) > 1 else parts[0]
    return bucket_forest(fps, block, ball) if len(fps) > 1 else []


def _edge_batch(edges: list[tuple[int, int]]) -> pa.RecordBatch:
    pairs = np.array(edges, np.uint64).view(np.int64)
    return pa.record_batch([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["src", "dst"])


def components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", ball: Ball = BALL) -> DataFrame:
    """(id, fingerprint of 16 hex digits, component_id) of every row."""
    fps = written(fingerprints(df, id_col, text_col), "fingerprints")
    nodes = fps.groupBy("fp").agg(F.min(id_col).alias("least"))
    found = connected_components(links(nodes, ball))
    labelled = nodes.join(found, nodes.fp == found.node, "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    mins = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    by_fp = labelled.join(mins, "component").select("fp", "component_id")
    return fps.join(by_fp, "fp").select(id_col, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
