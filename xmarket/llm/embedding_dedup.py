"""Embedding near-dedup by collision-counting projections.

Unit vectors are projected on PROJECTIONS random directions.  A pair at the cosine threshold has projections
that differ by a normal variable of known spread, so the number of projections in which one vector lies
in the other's window is binomial; the count that a pair must reach is the largest one that the threshold
pair reaches with probability ``recall``.  Pairs that reach it are verified by their cosine in doubles.

The first projection is sorted into cells one guard width apart: a pair is met in one cell or two adjacent
ones.  Cells are cut into chunks of about CHUNK vectors and every pair of chunks that can hold links is one
task, in which each projection is sorted once and every query's window becomes a range of ranks.  So a task
holds two chunks whatever the size of a label, and emits at most one sum of links and one edge per vector.

Exact copies of a vector are one node with a weight.  Work grows with the square of a cell's distinct
vectors, as any count of collisions within one label does; links between any two labels aren't looked for.

Defined results: rows whose label is null, or whose vector is null, empty, zero or holds null or non-finite
components, link with nothing (n_links 0, own component, kept); vectors of different lengths don't link;
labels may be of any type that can be compared, and 32-bit components stay so, others are taken as doubles; ids are
whole numbers; rows that share a vec_id are one node of the components; a row with a null vec_id links with nothing and
has a null component; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from math import comb, erf, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from xmarket.operators.graph import connected_components
from xmarket.session import written
from xmarket.llm.words import map_arrow

PROJECTIONS, CHUNK, SEED = 64, 4096, 20240917


def calibrated(threshold: float, recall: float, projections: int = PROJECTIONS) -> tuple[float, float, int]:
    """(half window, guard width of the first projection, count to reach) for a cosine threshold and a recall."""
    spread = sqrt(max(2 - 2 * threshold, 1e-12))
    half = 1.5 * spread
    p = erf(1.5 / sqrt(2))
    tail, count = 0.0, projections + 1
    while count and tail < recall:
        count -= 1
        tail += comb(projections, count) * p**count * (1 - p) ** (projections - count)
    return half, 4.0 * spread, count


def directions(dim: int, projections: int = PROJECTIONS) -> np.ndarray:
    return np.random.default_rng([SEED, dim]).standard_normal((dim, projections))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _with_cells(classes: DataFrame, guard: float) -> DataFrame:
    """(label, dim, embedding, rep, mult, cell): cell is the place of the first projection."""
    label, vector = (classes.schema[c].dataType.simpleString() for c in ("label", "embedding"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        vectors, cells = batch.column(1).to_pylist(), []
        for v in vectors:
            x = np.array(v, np.float64)
            cells.append(int(np.floor((x / np.linalg.norm(x)) @ directions(len(x))[:, 0] / guard)))
        return pa.record_batch([*batch.columns, pa.array([len(v) for v in vectors], pa.int32()), pa.array(cells, pa.int64())], names=["label", "embedding", "rep", "mult", "dim", "cell"])

    return map_arrow(classes.select("label", "embedding", "rep", "mult"), run, f"label {label}, embedding {vector}, rep long, mult long, dim int, cell long")


def _links_in_task(half: float, need: int, threshold: float):
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        dim, ca, ia, cb, ib = (table[c][0].as_py() for c in ("dim", "ca", "ia", "cb", "ib"))
        rep, mult = table["rep"].to_numpy(), table["mult"].to_numpy()
        raw = _matrix(table["embedding"].chunk(0), dim)
        norm = np.linalg.norm(raw, axis=1)
        unit = raw / norm[:, None]
        own = (ca, ia) == (cb, ib)
        cell, chunk = table["cell"].to_numpy(), table["chunk"].to_numpy()
        left = np.flatnonzero((cell == ca) & (chunk == ia))
        right = left if own else np.flatnonzero((cell == cb) & (chunk == ib))
        places = unit @ directions(dim)
        ranks, lows, widths = [], [], []
        for j in range(places.shape[1]):
            values = places[right, j]
            order = np.argsort(values, kind="stable")
            rank = np.empty(len(right), np.uint32)
            rank[order] = np.arange(len(right), dtype=np.uint32)
            low = np.searchsorted(values[order], places[left, j] - half, side="left")
            ranks.append(rank)
            lows.append(low.astype(np.uint32))
            widths.append((np.searchsorted(values[order], places[left, j] + half, side="right") - low).astype(np.uint32))
        links, label = np.zeros(len(rep), np.int64), np.arange(len(rep))
        for at in range(0, len(left), 256):
            part = slice(at, at + 256)
            counts = np.zeros((len(left[part]), len(right)), np.uint8)
            for rank, low, width in zip(ranks, lows, widths, strict=True):
                counts += (rank[None, :] - low[part][:, None]) < width[part][:, None]
            q, r = np.nonzero(counts >= need)
            i, k = left[part][q], right[r]
            if own:
                i, k = i[i < k], k[i < k]
            for lo in range(0, len(i), 1 << 16):
                a, b = i[lo : lo + (1 << 16)], k[lo : lo + (1 << 16)]
                true = np.einsum("ij,ij->i", raw[a], raw[b]) / (norm[a] * norm[b]) >= threshold
                a, b = a[true], b[true]
                np.add.at(links, a, mult[b])
                np.add.at(links, b, mult[a])
                for s in np.unique(a):
                    found = np.unique(label[np.append(b[a == s], s)])
                    for x in found[1:]:
                        label[label == x] = found[0]
        touched = links > 0
        return pa.table({"rep": rep[touched], "links": links[touched], "root": rep[label[touched]]})

    return run


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = 0.93, recall: float = 0.9999) -> DataFrame:
    """(id, n_links, component_id, kept) of every row."""
    half, guard, need = calibrated(threshold, recall)
    narrow = df.schema[vector_col].dataType.simpleString() == "array<float>"
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<float>" if narrow else "array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    able = F.coalesce(F.col("id").isNotNull() & F.col("label").isNotNull() & (F.size("embedding") > 0) & finite & F.exists("embedding", lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("able", able)
    classes = rows.where("able").groupBy("label", "embedding").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("mult"))
    placed = written(_with_cells(classes, guard), "cells")

    size = placed.groupBy("label", "dim", "cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(CHUNK)).cast("int").alias("chunks"))
    around = size
    for name, step in (("before", 1), ("after", -1)):
        near = size.select("label", "dim", (F.col("cell") + step).alias("cell"), F.col("chunks").alias(name))
        around = around.join(near, ["label", "dim", "cell"], "left")
    dealt = placed.join(around, ["label", "dim", "cell"]).withColumn("chunk", F.pmod(F.xxhash64("rep", "embedding"), F.col("chunks")).cast("int"))
    pair = lambda ca, ia, cb, ib: F.struct(ca.alias("ca"), ia.cast("int").alias("ia"), cb.alias("cb"), ib.cast("int").alias("ib"))
    upto = lambda n: F.when(F.coalesce(n, F.lit(0)) > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    cell, chunk = F.col("cell"), F.col("chunk")
    tasks = F.concat(
        F.transform(upto(F.col("chunks")), lambda j: pair(cell, F.least(chunk, j), cell, F.greatest(chunk, j))),
        F.transform(upto(F.col("after")), lambda j: pair(cell, chunk, cell + 1, j)),
        F.transform(upto(F.col("before")), lambda j: pair(cell - 1, j, cell, chunk)),
    )
    work = dealt.select("label", "dim", "cell", "chunk", "rep", "mult", "embedding", F.explode(tasks).alias("t")).select("*", "t.*").drop("t")
    found = written(work.groupBy("label", "dim", "ca", "ia", "cb", "ib").applyInArrow(_links_in_task(half, need, threshold), "rep long, links long, root long"), "links")

    summed = found.groupBy("rep").agg(F.sum("links").alias("links"))
    parts = connected_components(found, "rep", "root")
    per_class = placed.select("label", "embedding", "rep", "mult").join(summed, "rep", "left").join(parts, F.col("rep") == F.col("node"), "left")
    per_class = per_class.select(
        F.col("label").alias("c_label"), F.col("embedding").alias("c_embedding"), "rep",
        (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component"),
    )
    named = rows.where("able").join(per_class, (F.col("label") == F.col("c_label")) & (F.col("embedding") == F.col("c_embedding"))).select("id", "n_links", "component")
    alone = rows.where("not able").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component"))
    out = named.unionByName(alone)
    return out.select(F.col("id").alias(id_col), F.col("n_links").cast("long").alias("n_links"), F.col("component").alias("component_id"), F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"))
