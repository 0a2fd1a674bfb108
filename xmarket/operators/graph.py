"""Graph operators on edge tables: connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from xmarket.session import discard, written


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60) -> DataFrame:
    """Label every node that has an edge with the smallest node of its component: (node, component).

    Large-star and small-star rounds (Kiveris et al., 2014) hang every node below the smallest
    neighbour seen so far, which ends after about log2(n) rounds whatever the diameter.  Each round
    only joins edges with a pre-aggregated minimum per node, so a hub is combined before it is
    shuffled and its rows can be split by adaptive skew joins.  Rounds are cut by a written table in
    the shared folder.  Self-loops and rows with a null end are ignored; no edges give no rows.
    """
    named = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).where("u <> v")
    current = written(named.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    for _ in range(max_rounds):
        last, current = current, written(_small_star(_large_star(current)), "edges")
        discard(last)
        row = current.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        now = (row["n"], row["h"])
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = current.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    out = current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
    return out


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    hung = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return hung.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
