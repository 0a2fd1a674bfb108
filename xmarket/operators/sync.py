"""Snapshots: alignment, diff, cleanup of what is no longer active, caches and unions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from xmarket.functions.text import safe_text

col = F.col
#: Required columns of the venues' market rows, in order.
K_COLUMNS = "Platform,Event ID,Bet ID,Market Title,Bet Title,Category,Sub-Category,Series Ticker,Description,Bet_Rules,Event_Description,Status,Expiration Date,SyncStatus".split(",")
P_COLUMNS = "Platform,Event ID,Bet ID,Market Title,Bet Title,Category,Sub-Category,Description,Bet_Rules,Event_Description,Status,Expiration Date,SyncStatus,Outcomes,Token_IDs,Original_Market_ID,Outcome_Name".split(",")
SCHEMAS = {"K": K_COLUMNS, "P": P_COLUMNS}


def schema_of(venue: str) -> list[str]:
    """P8."""
    if venue not in SCHEMAS:
        raise ValueError(f"unknown venue {venue!r}")
    return SCHEMAS[venue]


def missing_columns(present, required) -> list[str]:
    """In the order in which they are required."""
    have = set(present)
    return [c for c in required if c not in have]


def align(df: DataFrame, required: list[str], default: str = "") -> DataFrame:
    """Required columns first, absent ones with the default, extras behind."""
    filled = df.select("*", *(F.lit(default).alias(c) for c in missing_columns(df.columns, required)))
    return filled.select(*(F.col(f"`{c}`") for c in [*required, *(c for c in df.columns if c not in set(required))]))


def first_by(df: DataFrame, keys: list[str], order: list[Column], keep: int = 1) -> DataFrame:
    """The first row (or rows) per key in an explicit order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(col("_rn") <= keep).drop("_rn")


def snapshot_diff(old: DataFrame, new: DataFrame, key: str = "bet_id", status: str = "sync_status") -> DataFrame:
    """The new snapshot; rows that the old one has keep its status, others are New.  Removed rows are gone."""
    before = old.select(col(key), F.coalesce(col(status), F.lit("")).alias("_old"))
    plain = new.drop(status)
    return plain.join(before, key, "left").withColumn(status, F.coalesce("_old", F.lit("New"))).drop("_old")


def diff_counts(old: DataFrame, new: DataFrame, key: str = "bet_id") -> DataFrame:
    """How many keys are new, kept and removed, in one full join of distinct keys."""
    a, b = old.select(key).distinct().withColumn("_a", F.lit(1)), new.select(key).distinct().withColumn("_b", F.lit(1))
    both = a.join(b, key, "full")
    return both.agg(F.count_if(col("_a").isNull()).alias("new"), F.count_if(col("_a").isNotNull() & col("_b").isNotNull()).alias("existing"), F.count_if(col("_b").isNull()).alias("removed"))


def shrink_guard(old_rows: int, new_rows: int, least: int = 1000, share: float = 0.5) -> None:
    """F16: refuse a snapshot that lost more than half of a large one."""
    if old_rows > least and new_rows < share * old_rows:
        raise ValueError(f"snapshot shrank from {old_rows} to {new_rows} rows")


def without_ids(df: DataFrame, taken: DataFrame, *pairs: tuple[str, str]) -> DataFrame:
    """Rows none of whose ids stand in the other table; pairs are (column here, column there)."""
    for here, there in pairs:
        ids = taken.select(col(there).alias("_id")).distinct()
        df = df.join(ids, col(here) == col("_id"), "left_anti")
    return df


def active_matches(events: DataFrame, bets: DataFrame, k_active: DataFrame, p_active: DataFrame, rejected: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Confirmed events whose ids are both active and not rejected, and bets of those that remain.

    If no event remains, bets stay unless their parent pair is among the removed ones.
    """
    k, p = k_active.select(col("id").alias("k_id")).distinct(), p_active.select(col("id").alias("p_id")).distinct()
    kept = events.join(k, "k_id", "left_semi").join(p, "p_id", "left_semi").join(rejected.select("k_id", "p_id"), ["k_id", "p_id"], "left_anti")
    removed = events.join(kept.select("k_id", "p_id"), ["k_id", "p_id"], "left_anti")
    if kept.limit(1).count():
        return kept, bets.join(kept.select("k_id", "p_id"), ["k_id", "p_id"], "left_semi")
    return kept, bets.join(removed.select("k_id", "p_id"), ["k_id", "p_id"], "left_anti")


def explode_ids(df: DataFrame, ids_col: str, out: str = "id") -> DataFrame:
    """One row per id of a list separated by semicolons."""
    return df.withColumn(out, F.explode(F.split(safe_text(col(ids_col)), r"\s*;\s*"))).where(col(out) != "")


def fill_titles(df: DataFrame, titles: DataFrame, key: str, title: str = "title") -> DataFrame:
    """A missing title comes from the lookup, else it is Unknown."""
    found = titles.select(col(key), col(title).alias("_title"))
    absent = col(title).isNull() | F.lower(F.trim(title)).isin("", "nan", "none", "null")
    return df.join(found, key, "left").withColumn(title, F.coalesce(F.when(~absent, col(title)), col("_title"), F.lit("Unknown"))).drop("_title")


def union_latest(old: DataFrame, new: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Union by name; per key the row with the highest order stays."""
    both = old.unionByName(new, allowMissingColumns=True)
    return first_by(both, keys, [F.desc(order)])


def upsert(cache: DataFrame, rows: DataFrame, keys: list[str], now: str) -> DataFrame:
    """U4: new rows replace old ones by key; created_at stays, last_verified_at is now, expiry is lifted."""
    fresh = rows.withColumn("last_verified_at", F.lit(now)).withColumn("is_expired", F.lit(False))
    before = cache.select(*keys, col("created_at").alias("_created"))
    fresh = fresh.join(before, keys, "left").withColumn("created_at", F.coalesce("_created", F.lit(now))).drop("_created")
    return cache.join(fresh.select(*keys), keys, "left_anti").unionByName(fresh, allowMissingColumns=True)


def expire(cache: DataFrame, k_active: DataFrame, p_active: DataFrame, reason: str = "inactive") -> DataFrame:
    """Rows with an inactive id are marked; already expired ones keep their reason."""
    k, p = k_active.select(col("id").alias("k_id"), F.lit(True).alias("_k")).distinct(), p_active.select(col("id").alias("p_id"), F.lit(True).alias("_p")).distinct()
    joined = cache.join(k, "k_id", "left").join(p, "p_id", "left")
    dead = col("_k").isNull() | col("_p").isNull()
    return joined.withColumn("expire_reason", F.when(~col("is_expired") & dead, F.lit(reason)).otherwise(col("expire_reason"))).withColumn("is_expired", col("is_expired") | dead).drop("_k", "_p")


def coverage(confirmed: DataFrame, candidates: DataFrame) -> DataFrame:
    """Confirmed pairs with whether the candidates hold them."""
    have = candidates.select("k_id", "p_id").distinct().withColumn("_have", F.lit(True))
    return confirmed.join(have, ["k_id", "p_id"], "left").withColumn("covered", F.coalesce("_have", F.lit(False))).drop("_have")


def sequential_ids(df: DataFrame, order: list[Column], name: str = "cluster_id") -> DataFrame:
    """1-based numbers in a global order, without gathering the rows in one task.

    Rows are range-partitioned by the order; each partition's start comes from a count per partition.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id())
    from xmarket.session import written

    ranged = written(ranged, "ordered")
    counts = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))  # a row a partition
    starts = counts.withColumn("_start", F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))).select("_part", F.coalesce("_start", F.lit(0)).alias("_start"))
    local = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return ranged.join(F.broadcast(starts), "_part").withColumn(name, (col("_start") + local).cast("long")).drop("_part", "_start")
