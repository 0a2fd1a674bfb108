"""Candidate pairs of events: blocking, scoring, ranks, pruning, and one-to-one selection.

Blocking joins exploded keywords of both venues, so the pairs that arise are those that share a keyword; keyword
joins are skew-safe by adaptive skew splitting (both sides are plain shuffles), and pairs are reduced to one row
with their shared keywords before features are attached.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from xmarket.functions import category
from xmarket.functions.text import overlaps, statistics_key, strings
from xmarket.operators import rules
from xmarket.session import discard, written

col = F.col


def keyword_statistics(index: DataFrame) -> DataFrame:
    """G1: (keyword, df, df_k, df_p, idf) over the events of an index (event_id, platform, keywords)."""
    total = index.agg(F.count(F.lit(1)).alias("events"))  # one row
    plain = F.filter(F.coalesce("keywords", F.array().cast("array<string>")), lambda k: (k != "") & ~F.lower(k).startswith("year:"))
    rows = index.select("platform", F.explode(F.array_distinct(F.transform(plain, statistics_key))).alias("keyword"))
    counts = rows.groupBy("keyword").agg(F.count(F.lit(1)).alias("df"), F.count_if(col("platform") == "K").alias("df_k"), F.count_if(col("platform") == "P").alias("df_p"))
    return counts.crossJoin(F.broadcast(total)).select("keyword", "df", "df_k", "df_p", (F.log((col("events") + 1) / (col("df") + 1)) + 1).alias("idf"))


def blocked_pairs(index: DataFrame) -> DataFrame:
    """J1, first half: pairs (k_id, p_id, common_keywords) that share at least one keyword that is no year."""
    words = index.select("event_id", "platform", F.explode(F.array_distinct("keywords")).alias("keyword"))
    k = words.where("platform = 'K'").select(col("event_id").alias("k_id"), "keyword")
    p = words.where("platform = 'P'").select(col("event_id").alias("p_id"), "keyword")
    return k.join(p, "keyword").groupBy("k_id", "p_id").agg(F.array_sort(F.collect_list("keyword")).alias("common_keywords"))


def with_category_modes(events: DataFrame, mapping: dict[str, list[str]]) -> DataFrame:
    """K events with their P keys and mode, resolved once per distinct category against the P terms that exist."""
    p_terms = events.where("platform = 'P'").select(F.explode("terms").alias("t")).distinct()
    known = [r["t"] for r in p_terms.orderBy("t").collect()]  # category vocabulary of the snapshot
    keyed = events.where("platform = 'K'").withColumn("k_key", category.k_key(col("category"), col("sub_category")))
    resolved = category.resolve(keyed.select("k_key").distinct(), mapping, known)
    return keyed.join(resolved.select("k_key", "mode", col("keys").alias("match_keys")), "k_key", "left")


def build_pairs(index: DataFrame, mapping: dict[str, list[str]]) -> DataFrame:
    """Kept pairs with evidence, path, quality score and tier, after the rejecting rules.

    index: event_id, platform, title, category, sub_category, keywords; features are computed once per event.
    """
    events = written(rules.pair_features(index), "features")
    k = rules.side(with_category_modes(events, mapping), "k").withColumnRenamed("k_event_id", "k_id").withColumnRenamed("k_mode", "mode")
    p = rules.side(events.where("platform = 'P'"), "p").withColumnRenamed("p_event_id", "p_id")
    pairs = blocked_pairs(index).join(k, "k_id").join(p, "p_id")
    pairs = rules.with_evidence(pairs)
    pairs = pairs.withColumn("match_keys", F.array_intersect("k_match_keys", "p_terms")).withColumn("by_category", overlaps(col("k_match_keys"), col("p_terms")))
    keeps = rules.keeps_by_keywords() & ((col("mode") != "broad_fallback") | rules.keeps_in_broad_mode())
    pairs = pairs.withColumn("by_keywords", keeps).withColumn("by_title", rules.keeps_by_title())
    kept = pairs.where((col("by_category") & col("by_keywords")) | col("by_title")).withColumn("reject_reason", rules.hard_reject_reason()).where("reject_reason = ''")
    return rules.with_quality(kept)


def semantic_features(pairs: DataFrame, profiles: DataFrame, statistics: DataFrame) -> DataFrame:
    """Anchors and scores of pairs (k_id, p_id, common_keywords, ...) from both profiles."""
    k = rules.side(profiles.drop("keywords", "platform"), "k").withColumnRenamed("k_event_id", "k_id")
    p = rules.side(profiles.drop("keywords", "platform"), "p").withColumnRenamed("p_event_id", "p_id")
    words = pairs.select("k_id", "p_id", F.explode(F.array_distinct(F.transform(F.filter("common_keywords", lambda w: ~F.lower(w).startswith("year:")), statistics_key))).alias("keyword"))
    evidence = (
        words.join(statistics.select("keyword", "df", "idf"), "keyword", "left")
        .groupBy("k_id", "p_id")
        .agg(F.min(F.coalesce("df", F.lit(0))).alias("rarest_df"), F.sum(F.least(F.lit(4.0), F.coalesce("idf", F.lit(0.0)))).alias("idf_sum"))
    )
    base = pairs.select("k_id", "p_id", *(c for c in ("quality_score", "quality_tier", "ov", "jac", "n") if c in pairs.columns))
    df = base.join(evidence, ["k_id", "p_id"], "left").join(k, "k_id").join(p, "p_id")
    shared = lambda f: F.size(F.array_intersect(f"k_{f}", f"p_{f}"))
    fixture = rules.events.same_participants(col("k_participants"), col("p_participants"))
    df = df.withColumn("exact_fixture", fixture).withColumn("explicit_conflicts", rules.explicit_conflicts()).withColumn("one_sided", rules.one_sided_fields())
    cap = lambda c, most: F.least(F.lit(most), c)
    occurrence = (
        F.when(col("exact_fixture"), F.lit(12.0)).otherwise(cap(shared("participants") * 2.0, 4.0)) + cap(shared("entities") * 4.0, 12.0) + shared("districts") * 10.0
        + shared("locations") * 8.0 + shared("groups") * 4.0 + shared("dates") * 5.0 + shared("periods") * 4.0 + shared("seasons") * 4.0 + shared("years") * 2.0
        + cap(F.coalesce("idf_sum", F.lit(0.0)), 12.0)
    )
    proposition = shared("actions") * 4.0 + shared("scopes") * 3.0 + shared("market_layers") * 3.0 + shared("directions") * 4.0 + shared("thresholds") * 5.0
    some = lambda *fs: F.greatest(*(shared(f) for f in fs), F.lit(0)) > 0
    anchors = F.array_compact(
        F.array(
            F.when(some("districts"), F.lit("district")), F.when(some("entities"), F.lit("entity")), F.when(col("exact_fixture"), F.lit("fixture")),
            F.when(some("groups") & some("entities", "scopes"), F.lit("group_context")), F.when(some("locations"), F.lit("location")), F.when(col("rarest_df") <= 25, F.lit("rare_keyword")),
        )
    )
    second = F.array_compact(F.array(F.when(some("actions"), F.lit("action")), F.when(some("market_layers"), F.lit("market_layer")), F.when(some("scopes"), F.lit("scope")), F.when(some("dates", "periods", "seasons", "years"), F.lit("time"))))
    df = df.withColumn("primary_anchors", anchors).withColumn("secondary_anchors", second)
    df = df.withColumn("occurrence_score", F.bround(occurrence, 3)).withColumn("proposition_score", F.bround(proposition, 3))
    df = df.withColumn("semantic_score", F.bround(occurrence + proposition - F.size("explicit_conflicts") * 20.0 - F.size("one_sided") * 0.75, 3))
    same = lambda f: (col(f"k_{f}") != "") & (col(f"k_{f}") == col(f"p_{f}"))
    return df.select(
        *base.columns, "rarest_df", "exact_fixture", "explicit_conflicts", "one_sided", "primary_anchors", "secondary_anchors", "occurrence_score", "proposition_score", "semantic_score",
        same("occurrence_key").alias("same_occurrence"), same("proposition_key").alias("same_proposition"),
    )


def with_reciprocal_ranks(pairs: DataFrame) -> DataFrame:
    """Rank and fan-out of a pair among those of its K event and of its P event."""
    order = [F.desc("semantic_score"), F.desc("quality_score"), "k_id", "p_id"]
    for name, key in (("k", "k_id"), ("p", "p_id")):
        pairs = pairs.withColumn(f"{name}_rank", F.row_number().over(Window.partitionBy(key).orderBy(*order))).withColumn(f"{name}_fanout", F.count(F.lit(1)).over(Window.partitionBy(key)))
    return pairs


def prune_reason(max_rank: int = 2) -> Column:
    """The first reason to drop a ranked pair, empty if none.  Ranks are those of the unpruned set."""
    ov, jac = F.coalesce("ov", F.lit(0.0)), F.coalesce("jac", F.lit(0.0))
    no_anchor = F.size("primary_anchors") == 0
    identity = overlaps(col("explicit_conflicts"), strings(["groups", "districts", "locations", "participants", "periods", "scopes"]))
    has = lambda a: F.array_contains("primary_anchors", a)
    budget = (F.least("k_rank", "p_rank") <= max_rank) | (ov >= 0.80) | has("fixture") | has("district") | (has("entity") & (ov >= 0.60))
    return (
        F.when(identity, "explicit_identity_conflict")
        .when((col("quality_tier") == "weak") & no_anchor & (ov < 0.75), "weak_without_primary_anchor")
        .when((col("rarest_df") > 100) & no_anchor & (ov < 0.75) & (jac < 0.55), "high_frequency_only")
        .when(~budget, "outside_candidate_budget")
        .otherwise("")
    )


def prune(pairs: DataFrame, max_rank: int = 2) -> DataFrame:
    """All pairs with their reason; keep those where it is empty."""
    return with_reciprocal_ranks(pairs).withColumn("prune_reason", prune_reason(max_rank))




def candidate_order() -> list[Column]:
    """T1."""
    return [F.desc("semantic_score"), F.desc("quality_score"), F.desc("n"), F.desc("ov"), F.desc("jac"), F.asc("k_id"), F.asc("p_id")]


def greedy_exclusive(pairs: DataFrame, order: list[Column], k: str = "k_id", p: str = "p_id") -> DataFrame:
    """Scan pairs in a strict order and take one if both its ends are free.

    Rounds take every pair that is first on both of its ends, which the scan would take too, and drop the pairs
    that touch a taken end; with a strict order the result is the scan's.  Rounds are cut by written tables.
    """
    rest = written(pairs, "greedy")
    taken: DataFrame | None = None
    while True:  # a round takes at least the first pair of all that are left
        first = lambda key: F.row_number().over(Window.partitionBy(key).orderBy(*order)) == 1
        won = written(rest.withColumn("_k", first(k)).withColumn("_p", first(p)).where("_k and _p").drop("_k", "_p"), "greedy")
        if won.limit(1).count() == 0:
            break
        taken = won if taken is None else taken.unionByName(won)
        last, rest = rest, written(rest.join(won.select(k), k, "left_anti").join(won.select(p), p, "left_anti"), "greedy")
        discard(last)
    return taken if taken is not None else rest


def component_statistics(pairs: DataFrame) -> DataFrame:
    """Nodes and edges of every component of the pair graph, largest first."""
    from xmarket.operators.graph import connected_components

    k, p = F.concat(F.lit("k:"), col("k_id").cast("string")), F.concat(F.lit("p:"), col("p_id").cast("string"))
    edges = pairs.select(k.alias("src"), p.alias("dst")).distinct()
    found = connected_components(edges)
    nodes = found.groupBy("component").agg(F.count(F.lit(1)).alias("nodes"))
    by_edge = edges.join(found, edges.src == found.node).groupBy("component").agg(F.count(F.lit(1)).alias("edges"))
    return nodes.join(by_edge, "component").orderBy(F.desc("edges"), F.desc("nodes"))
