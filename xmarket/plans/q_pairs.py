"""Queries of blocking, pair rules, scoring, pruning, selection and matching."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from xmarket.functions import events, text
from xmarket.functions import lexicon as lx
from xmarket.operators import candidates, matching, rules
from xmarket.operators.graph import connected_components
from xmarket.plans.q_text import LEXICON, PLAIN, TOKENS, WORDS, sql_list, sql_named
from xmarket.plans.registry import query
from xmarket.plans.views import view

col = F.col


def index(spark: SparkSession, sf_dir: str, name: str = "v_titles") -> DataFrame:
    """v_titles as an event index with keywords: title words that are no stop words."""
    words = F.filter(F.split(F.trim(F.regexp_replace(F.lower("title"), "[^a-z0-9-]+", " ")), " "), lambda w: ~w.isin("", *lx.TITLE_STOP_WORDS))
    return view(spark, sf_dir, name).withColumn("keywords", F.array_sort(F.array_distinct(words))).withColumn("bet_titles", F.array().cast("array<string>"))


KEYWORDS = f"list_sort(list_distinct(list_filter(string_split({WORDS}, ' '), lambda w: w <> '' AND NOT list_contains({sql_list(lx.TITLE_STOP_WORDS)}, w))))"
INDEX = f"idx AS (SELECT event_id, platform, account, title, category, sub_category, {KEYWORDS} AS keywords FROM v_titles)"
_SING = "CASE WHEN regexp_matches(w, '(ss|us|is|as)$') THEN w WHEN w LIKE '%ies' AND length(w) > 5 THEN left(w, length(w) - 3) || 'y' WHEN w LIKE '%s' AND length(w) > 4 THEN left(w, length(w) - 1) ELSE w END"


@query(f"""WITH {INDEX}, n AS (SELECT count(*) AS n FROM idx), w AS (SELECT DISTINCT event_id, platform, {_SING} AS keyword FROM (SELECT event_id, platform, unnest(keywords) AS w FROM idx) x)
SELECT keyword, count(*) AS df, count(*) FILTER (platform = 'K') AS df_k, count(*) FILTER (platform = 'P') AS df_p, round(ln((max(n.n) + 1) / (count(*) + 1)) + 1, 6) AS idf FROM w, n GROUP BY keyword""")
def g1_document_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return candidates.keyword_statistics(index(spark, sf_dir)).withColumn("idf", F.round("idf", 6))




@query(f"""WITH {INDEX.replace("v_titles", "v_listings")}, w AS (SELECT event_id, platform, unnest(keywords) AS keyword FROM idx),
k AS (SELECT * FROM w WHERE platform = 'K'), p AS (SELECT * FROM w WHERE platform = 'P')
SELECT k.event_id AS k_id, p.event_id AS p_id, string_agg(keyword, '|' ORDER BY keyword) AS common_keywords FROM k JOIN p USING (keyword) GROUP BY ALL""")
def j1_blocked_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs that share a keyword, whatever its frequency."""
    pairs = candidates.blocked_pairs(index(spark, sf_dir, "v_listings"))
    return pairs.withColumn("common_keywords", F.array_join("common_keywords", "|"))


def _account_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K and P events of one account and their features: every event has several partners."""
    feats = rules.pair_features(index(spark, sf_dir))
    k = rules.side(feats.where("platform = 'K'"), "k").withColumnRenamed("k_event_id", "k_id")
    p = rules.side(feats.where("platform = 'P'"), "p").withColumnRenamed("p_event_id", "p_id")
    pairs = k.join(p, col("p_account") == col("k_account"))
    return pairs.withColumn("common_keywords", F.array_sort(F.array_intersect("k_keywords", "p_keywords")))


_LOW = "regexp_replace(lower(coalesce(title, '')), '[^a-z0-9 ]+', ' ', 'g')"
_PADDED = "(' ' || trim(regexp_replace(lower(event_id || ' ' || title || ' ' || category || ' ' || sub_category), '[^a-z0-9 ]+', ' ', 'g')) || ' ')"
ACCOUNT_PAIRS = f"""{INDEX}, f AS (SELECT *, {TOKENS} AS tokens, (regexp_matches({_PADDED}, ' (match|game|maps?|bo1|bo3|bo5|vs) ') OR contains(regexp_replace({_PADDED}, '[^a-z0-9]+', '', 'g'), 'map')) AS is_match,
  regexp_matches({_PADDED}, ' (tournament|championship|champion|major|cup|open|season winner|season) ') AS is_event FROM idx),
nb AS (SELECT k.event_id AS k_id, p.event_id AS p_id, k.keywords AS kk, p.keywords AS pk, k.tokens AS kt, p.tokens AS pt, k.is_match AS km, k.is_event AS ke, p.is_match AS pm, p.is_event AS pe,
  k.title AS k_title, p.title AS p_title, list_sort(list_intersect(k.keywords, p.keywords)) AS common FROM f k JOIN f p ON k.platform = 'K' AND p.platform = 'P' AND p.account = k.account),
ev AS (SELECT *, list_distinct(list_transform(list_filter(common, lambda w: NOT list_contains({sql_list(lx.GENERIC_SINGLE_KEYWORDS)}, w)), lambda w: {_SING})) AS evidence FROM nb),
m AS (SELECT *, len(evidence) AS n, len(list_filter(evidence, lambda w: NOT list_contains({sql_list(lx.GENERIC_SINGLE_KEYWORDS)}, w) AND (regexp_matches(w, '[ 0-9-]') OR length(w) >= 9))) AS d,
  CASE WHEN least(len(kt), len(pt)) > 0 THEN len(list_intersect(kt, pt)) / least(len(kt), len(pt)) ELSE 0 END AS ov,
  CASE WHEN least(len(kt), len(pt)) > 0 THEN len(list_intersect(kt, pt)) / (len(kt) + len(pt) - len(list_intersect(kt, pt))) ELSE 0 END AS jac,
  CASE WHEN least(len(kk), len(pk)) > 0 THEN len(evidence) / least(len(kk), len(pk)) ELSE 0 END AS ratio FROM ev)"""


@query(f"SELECT k_id, p_id, array_to_string(list_sort(evidence), '|') AS evidence, n, d AS n_distinct, round(ov, 6) AS ov, round(jac, 6) AS jac, round(ratio, 6) AS ratio FROM (WITH {ACCOUNT_PAIRS} SELECT * FROM m) z")
def r16_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rules.with_evidence(_account_pairs(spark, sf_dir))
    return out.select("k_id", "p_id", F.array_join("evidence", "|").alias("evidence"), "n", "n_distinct", *(F.round(c, 6).alias(c) for c in ("ov", "jac", "ratio")))


@query(f"""WITH {ACCOUNT_PAIRS} SELECT k_id, p_id, CASE WHEN len(kk) = 0 OR len(pk) = 0 THEN false WHEN n >= 3 THEN CASE WHEN d > 0 THEN ov >= 0.35 OR jac >= 0.22 OR ratio >= 0.45 ELSE ov >= 0.60 OR jac >= 0.30 OR ratio >= 0.55 END
 WHEN n = 2 THEN ratio >= 0.45 OR d > 0 OR (ov >= 0.55 AND jac >= 0.30) WHEN n = 1 THEN (d > 0 AND ov >= 0.50 AND jac >= 0.25) OR (ov >= 0.65 AND jac >= 0.30) ELSE false END AS by_keywords,
 n >= 2 AND CASE WHEN n >= 3 THEN ov >= 0.35 OR jac >= 0.22 WHEN d > 0 THEN ov >= 0.45 OR jac >= 0.25 ELSE ov >= 0.60 OR jac >= 0.30 END AS in_broad_mode FROM m""")
def r12_r14_keeps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R12 without category support, and R14."""
    out = rules.with_evidence(_account_pairs(spark, sf_dir)).withColumn("has_support", F.lit(False))
    return out.select("k_id", "p_id", rules.keeps_by_keywords().alias("by_keywords"), rules.keeps_in_broad_mode().alias("in_broad_mode"))


@query(f"""WITH {ACCOUNT_PAIRS}, s AS (SELECT *, n * 70 + d * 35 + CAST(trunc(ov * 100) AS INT) + CAST(trunc(jac * 160) AS INT) + 45 + 35 + CASE WHEN len(kt) > 0 AND kt = pt THEN 140 ELSE 0 END - CASE WHEN n <= 1 AND d = 0 THEN 80 ELSE 0 END - CASE WHEN jac < 0.22 AND ov < 0.50 THEN 60 ELSE 0 END AS score FROM m),
t AS (SELECT *, CASE WHEN (len(kt) > 0 AND kt = pt) OR (jac >= 0.75 AND ov >= 0.85) THEN 'exact' WHEN score >= 430 THEN 'strong' WHEN score >= 270 THEN 'medium' ELSE 'weak' END AS tier FROM s)
SELECT k_id, p_id, CASE WHEN tier = 'weak' AND n = 1 AND ov >= 0.65 AND jac >= 0.33 THEN greatest(score, 270) ELSE score END AS quality_score, CASE WHEN tier = 'weak' AND n = 1 AND ov >= 0.65 AND jac >= 0.33 THEN 'medium' ELSE tier END AS quality_tier, 'category_keywords' AS path FROM t""")
def r15_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rules.with_evidence(_account_pairs(spark, sf_dir)).withColumn("has_support", F.lit(False))
    flags = {"by_category": F.lit(True), "by_keywords": F.lit(True), "by_title": F.lit(False), "mode": F.lit("exact_specific")}
    return rules.with_quality(out.withColumns(flags)).select("k_id", "p_id", "quality_score", "quality_tier", "path")


@query(f"WITH {ACCOUNT_PAIRS} SELECT k_id, p_id, (km AND pe AND NOT ke) OR (pm AND ke AND NOT pe) AS granularity_conflict FROM m")
def r9_granularity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _account_pairs(spark, sf_dir).select("k_id", "p_id", rules.granularity_conflict().alias("granularity_conflict"))


@query()
def r1_hard_reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R1, R4 to R11 and R23 on events of one account; the parts have oracles of their own, the order is tested."""
    pairs = rules.with_evidence(_account_pairs(spark, sf_dir))
    return pairs.select("k_id", "p_id", rules.hard_reject_reason().alias("reason"), rules.preverify_reject_reason().alias("preverify_reason"))


_DIRS = sql_named(PLAIN, lx.DIRECTIONS)
_GRP = r"list_sort(list_distinct(list_filter(list_transform(regexp_extract_all(title, '(?i)\bgroup\s+([a-z0-9]+)\b', 1), lambda v: lower(v)), lambda v: length(v) = 1 OR regexp_matches(v, '^[0-9]+$'))))"
_DIS = r"list_sort(list_distinct(list_transform(regexp_extract_all(title, '(?i)\b([a-z]{2}-(?:\d{1,2}|al))\b', 1), lambda v: upper(v))))"


@query(f"""WITH t AS (SELECT event_id, platform, account, {_GRP} AS groups, {_DIS} AS districts, string_split({_DIRS}, '|') AS directions FROM v_titles),
j AS (SELECT k.event_id AS k_id, p.event_id AS p_id, k.groups AS kg, p.groups AS pg, k.districts AS kd, p.districts AS pd, k.directions AS kr, p.directions AS pr FROM t k JOIN t p ON k.platform = 'K' AND p.platform = 'P' AND p.account = k.account)
SELECT k_id, p_id, (len(kg) > 0 AND len(pg) > 0 AND len(list_intersect(kg, pg)) = 0) AS groups_conflict, (len(kd) > 0 AND len(pd) > 0 AND len(list_intersect(kd, pd)) = 0) AS districts_conflict,
 (kr <> [''] AND pr <> [''] AND len(list_intersect(kr, pr)) = 0) AS directions_conflict FROM j""")
def r18_explicit_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three of the strict fields; the whole rule is in r17_semantic_features."""
    prof = events.profiles(index(spark, sf_dir), LEXICON)
    k, p = rules.side(prof.where("platform = 'K'"), "k"), rules.side(prof.where("platform = 'P'"), "p")
    has = lambda f: F.array_contains(rules.explicit_conflicts(), f).alias(f"{f}_conflict")
    return k.join(p, col("p_account") == col("k_account")).select(col("k_event_id").alias("k_id"), col("p_event_id").alias("p_id"), has("groups"), has("districts"), has("directions"))


@query()
def x29_event_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X28 and X29 whole; the fields have oracles of their own."""
    prof = events.profiles(index(spark, sf_dir), LEXICON)
    arrays = [F.array_join(f, "|").alias(f) for f in (*events.FIELDS, "entities")]
    return prof.select("event_id", "platform", "domain", *arrays, "occurrence_key", "proposition_key")


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    idx = index(spark, sf_dir)
    prof = events.profiles(idx, LEXICON)
    base = rules.with_evidence(_account_pairs(spark, sf_dir))
    flags = {"by_category": F.lit(True), "by_keywords": F.lit(True), "by_title": F.lit(False), "mode": F.lit("exact_specific")}
    pairs = rules.with_quality(base.withColumns(flags)).select("k_id", "p_id", "common_keywords", "quality_score", "quality_tier", "ov", "jac", "n")
    return candidates.semantic_features(pairs, prof, candidates.keyword_statistics(idx))


@query()
def r17_semantic_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J4, R17 and R18 on events of one account."""
    out = _scored(spark, sf_dir)
    return out.select("k_id", "p_id", "rarest_df", "exact_fixture", *(F.array_join(c, "|").alias(c) for c in ("explicit_conflicts", "one_sided", "primary_anchors")), "semantic_score")


@query()
def r19_prune_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of reasons over the events of one account."""
    return candidates.prune(_scored(spark, sf_dir)).groupBy("prune_reason").agg(F.count(F.lit(1)).alias("n"))


_RANKED = "SELECT k_id, p_id, quality, row_number() OVER (PARTITION BY k_id ORDER BY quality DESC, p_id) AS k_rank, row_number() OVER (PARTITION BY p_id ORDER BY quality DESC, k_id) AS p_rank, count(*) OVER (PARTITION BY k_id) AS k_fanout, count(*) OVER (PARTITION BY p_id) AS p_fanout FROM v_matches"


@query(_RANKED)
def w1_reciprocal_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 and G18."""
    pairs = view(spark, sf_dir, "v_matches").withColumn("semantic_score", col("quality").cast("double")).withColumn("quality_score", F.lit(0))
    return candidates.with_reciprocal_ranks(pairs).select("k_id", "p_id", "quality", "k_rank", "p_rank", "k_fanout", "p_fanout")


@query("""WITH k AS (SELECT * FROM v_outcomes WHERE venue = 'K'), p AS (SELECT * FROM v_outcomes WHERE venue = 'P'),
j AS (SELECT k.bet_id AS k_bet, p.bet_id AS p_bet, abs(k.size_no - p.size_no) AS gap, row_number() OVER (PARTITION BY k.bet_id ORDER BY abs(k.size_no - p.size_no), p.bet_id) AS rn FROM k JOIN p ON k.outcome_key = p.outcome_key AND abs(k.size_no - p.size_no) <= 10)
SELECT k_bet, p_bet, gap, rn FROM j WHERE rn <= 5""")
def j3_w2_outcome_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The outcome key joins, gaps are bounded, the best five per K bet stay."""
    from xmarket.operators.outcomes import nearest_outcomes

    o = view(spark, sf_dir, "v_outcomes")
    k, p = o.where("venue = 'K'").select(col("bet_id").alias("k_bet"), "outcome_key", col("size_no").alias("ks")), o.where("venue = 'P'").select(col("bet_id").alias("p_bet"), "outcome_key", col("size_no").alias("ps"))
    return nearest_outcomes(k, p, 10, 5)


@query("""WITH o AS (SELECT *, count(DISTINCT outcome_key) OVER (PARTITION BY event_id, venue) AS subjects FROM v_outcomes) SELECT bet_id, subjects, subjects > 1 AS multi FROM o""")
def g5_multi_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    from xmarket.operators.outcomes import with_subject_count

    return with_subject_count(view(spark, sf_dir, "v_outcomes"), "event_id", "venue").select("bet_id", col("event_subject_count").alias("subjects"), (col("event_subject_count") > 1).alias("multi"))


@query("""SELECT left(sha256('bet|' || k_event || '|' || p_event), 20) AS bundle_id, k_event, p_event, count(*) AS n, min(k_bet) AS first_k, string_agg(p_bet, ',' ORDER BY k_bet, p_bet) AS members
FROM (SELECT k.event_id AS k_event, p.event_id AS p_event, k.bet_id AS k_bet, p.bet_id AS p_bet FROM v_outcomes k JOIN v_outcomes p ON k.venue = 'K' AND p.venue = 'P' AND k.outcome_key = p.outcome_key AND k.size_no = p.size_no) x GROUP BY k_event, p_event""")
def g7_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    from xmarket.operators.outcomes import joined_bundles

    o = view(spark, sf_dir, "v_outcomes")
    k = o.where("venue = 'K'").select(col("event_id").alias("k_event"), col("bet_id").alias("k_bet"), "outcome_key", "size_no")
    p = o.where("venue = 'P'").select(col("event_id").alias("p_event"), col("bet_id").alias("p_bet"), "outcome_key", "size_no")
    return joined_bundles(k, p, ["outcome_key", "size_no"], "bet")


@query("SELECT CASE WHEN size_no > 40 THEN 'large' ELSE 'small' END AS candidate_type, count(*) AS n FROM v_outcomes GROUP BY ALL")
def g6_type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(col("size_no") > 40, "large").otherwise("small").alias("candidate_type")
    return view(spark, sf_dir, "v_outcomes").groupBy(kind).agg(F.count(F.lit(1)).alias("n"))


@query("""WITH RECURSIVE e AS (SELECT 'k:' || k_id AS a, 'p:' || p_id AS b FROM v_edges), both_ways AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r AS (SELECT a AS node, a AS reach FROM both_ways UNION SELECT r.node, w.b FROM r JOIN both_ways w ON w.a = r.reach), c AS (SELECT node, min(reach) AS component FROM r GROUP BY node)
SELECT component, count(*) AS nodes, max(edges) AS edges FROM c JOIN (SELECT component AS comp, count(*) AS edges FROM (SELECT DISTINCT a, b FROM e) x JOIN c ON c.node = x.a GROUP BY component) y ON y.comp = c.component GROUP BY component""")
def g19_component_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S7 and G19."""
    return candidates.component_statistics(view(spark, sf_dir, "v_edges"))


@query("""WITH RECURSIVE e AS (SELECT DISTINCT k_id AS a, p_id + 1000000 AS b FROM v_edges), both_ways AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r AS (SELECT a AS node, a AS reach FROM both_ways UNION SELECT r.node, w.b FROM r JOIN both_ways w ON w.a = r.reach) SELECT node, min(reach) AS component FROM r GROUP BY node""")
def s7_connected_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return connected_components(view(spark, sf_dir, "v_edges").select(col("k_id").alias("src"), (col("p_id") + 1000000).alias("dst")))


@query()
def s8_greedy_exclusive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5 and S8; compared with a scan in the tests."""
    return candidates.greedy_exclusive(view(spark, sf_dir, "v_edges"), [F.desc("quality"), F.asc("k_id"), F.asc("p_id")])


@query()
def s6_maximum_weight_matching(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges of the optimum; it may not be unique, so tests compare totals."""
    return matching.maximum_weight_matching(view(spark, sf_dir, "v_edges").withColumn("weight", col("quality")))


@query("SELECT k_id, p_id, quality, row_number() OVER (ORDER BY quality DESC, k_id, p_id) AS cluster_id FROM v_edges")
def w3_sequential_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from xmarket.operators.sync import sequential_ids

    return sequential_ids(view(spark, sf_dir, "v_edges"), [F.desc("quality"), F.asc("k_id"), F.asc("p_id")])


@query("""SELECT pair_id, CAST(round(confidence * 10000) AS BIGINT) + pair_id % 50 + 10 * (pair_id % 7) + CASE WHEN pair_id % 2 = 0 THEN 300 ELSE 0 END AS weight FROM v_decisions""")
def r28_decision_weight(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = F.when(col("pair_id") % 2 == 0, "review").otherwise("cheap")
    return view(spark, sf_dir, "v_decisions").select("pair_id", matching.decision_weight(col("confidence").cast("double"), col("pair_id") % 50, col("pair_id") % 7, stage).alias("weight"))
