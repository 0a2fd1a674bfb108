"""Queries of decisions, consensus, metrics, pricing and sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from xmarket.functions import contracts, hashing, pricing
from xmarket.functions.text import strings
from xmarket.operators import decisions, metrics
from xmarket.plans.registry import query
from xmarket.plans.views import base, view

col = F.col

_SAID = "CASE WHEN status = 'valid' THEN actual ELSE 'AMBIGUOUS' END"


def _metrics_sql(keys: str, source: str) -> str:
    head = f"{keys}, " if keys else ""
    group = f"GROUP BY {keys}" if keys else ""
    return f"""WITH s AS (SELECT *, {_SAID} AS said FROM {source}), c AS (SELECT {head}count(*) AS n, count(*) FILTER (expected = 'MATCH' AND said = 'MATCH') AS tp, count(*) FILTER (expected = 'NO_MATCH' AND said = 'MATCH') AS fp,
 count(*) FILTER (expected = 'MATCH' AND said = 'NO_MATCH') AS fn, count(*) FILTER (expected = 'NO_MATCH' AND said = 'NO_MATCH') AS tn, count(*) FILTER (said <> 'AMBIGUOUS') AS cov, count(*) FILTER (expected = 'MATCH') AS pos, count(*) FILTER (expected = 'NO_MATCH') AS neg FROM s {group}),
r AS (SELECT *, coalesce(tp / nullif(tp + fp, 0), 0) AS p, coalesce(tp / nullif(pos, 0), 0) AS rc FROM c)
SELECT {head}n, tp, fp, fn, tn, round(p, 6) AS precision, round(rc, 6) AS recall, round(coalesce(2 * p * rc / nullif(p + rc, 0), 0), 6) AS f1, round(coalesce(fp / nullif(neg, 0), 0), 6) AS fpr, round(coalesce(fn / nullif(pos, 0), 0), 6) AS fnr,
 round(cov / n, 6) AS coverage, fn AS unsafe_rejects, round(coalesce(tn / nullif(tn + fn, 0), 0), 6) AS safe_reject_precision, round(coalesce(tn / nullif(neg, 0), 0), 6) AS safe_reject_recall FROM r"""


RATES = ("precision", "recall", "f1", "fpr", "fnr", "coverage", "safe_reject_precision", "safe_reject_recall")


def _round(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in RATES if c in df.columns})


@query(_metrics_sql("", "v_decisions"))
def g10_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(metrics.confusion(view(spark, sf_dir, "v_decisions")))


@query(_metrics_sql("provenance", "v_decisions"))
def g10_metrics_by_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(metrics.confusion(view(spark, sf_dir, "v_decisions"), "provenance"))


_LONG = "long_rows AS (SELECT 'tier' AS dimension, tier AS value, * FROM v_decisions UNION ALL SELECT 'provenance', provenance, * FROM v_decisions)"


@query(_metrics_sql("dimension, value", "long_rows").replace("WITH s AS", f"WITH {_LONG}, s AS"))
def g10_metrics_by_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(metrics.confusion_by_segment(view(spark, sf_dir, "v_decisions"), ["tier", "provenance"]))


@query("SELECT provenance, expected, actual, count(*) AS n FROM v_decisions GROUP BY ALL")
def g11_confusion_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.confusion_counts(view(spark, sf_dir, "v_decisions"), "provenance")


@query("SELECT 'all' AS dimension, 'all' AS value, count(*) AS n FROM v_decisions UNION ALL SELECT 'expected', expected, count(*) FROM v_decisions GROUP BY expected UNION ALL SELECT 'tier', tier, count(*) FROM v_decisions GROUP BY tier")
def g21_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.manifest(view(spark, sf_dir, "v_decisions"), "expected", "tier")


def _with_evidence(df: DataFrame) -> DataFrame:
    some = lambda n, *v: F.when(col("pair_id") % n == 0, strings(v)).otherwise(F.array().cast("array<string>"))
    return df.withColumn("decision", col("actual")).withColumn("conflicts", some(2, "date")).withColumn("evidence", some(3, "a", "b")).withColumn("missing", some(5, "m"))


_SWEEP = """SELECT s.strategy, t.threshold, count(*) FILTER (ok) AS accepted, count(*) FILTER (ok AND expected = 'MATCH') AS unsafe FROM (SELECT unnest([0.2, 0.5, 0.8]) AS threshold) t,
 (SELECT unnest(['any', 'explicit', 'strict']) AS strategy) s, LATERAL (SELECT expected, actual = 'NO_MATCH' AND status = 'valid' AND confidence >= t.threshold AND (s.strategy = 'any' OR (pair_id % 6 = 0 AND (s.strategy = 'explicit' OR pair_id % 5 <> 0))) AS ok FROM v_decisions) d GROUP BY ALL"""


@query(_SWEEP)
def g17_threshold_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.threshold_sweep(_with_evidence(view(spark, sf_dir, "v_decisions")), [0.2, 0.5, 0.8])


@query(f"WITH w AS ({_SWEEP}), r AS (SELECT *, row_number() OVER (PARTITION BY strategy ORDER BY accepted DESC, threshold DESC) AS rn FROM w WHERE unsafe = 0) SELECT strategy, threshold, accepted FROM r WHERE rn = 1")
def g17_best_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.best_threshold(metrics.threshold_sweep(_with_evidence(view(spark, sf_dir, "v_decisions")), [0.2, 0.5, 0.8]))


@query("SELECT provenance AS model FROM (SELECT provenance, count(*) FILTER (expected = 'MATCH' AND actual = 'MATCH') / count(*) AS r, avg(confidence) AS c FROM v_decisions GROUP BY provenance) x ORDER BY CASE WHEN r > 0.5 THEN 0 ELSE 1 END, round(r, 6) DESC, round(c, 6), provenance LIMIT 1")
def t4_choose_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "v_decisions").groupBy(col("provenance").alias("model")).agg((F.count_if((col("expected") == "MATCH") & (col("actual") == "MATCH")) / F.count(F.lit(1))).alias("r"), F.avg("confidence").cast("double").alias("c"))
    return metrics.choose_best(rows.select("model", F.round("r", 6).alias("recall"), F.lit(0.0).alias("precision"), F.round("c", 6).alias("cost"), (col("r") > 0.5).alias("eligible")))


@query("""WITH r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY sha256(CAST(doc_id AS VARCHAR)), doc_id) AS rn FROM documents) SELECT doc_id, lang, rn FROM r ORDER BY rn, lang LIMIT 50""")
def g20_stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.stratified(base(spark, sf_dir, "documents").select("doc_id", "lang"), "lang", 50, "doc_id")


@query("""SELECT doc_id, CASE WHEN CAST('0x' || substr(sha256(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % 10 < 2 THEN 'holdout' ELSE 'dev' END AS split,
 CASE WHEN CAST('0x' || substr(sha256(CAST(doc_id AS VARCHAR)), 63, 2) AS BIGINT) % 5 = 0 THEN 'holdout' ELSE 'dev' END AS silver FROM documents""")
def x46_hash_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = col("doc_id").cast("string")
    return base(spark, sf_dir, "documents").select("doc_id", metrics.holdout(c).alias("split"), metrics.holdout_of_five(c).alias("silver"))


@query("""WITH p AS (SELECT * FROM (VALUES ('gpt-5', 1.25, 0.125, 10.0), ('gpt-5-mini', 0.25, 0.025, 2.0)) t(prefix, i, c, o))
SELECT conv_id, turn, round(((input_tokens - cached_tokens) * i + cached_tokens * c + output_tokens * o) / 1000000.0, 9) AS cost FROM v_usage JOIN p ON p.prefix = model""")
def x47_usage_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices = spark.sql("SELECT * FROM VALUES ('gpt-5', 1.25D, 0.125D, 10.0D), ('gpt-5-mini', 0.25D, 0.025D, 2.0D) AS t(prefix, input, cached_input, output)")
    out = pricing.with_rates(view(spark, sf_dir, "v_usage"), prices)
    return out.select("conv_id", "turn", F.round(pricing.usage_cost(*(col(c) for c in ("input_tokens", "cached_tokens", "output_tokens", "input", "cached_input", "output"))), 9).alias("cost"))


@query("""WITH n AS (SELECT *, count(*) OVER (PARTITION BY conv_id) AS n, sum(chars) OVER (PARTITION BY conv_id) AS total, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS place FROM v_usage)
SELECT conv_id, turn, CAST(floor(total / n) + CASE WHEN place < total % n THEN 1 ELSE 0 END AS BIGINT) AS share FROM n""")
def x48_usage_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql.window import Window

    w = Window.partitionBy("conv_id")
    n = view(spark, sf_dir, "v_usage").select("conv_id", "turn", F.count(F.lit(1)).over(w).alias("n"), F.sum("chars").over(w).alias("total"), (F.row_number().over(w.orderBy("turn")) - 1).alias("place"))
    return n.select("conv_id", "turn", pricing.usage_share(col("total"), col("n"), col("place")).alias("share"))


@query("SELECT l_orderkey, l_linenumber, round(0.07 * l_discount * (1 - l_discount), 8) AS fee FROM lineitem")
def x49_venue_fee(spark: SparkSession, sf_dir: str) -> DataFrame:
    return base(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.round(pricing.venue_fee(col("l_discount")), 8).alias("fee"))


@query("SELECT count(*) AS n, CAST(sum(greatest(1, ceil(length(text) / 4.0))) AS BIGINT) AS tokens_low, CAST(sum(greatest(1, ceil(length(text) / 3.5))) AS BIGINT) AS tokens_high FROM conversations")
def g15_batch_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.estimate(base(spark, sf_dir, "conversations")).select("n", "tokens_low", "tokens_high")


@query("SELECT model, count(*) AS calls, CAST(sum(input_tokens) AS BIGINT) AS input_tokens, CAST(sum(output_tokens) AS BIGINT) AS output_tokens, round(sum(input_tokens * 0.5), 3) AS cost FROM v_usage GROUP BY model")
def g12_usage_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.usage_summary(view(spark, sf_dir, "v_usage").withColumn("cost", col("input_tokens") * 0.5), "model").withColumn("cost", F.round("cost", 3))


@query("SELECT round(coalesce(sum(value), 0), 2) AS cost FROM events WHERE year(ts) = 2024 AND month(ts) = 1")
def g13_monthly_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.monthly_cost(base(spark, sf_dir, "events").select("ts", col("value").alias("cost")), 2024, 1).select(F.round("cost", 2).alias("cost"))


@query("SELECT lang AS tag, count(*) AS n FROM (SELECT unnest([lang, source]) AS lang FROM documents) x WHERE lang <> 'src0' GROUP BY lang")
def g3_tag_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = base(spark, sf_dir, "documents").select(F.concat_ws(" , ", "lang", "source", F.lit("")).alias("tags"))
    return metrics.tag_histogram(rows, "tags", ("src0",))


@query("SELECT lang, count(*) AS n FROM documents GROUP BY lang ORDER BY n DESC, lang LIMIT 50")
def g4_category_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return base(spark, sf_dir, "documents").groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(50)


_FOUR = """f AS (SELECT pair_id, status AS s1, CASE WHEN pair_id % 7 = 0 THEN 'error' ELSE 'valid' END AS s2, CASE WHEN pair_id % 5 = 0 THEN NULL ELSE 'valid' END AS s3, CASE WHEN pair_id % 4 = 0 THEN NULL ELSE 'valid' END AS s4,
 expected AS d1, actual AS d2, CASE WHEN pair_id % 3 = 0 THEN 'NO_MATCH' WHEN pair_id % 3 = 1 THEN 'MATCH' ELSE 'AMBIGUOUS' END AS d3, CASE WHEN pair_id % 2 = 0 THEN 'NO_MATCH' ELSE 'MATCH' END AS d4 FROM v_decisions)"""


@query(f"""WITH {_FOUR}, g AS (SELECT *, CASE WHEN s3 = 'valid' THEN d3 END AS e3, CASE WHEN s4 = 'valid' THEN d4 END AS e4 FROM f)
SELECT pair_id, CASE WHEN s1 <> 'valid' OR s2 <> 'valid' THEN 'invalid_initial' WHEN d1 = d2 AND d2 <> 'AMBIGUOUS' THEN 'initial_agreement' WHEN s3 IS NULL THEN 'needs_frontier' WHEN d2 = d3 AND d3 = 'NO_MATCH' THEN 'strong_agreement'
 WHEN d2 = d3 AND d3 = 'AMBIGUOUS' THEN 'strong_ambiguous' WHEN s4 IS NULL THEN 'needs_tiebreak' WHEN (d2 = 'NO_MATCH')::INT + (d3 = 'NO_MATCH')::INT + (d4 = 'NO_MATCH')::INT >= 2 THEN 'majority_no' WHEN d3 = 'MATCH' AND d4 = 'MATCH' THEN 'frontier_tiebreak_match' ELSE 'abstain' END AS route FROM g""")
def s2_consensus_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, pid = view(spark, sf_dir, "v_decisions"), col("pair_id")
    rows = d.select(
        "pair_id", col("status").alias("primary_status"), F.when(pid % 7 == 0, "error").otherwise("valid").alias("secondary_status"), F.when(pid % 5 != 0, "valid").alias("frontier_status"), F.when(pid % 4 != 0, "valid").alias("tiebreak_status"),
        col("expected").alias("primary_decision"), col("actual").alias("secondary_decision"), F.when(pid % 3 == 0, "NO_MATCH").when(pid % 3 == 1, "MATCH").otherwise("AMBIGUOUS").alias("frontier_decision"),
        F.when(pid % 2 == 0, "NO_MATCH").otherwise("MATCH").alias("tiebreak_decision"), *(F.lit("Identical").alias(f"{n}_relation") for n in ("primary", "secondary", "frontier", "tiebreak")),
    )
    return decisions.consensus(rows).select("pair_id", "route")


@query("""SELECT pair_id, CASE WHEN pair_id % 3 = 0 THEN CASE WHEN pair_id % 5 = 0 THEN 'AMBIGUOUS' ELSE 'NO_MATCH' END WHEN status <> 'valid' THEN 'AMBIGUOUS' WHEN actual = 'MATCH' AND confidence < 0.80 THEN 'AMBIGUOUS' ELSE actual END AS decision,
 CASE WHEN pair_id % 3 = 0 THEN 'review' ELSE 'cheap' END AS stage FROM v_decisions""")
def s1_final_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    pid = col("pair_id")
    rows = view(spark, sf_dir, "v_decisions").select(
        "pair_id", F.when(pid % 3 == 0, "NO_MATCH").alias("review_decision"), F.when(pid % 5 == 0, "error").otherwise("valid").alias("review_status"), F.lit(0.9).alias("review_confidence"),
        col("actual").alias("cheap_decision"), col("status").alias("cheap_status"), col("confidence").cast("double").alias("cheap_confidence"),
    )
    decision, stage = decisions.final_decision(["review", "cheap"])
    return rows.select("pair_id", decision.alias("decision"), stage.alias("stage"))


@query("""SELECT pair_id, actual = 'NO_MATCH' AND confidence >= 0.86 AND pair_id % 2 = 0 AND pair_id % 3 = 0 AS explicit_no, (status <> 'valid' OR actual = 'AMBIGUOUS' OR (actual = 'MATCH' AND confidence < 0.80)) AS needs_review,
 NOT (status = 'valid' AND actual = 'NO_MATCH' AND confidence >= 0.86 AND pair_id % 2 = 0 AND pair_id % 3 = 0) AS needs_detail FROM v_decisions""")
def f11_f12_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _with_evidence(view(spark, sf_dir, "v_decisions"))
    four = [col(c) for c in ("decision", "confidence", "conflicts", "evidence")]
    return d.select("pair_id", decisions.explicit_no(*four).alias("explicit_no"), decisions.needs_review(col("status"), col("decision"), col("confidence")).alias("needs_review"), decisions.needs_detail(col("status"), *four).alias("needs_detail"))


@query("""WITH a AS (SELECT pair_id, CASE WHEN pair_id % 9 = 0 THEN 'missing_id' WHEN pair_id % 8 = 0 THEN 'bad_decision' WHEN actual = 'MATCH' AND pair_id % 5 = 0 THEN 'match_without_relation' ELSE '' END AS error, actual FROM v_decisions)
SELECT pair_id, CASE WHEN error = '' THEN 'valid' ELSE 'error' END AS status, error, CASE WHEN error <> '' THEN 'AMBIGUOUS' WHEN actual = 'NO_MATCH' AND pair_id % 2 <> 0 THEN 'AMBIGUOUS' WHEN actual = 'MATCH' AND pair_id % 2 = 0 THEN 'AMBIGUOUS' ELSE actual END AS decision FROM a""")
def x51_decode_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, pid = view(spark, sf_dir, "v_decisions"), col("pair_id")
    code = F.when(pid % 8 == 0, "?").when(col("actual") == "MATCH", "M").when(col("actual") == "NO_MATCH", "N").otherwise("A")
    one = F.struct(
        pid.cast("string").alias("id"), code.alias("d"), F.when(pid % 5 == 0, "N").otherwise("I").alias("r"), F.lit(1.5).alias("c"),
        F.when(pid % 2 == 0, strings(["date"])).otherwise(F.array().cast("array<string>")).alias("x"), F.array().cast("array<string>").alias("m"), strings(["e"]).alias("e"), F.lit(1).alias("q"),
    )
    answers = d.where(pid % 9 != 0).select(pid.cast("string").alias("batch_id"), F.to_json(F.struct(F.array(one).alias("decisions"))).alias("answer"))
    expected = d.select(pid.cast("string").alias("pair_id"), pid.cast("string").alias("batch_id"))
    return decisions.decode(answers, expected).select(col("pair_id").cast("long").alias("pair_id"), "status", "error", "decision")


@query("""WITH c AS (SELECT pair_id, decision, count(*) AS n, min(conf) AS confidence, min(annotator) AS first FROM (
  SELECT pair_id, 'a' AS annotator, expected AS decision, 0.9 AS conf FROM v_decisions UNION ALL SELECT pair_id, 'b', actual, 0.8 FROM v_decisions UNION ALL SELECT pair_id, 'c', CASE WHEN pair_id % 2 = 0 THEN 'MATCH' ELSE 'AMBIGUOUS' END, 0.7 FROM v_decisions) v GROUP BY pair_id, decision),
r AS (SELECT *, row_number() OVER (PARTITION BY pair_id ORDER BY n DESC, first) AS rn FROM c)
SELECT pair_id, CASE WHEN pair_id % 10 = 0 THEN 'NO_MATCH' ELSE decision END AS decision, n, CAST(CASE WHEN pair_id % 10 = 0 THEN 1.0 ELSE confidence END AS DOUBLE) AS confidence, (pair_id % 10 = 0 OR n >= 2) AS accepted FROM r WHERE rn = 1""")
def g14_majority_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, pid = view(spark, sf_dir, "v_decisions"), col("pair_id")
    one = lambda name, value, conf: d.select("pair_id", F.lit(name).alias("annotator"), value.alias("decision"), F.lit("-").alias("relation"), F.lit(conf).alias("confidence"))
    votes = one("a", col("expected"), 0.9).unionByName(one("b", col("actual"), 0.8)).unionByName(one("c", F.when(pid % 2 == 0, "MATCH").otherwise("AMBIGUOUS"), 0.7))
    human = d.where(pid % 10 == 0).select("pair_id", F.lit("NO_MATCH").alias("decision"), F.lit("-").alias("relation"))
    return decisions.majority(votes, human).select("pair_id", "decision", "n", "confidence", "accepted")


@query()
def w8_greedy_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W8 with the conversation's model as the lane; compared with a loop in the tests."""
    u = view(spark, sf_dir, "v_usage").select(F.concat_ws("-", "conv_id", "turn").alias("pair_id"), "chars", "model")
    return decisions.batches(u, 20, 8000, lane_col="model")


@query("SELECT v.pair_id, CASE WHEN v.pair_id % 3 = 0 AND v.status = 'valid' THEN actual END AS cached_decision FROM v_decisions v")
def j16_cache_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = view(spark, sf_dir, "v_decisions")
    cache = d.where("pair_id % 3 = 0").select("pair_id", "provenance", "status", col("actual").alias("decision"))
    return decisions.cached(d.select("pair_id", "provenance"), cache, ["pair_id", "provenance"]).select("pair_id", "cached_decision")


@query("SELECT 100 + c_custkey % 300 + 80 * (CASE c_custkey % 4 WHEN 3 THEN 3 WHEN 2 THEN 2 WHEN 1 THEN 1 ELSE 0 END) + 60 * (c_custkey % 5) + CAST(trunc((c_custkey % 101) / 100.0 * 100 + 1e-9) AS INT) + 12 * (c_custkey % 3) + CASE WHEN (c_custkey % 101) / 100.0 >= 0.98 THEN 80 ELSE 0 END AS points, c_custkey FROM customer")
def t2_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = col("c_custkey")
    tier = F.element_at(strings(["weak", "medium", "strong", "exact"]), (k % 4 + 1).cast("int"))
    points = metrics.priority(100 + k % 300, tier, k % 5, (k % 101) / 100.0 + 1e-11, k % 3)
    return base(spark, sf_dir, "customer").select("c_custkey", points.cast("long").alias("points"))


@query("SELECT pair_id, left(sha256('{\"decision\":\"' || actual || '\",\"pair_id\":' || pair_id || ',\"tier\":\"' || tier || '\"}'), 20) AS key FROM v_decisions")
def x45_stable_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "v_decisions").select("pair_id", hashing.stable_hash({"tier": col("tier"), "pair_id": col("pair_id"), "decision": col("actual")}, 20).alias("key"))


_DAY = "CAST(regexp_extract(t, '(?i)\\b(\\d+)\\s+days?\\b', 1) AS VARCHAR)"


@query(r"""WITH t AS (SELECT o_orderkey, 'Will it take ' || CAST(o_custkey % 40 AS VARCHAR) || ' days or reach ' || CAST(o_custkey % 90 AS VARCHAR) || '.5% by ' || strftime(o_orderdate, '%b ') || CAST(day(o_orderdate) AS VARCHAR) || ', ' || CAST(year(o_orderdate) + 28 AS VARCHAR) || '?' AS t, o_custkey, o_orderdate FROM orders)
SELECT o_orderkey, CAST(o_custkey % 40 AS VARCHAR) AS days, CAST(o_custkey % 90 AS VARCHAR) || '.5' AS percent, CAST(year(o_orderdate) + 28 AS VARCHAR) || strftime(o_orderdate, '-%m-%d') AS deadline FROM t""")
def x40_x41_contract_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    date = F.concat(F.date_format("o_orderdate", "MMM "), F.dayofmonth("o_orderdate").cast("string"), F.lit(", "), (F.year("o_orderdate") + 28).cast("string"))
    t = F.concat(F.lit("Will it take "), (col("o_custkey") % 40).cast("string"), F.lit(" days or reach "), (col("o_custkey") % 90).cast("string"), F.lit(".5% by "), date, F.lit("?"))
    return base(spark, sf_dir, "orders").select("o_orderkey", contracts.day_threshold(t).alias("days"), contracts.percent_threshold(t).alias("percent"), contracts.deadline(t).alias("deadline"))


@query("SELECT l_orderkey, l_linenumber, (l_linenumber % 3 <> l_suppkey % 3) OR abs(datediff('day', CAST(l_shipdate AS DATE), CAST(l_shipdate AS DATE) + CAST(l_partkey % 4 AS INT))) > 1 AS conflict FROM lineitem")
def r24_contract_conflict(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    later = F.date_add(F.to_date("l_shipdate"), (col("l_partkey") % 4).cast("int"))
    k = {"days": (col("l_linenumber") % 3).cast("string"), "percent": F.lit(""), "deadline": day(col("l_shipdate"))}
    p = {"days": (col("l_suppkey") % 3).cast("string"), "percent": F.lit("5"), "deadline": day(later)}
    return base(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", contracts.hard_conflict(k, p).alias("conflict"))
