"""Reports over candidates and decisions: confusion metrics, sweeps, sampling, cost and audit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from xmarket.functions.pricing import estimated_tokens

col = F.col


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def confusion(df: DataFrame, *keys: str, expected: str = "expected", actual: str = "actual", status: str = "status") -> DataFrame:
    """Counts and rates; a missing or invalid record counts as AMBIGUOUS.  keys may be empty for one row in all."""
    said = F.when(col(status) == "valid", F.coalesce(col(actual), F.lit("AMBIGUOUS"))).otherwise("AMBIGUOUS")
    rows = df.withColumn("_said", said)
    n = lambda e, a: F.count_if((col(expected) == e) & (col("_said") == a))
    counts = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), n("MATCH", "MATCH").alias("tp"), n("NO_MATCH", "MATCH").alias("fp"), n("MATCH", "NO_MATCH").alias("fn"), n("NO_MATCH", "NO_MATCH").alias("tn"),
        F.count_if(col("_said") != "AMBIGUOUS").alias("covered"), F.count_if(col(expected) == "MATCH").alias("positives"), F.count_if(col(expected) == "NO_MATCH").alias("negatives"),
    )
    precision, recall = _ratio(col("tp"), col("tp") + col("fp")), _ratio(col("tp"), col("positives"))
    return counts.select(
        *keys, "n", "tp", "fp", "fn", "tn", precision.alias("precision"), recall.alias("recall"), _ratio(2 * precision * recall, precision + recall).alias("f1"),
        _ratio(col("fp"), col("negatives")).alias("fpr"), _ratio(col("fn"), col("positives")).alias("fnr"), _ratio(col("covered"), col("n")).alias("coverage"),
        col("fn").alias("unsafe_rejects"), _ratio(col("tn"), col("tn") + col("fn")).alias("safe_reject_precision"), _ratio(col("tn"), col("negatives")).alias("safe_reject_recall"),
    )


def confusion_by_segment(df: DataFrame, segments: list[str], **names: str) -> DataFrame:
    """The same per value of several dimensions, in one pass over the rows."""
    long = df.select("*", F.explode(F.array(*(F.struct(F.lit(s).alias("dimension"), col(s).cast("string").alias("value")) for s in segments))).alias("_s")).select("*", "_s.*").drop("_s")
    return confusion(long, "dimension", "value", **names)


def confusion_counts(df: DataFrame, *keys: str, expected: str = "expected", actual: str = "actual") -> DataFrame:
    """One row per (keys, expected, actual)."""
    return df.groupBy(*keys, expected, actual).agg(F.count(F.lit(1)).alias("n"))


def manifest(df: DataFrame, *keys: str) -> DataFrame:
    """Counts by each key alone and in all, as (dimension, value, n), in one grouping-sets pass."""
    picks = [F.struct(F.lit(k).alias("dimension"), col(k).cast("string").alias("value")) for k in keys]
    rows = df.select(F.explode(F.array(F.struct(F.lit("all").alias("dimension"), F.lit("all").alias("value")), *picks)).alias("s"))
    return rows.groupBy("s.dimension", "s.value").agg(F.count(F.lit(1)).alias("n"))


def eligible(threshold: Column | float, strategy: str) -> Column:
    """whether a no may be rejected without review: any, explicit (a conflict, two pieces of evidence) or strict (nothing missing)."""
    no = (col("decision") == "NO_MATCH") & (col("status") == "valid") & (col("confidence") >= threshold)
    explicit = no & (F.size("conflicts") > 0) & (F.size("evidence") >= 2)
    return {"any": no, "explicit": explicit, "strict": explicit & (F.size("missing") == 0)}[strategy]


def threshold_sweep(df: DataFrame, thresholds: list[float]) -> DataFrame:
    """Accepted and unsafe rejections per threshold and strategy of eligible(); thresholds are exploded onto rows."""
    rows = df.select("*", F.explode(F.array(*(F.lit(t) for t in thresholds))).alias("threshold"))
    tests = F.array(*(F.struct(F.lit(n).alias("strategy"), eligible(col("threshold"), n).alias("accept")) for n in ("any", "explicit", "strict")))
    long = rows.select("threshold", "expected", F.explode(tests).alias("s")).select("threshold", "expected", "s.*")
    return long.groupBy("strategy", "threshold").agg(F.count_if("accept").alias("accepted"), F.count_if(col("accept") & (col("expected") == "MATCH")).alias("unsafe"))


def best_threshold(sweep: DataFrame) -> DataFrame:
    """Per strategy the threshold that accepts most without an unsafe rejection; ties go to the higher one."""
    return sweep.where("unsafe = 0").groupBy("strategy").agg(F.max_by(F.struct("threshold", "accepted"), F.struct("accepted", "threshold")).alias("b")).select("strategy", "b.threshold", "b.accepted")


def choose_best(results: DataFrame) -> DataFrame:
    """T4: the model with the least (ineligible, -recall, -precision, cost, name)."""
    key = F.struct(F.when(col("eligible"), 0).otherwise(1).alias("a"), (-col("recall")).alias("b"), (-col("precision")).alias("c"), col("cost").alias("d"), col("model").alias("e"))
    return results.agg(F.min_by("model", key).alias("model"))


def stratified(df: DataFrame, stratum: str, quota: int, id_col: str = "id") -> DataFrame:
    """Round robin over strata in order, each in the order of a stable hash, until the quota is full.

    The rank within a stratum is bounded by the quota, so the sort keeps few rows per stratum.
    """
    w = Window.partitionBy(stratum).orderBy(F.sha2(col(id_col).cast("string"), 256), id_col)
    ranked = df.withColumn("rn", F.row_number().over(w)).where(col("rn") <= quota)
    return ranked.orderBy("rn", stratum).limit(quota)


def holdout(c: Column, share_of_ten: int = 2) -> Column:
    """The split of an id: the first 8 hex digits of its SHA-256, modulo 10, below two is holdout."""
    return F.when(F.conv(F.substring(F.sha2(c, 256), 1, 8), 16, 10).cast("long") % 10 < share_of_ten, "holdout").otherwise("dev")


def holdout_of_five(c: Column) -> Column:
    """The silver split: the last two hex digits modulo 5 are 0."""
    return F.when(F.conv(F.substring(F.sha2(c, 256), 63, 2), 16, 10).cast("long") % 5 == 0, "holdout").otherwise("dev")


def usage_summary(usage: DataFrame, *keys: str) -> DataFrame:
    """G12."""
    return usage.groupBy(*keys).agg(F.count(F.lit(1)).alias("calls"), F.sum("input_tokens").alias("input_tokens"), F.sum("output_tokens").alias("output_tokens"), F.sum("cost").alias("cost"))


def monthly_cost(usage: DataFrame, year: int, month: int) -> DataFrame:
    """Cost of the rows of one month (UTC)."""
    return usage.where((F.year("ts") == year) & (F.month("ts") == month)).agg(F.coalesce(F.sum("cost"), F.lit(0.0)).alias("cost"))


def estimate(texts: DataFrame, text_col: str = "text", input_rate: float = 1.0, output_rate: float = 1.0, output_tokens: int = 100) -> DataFrame:
    """Lower and upper bounds of tokens and cost of sending every text once."""
    low, high = estimated_tokens(col(text_col), 4.0), estimated_tokens(col(text_col), 3.5)
    cost = lambda t: (t * input_rate + output_tokens * output_rate) / 1_000_000.0
    return texts.agg(F.count(F.lit(1)).alias("n"), F.sum(low).alias("tokens_low"), F.sum(high).alias("tokens_high"), F.sum(cost(low)).alias("cost_low"), F.sum(cost(high)).alias("cost_high"))


def project_cost(measured_cost: float, measured_pairs: int, candidates: int, incremental: float = 0.05) -> dict[str, float]:
    """Cost of all candidates at the measured price a pair; batch calls cost half."""
    each = measured_cost / max(1, measured_pairs)
    return {"per_pair": each, "first_run": each * candidates, "first_run_batch": each * candidates / 2, "incremental": each * candidates * incremental}


def risk_segment(c: dict[str, Column]) -> Column:
    """Where a candidate stands: exact, fixture, anchored, rare keyword, weak or other."""
    return (
        F.when(c["tier"] == "exact", "exact_title").when(F.array_contains(c["anchors"], "fixture"), "fixture").when(F.size(c["anchors"]) >= 2, "multi_anchor")
        .when(F.array_contains(c["anchors"], "rare_keyword"), "rare_keyword_only").when(c["tier"] == "weak", "weak").otherwise("other")
    )


def audit(pairs: DataFrame, confirmed: DataFrame, segment: str = "segment", samples: int = 25) -> tuple[DataFrame, DataFrame]:
    """(counts per segment with confirmed pairs and the highest degree, at most `samples` rows per segment)."""
    have = confirmed.select("k_id", "p_id").distinct().withColumn("_c", F.lit(1))
    degree = F.greatest(F.count(F.lit(1)).over(Window.partitionBy("k_id")), F.count(F.lit(1)).over(Window.partitionBy("p_id")))
    rows = pairs.join(have, ["k_id", "p_id"], "left").withColumn("degree", degree)
    report = rows.groupBy(segment).agg(F.count(F.lit(1)).alias("n"), F.count("_c").alias("confirmed"), F.max("degree").alias("max_degree"), F.count_if(col("degree") > 10).alias("high_degree"))
    w = Window.partitionBy(segment).orderBy("k_id", "p_id")
    return report, rows.withColumn("rn", F.row_number().over(w)).where(col("rn") <= samples).drop("_c")


def tag_histogram(df: DataFrame, tags_col: str, format_tags: tuple[str, ...] = ("recurring", "hide from new", "earn 4%")) -> DataFrame:
    """How often every tag stands, format tags left out; most frequent first."""
    tags = df.select(F.explode(F.split(F.coalesce(col(tags_col), F.lit("")), ",")).alias("tag")).select(F.trim(F.regexp_replace("tag", r"\s+", " ")).alias("tag"))
    return tags.where((col("tag") != "") & ~F.lower("tag").isin(*format_tags)).groupBy("tag").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "tag")


def uncertain(score: Column, n_keywords: Column, similarity: Column, k_numbers: Column, p_numbers: Column, granularity_risk: Column) -> Column:
    """F10."""
    return (score <= 3) | (n_keywords <= 3) | (similarity <= 0.82) | (k_numbers != p_numbers) | granularity_risk


def priority(quality: Column, tier: Column, score: Column, similarity: Column, n_distinct: Column) -> Column:
    """Whole points by which candidates are sent to verification."""
    rank = F.when(tier == "exact", 3).when(tier == "strong", 2).when(tier == "medium", 1).otherwise(0)
    return quality + 80 * rank + 60 * score + (similarity * 100).cast("int") + 12 * n_distinct + F.when(similarity >= 0.98, 80).otherwise(0)


def priority_bucket(points: Column, tier: Column) -> Column:
    """The tier where there is one, else by points."""
    by_points = F.when(points >= 360, "high").when(points >= 250, "medium").otherwise("low")
    return F.when(tier.isin("exact", "strong"), "high").when(tier == "medium", "medium").when(tier == "weak", "low").otherwise(by_points)


def meets_quality(tier: Column, floor: str) -> Column:
    """F8."""
    ranks = {"weak": 0, "medium": 1, "strong": 2, "exact": 3}
    if floor not in ranks:
        raise ValueError(f"unknown quality tier {floor!r}")
    return F.coalesce(F.element_at(F.create_map(*(F.lit(x) for kv in ranks.items() for x in kv)), tier), F.lit(0)) >= ranks[floor]


def budget_split(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """Rows with whether they are among the first n; only n rows are ever gathered."""
    head = df.orderBy(*order).limit(n).withColumn("in_budget", F.lit(True))
    keys = [c for c in df.columns if c.endswith("id")]
    return df.join(head.select(*keys, "in_budget"), keys, "left").withColumn("in_budget", F.coalesce("in_budget", F.lit(False)))

