"""Verification: decoding of model answers, routing, voting, caches and batching."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from xmarket.functions.text import literal_map, strings

col = F.col
# Wire codes of decisions and relations, and limits of a decision.
DECISIONS = {"M": "MATCH", "N": "NO_MATCH", "A": "AMBIGUOUS"}
RELATIONS = {"I": "Identical", "O": "Opposite", "R": "Related", "N": "None"}
MAX_EVIDENCE, MATCH_FLOOR = 4, 0.80
WIRE = "struct<decisions:array<struct<id:string,d:string,r:string,c:double,x:array<string>,m:array<string>,e:array<string>,q:int>>>"


def decode(answers: DataFrame, expected: DataFrame, json_col: str = "answer", batch_col: str = "batch_id") -> DataFrame:
    """Decisions of wire answers, coerced in order; errors are rows of their own, never negative labels.

    NO_MATCH without a conflict and MATCH with a conflict or with missing fields become AMBIGUOUS; a MATCH without
    a relation, an unknown id and a repeated id are errors; an expected id without an answer is one too.
    """
    rows = answers.select(batch_col, F.explode_outer(F.from_json(json_col, WIRE)["decisions"]).alias("w")).where("w is not null").select(batch_col, "w.*")
    rows = rows.withColumn("times", F.count(F.lit(1)).over(Window.partitionBy(batch_col, "id")))
    joined = expected.select(col("pair_id").alias("id"), batch_col).join(rows, ["id", batch_col], "full")
    known = expected.select(col("pair_id").alias("id"), batch_col).withColumn("_known", F.lit(True))
    joined = joined.join(known, ["id", batch_col], "left")
    said = F.element_at(literal_map(DECISIONS), col("d"))
    some = lambda c: F.size(F.coalesce(c, F.array().cast("array<string>"))) > 0
    relation = F.element_at(literal_map(RELATIONS), col("r"))
    error = (
        F.when(col("_known").isNull(), "unknown_id").when(col("d").isNull(), "missing_id").when(col("times") > 1, "duplicate_id").when(said.isNull(), "bad_decision")
        .when((said == "MATCH") & (relation.isNull() | (relation == "None")), "match_without_relation")
    )
    ambiguous = ((said == "NO_MATCH") & ~some(col("x"))) | ((said == "MATCH") & (some(col("x")) | some(col("m"))))
    none = F.array().cast("array<string>")
    return joined.select(
        col("id").alias("pair_id"), batch_col, F.when(error.isNull(), "valid").otherwise("error").alias("status"), F.coalesce(error, F.lit("")).alias("error"),
        F.when(error.isNotNull() | ambiguous, "AMBIGUOUS").otherwise(said).alias("decision"), F.coalesce(relation, F.lit("None")).alias("relation"),
        F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.coalesce("c", F.lit(0.0)))).alias("confidence"),
        F.slice(F.coalesce("x", none), 1, MAX_EVIDENCE).alias("conflicts"), F.slice(F.coalesce("m", none), 1, MAX_EVIDENCE).alias("missing"), F.slice(F.coalesce("e", none), 1, MAX_EVIDENCE).alias("evidence"),
    ).distinct()


def explicit_no(decision: Column, confidence: Column, conflicts: Column, evidence: Column, floor: float = 0.86) -> Column:
    """F11."""
    return (decision == "NO_MATCH") & (confidence >= floor) & (F.size(conflicts) > 0) & (conflicts != strings(["category"])) & (F.size(evidence) >= 2)


def needs_detail(status: Column, decision: Column, confidence: Column, conflicts: Column, evidence: Column) -> Column:
    """everything but a verifiable no goes on."""
    return ~F.coalesce((status == "valid") & explicit_no(decision, confidence, conflicts, evidence), F.lit(False))


def needs_review(status: Column, decision: Column, confidence: Column, floor: float = MATCH_FLOOR) -> Column:
    """F12."""
    return (status != "valid") | (decision == "AMBIGUOUS") | ((decision == "MATCH") & (confidence < floor))


def final_decision(stages: list[str], floor: float = MATCH_FLOOR) -> tuple[Column, Column]:
    """(decision, stage) of the last stage that has a record; columns are <stage>_decision, _status, _confidence."""
    decision, stage = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name in stages:  # from the last stage to the first
        d, s, c = col(f"{name}_decision"), col(f"{name}_status"), col(f"{name}_confidence")
        plain = F.when(s != "valid", "AMBIGUOUS").when((d == "MATCH") & (c < floor), "AMBIGUOUS").otherwise(d)
        decision, stage = F.coalesce(decision, F.when(d.isNotNull(), plain)), F.coalesce(stage, F.when(d.isNotNull(), F.lit(name)))
    return F.coalesce(decision, F.lit("AMBIGUOUS")), stage


def consensus(df: DataFrame, names: tuple[str, str, str, str] = ("primary", "secondary", "frontier", "tiebreak")) -> DataFrame:
    """Decision, route and what is still needed, from four records' decision, relation and status."""
    one, two, front, tie = names
    ok = lambda n: F.coalesce(col(f"{n}_status") == "valid", F.lit(False))
    d = lambda n: F.coalesce(col(f"{n}_decision"), F.lit(""))
    vote = lambda n: F.concat_ws(":", d(n), F.when(d(n) == "MATCH", col(f"{n}_relation")).otherwise(F.lit("")))
    noes = sum((F.when(d(n) == "NO_MATCH", 1).otherwise(0) for n in (two, front, tie)), F.lit(0))
    steps = (
        (~(ok(one) & ok(two)), "invalid_initial", "AMBIGUOUS"),
        ((vote(one) == vote(two)) & (d(two) != "AMBIGUOUS"), "initial_agreement", None),
        (~ok(front), "needs_frontier", "AMBIGUOUS"),
        ((vote(two) == vote(front)) & (d(front) == "NO_MATCH"), "strong_agreement", "NO_MATCH"),
        ((vote(two) == vote(front)) & (d(front) == "AMBIGUOUS"), "strong_ambiguous", "AMBIGUOUS"),
        (~ok(tie), "needs_tiebreak", "AMBIGUOUS"),
        (noes >= 2, "majority_no", "NO_MATCH"),
        ((d(front) == "MATCH") & (vote(front) == vote(tie)), "frontier_tiebreak_match", "MATCH"),
    )
    route, decision = F.lit("abstain"), F.lit("AMBIGUOUS")
    for test, name, result in reversed(steps):
        route, decision = F.when(test, F.lit(name)).otherwise(route), F.when(test, d(two) if result is None else F.lit(result)).otherwise(decision)
    df = df.withColumn("decision", decision).withColumn("route", route)
    return df.withColumn("needs_frontier", col("route").isin("invalid_initial", "needs_frontier")).withColumn("needs_tiebreak", col("route") == "needs_tiebreak")


def route_counts(df: DataFrame) -> DataFrame:
    """G12."""
    return df.groupBy("route").agg(F.count(F.lit(1)).alias("n"))


def cached(envelopes: DataFrame, cache: DataFrame, keys: list[str]) -> DataFrame:
    """Envelopes with their valid cached decision, null where there is none."""
    hits = cache.where("status = 'valid'").select(*keys, col("decision").alias("cached_decision"))
    return envelopes.join(hits, keys, "left")


def batches(df: DataFrame, max_items: int, max_chars: int, id_col: str = "pair_id", size_col: str = "chars", lane_col: str | None = None) -> DataFrame:
    """Greedy batches in the order of size and id: a batch ends when another row would break a cap.

    The cut resets a running sum, which no window says, so one lane is walked in one task; lanes (a stage, a model, a
    hash) bound it.  Rows above the cap stand alone.
    """
    lane = col(lane_col) if lane_col else F.lit(0)
    rows = df.select(lane.alias("lane"), col(id_col).cast("string").alias("id"), col(size_col).cast("long").alias("size"))

    def cut(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "id"], kind="stable").reset_index(drop=True)
        number, items, chars, out = 0, 0, 0, []
        for size in pdf["size"]:
            if items and (items + 1 > max_items or chars + size > max_chars):
                number, items, chars = number + 1, 0, 0
            items, chars = items + 1, chars + size
            out.append(number)
        return pdf.assign(batch=out)

    kind = rows.schema["lane"].dataType.simpleString()
    return rows.groupBy("lane").applyInPandas(cut, f"lane {kind}, id string, size long, batch long")


def score_with(envelopes: DataFrame, scorer: Callable[[pd.DataFrame], pd.Series], out: str = "answer") -> DataFrame:
    """S3: rows beside a pluggable scorer's answer; the scorer gets Arrow batches and runs on the executors."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in envelopes.schema) + f", {out} string"

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            yield pdf.assign(**{out: scorer(pdf)})

    return envelopes.mapInPandas(run, schema)


def verify_missing(envelopes: DataFrame, cache: DataFrame, keys: list[str], scorer: Callable[[pd.DataFrame], pd.Series], budget: float | None = None, cost_per_row: float = 0.0) -> DataFrame:
    """S3: answers for envelopes without a valid cached decision; refuses before the first call if the budget can't hold."""
    todo = envelopes.join(cache.where("status = 'valid'").select(*keys), keys, "left_anti")
    if budget is not None and (cost := todo.count() * cost_per_row) > budget:
        raise RuntimeError(f"estimated cost {cost:.4f} is above the budget {budget:.4f}")
    return score_with(todo, scorer)


def majority(votes: DataFrame, human: DataFrame | None = None, least: int = 2) -> DataFrame:
    """Per pair the vote that at least two annotators share, with the least confidence among them; a human overrides.

    votes: pair_id, annotator, decision, relation, confidence.  Ties go to the vote that comes first in order.
    """
    counted = votes.groupBy("pair_id", "decision", "relation").agg(F.count(F.lit(1)).alias("n"), F.min("confidence").alias("confidence"), F.min("annotator").alias("first"))
    w = Window.partitionBy("pair_id").orderBy(F.desc("n"), "first")
    top = counted.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn", "first")
    if human is not None:
        top = top.join(human.select("pair_id", col("decision").alias("h_decision"), col("relation").alias("h_relation")), "pair_id", "left")
    else:
        top = top.withColumn("h_decision", F.lit(None).cast("string")).withColumn("h_relation", F.lit(None).cast("string"))
    is_human = col("h_decision").isNotNull()
    return top.select(
        "pair_id", F.coalesce("h_decision", "decision").alias("decision"), F.coalesce("h_relation", "relation").alias("relation"), "n",
        F.when(is_human, F.lit(1.0)).otherwise(col("confidence")).alias("confidence"), (is_human | (col("n") >= least)).alias("accepted"),
    )
