"""Envelopes of candidates, their contexts, review data and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from xmarket.functions.hashing import canonical_json
from xmarket.functions.text import disjoint, safe_text, strings
from xmarket.operators.sync import first_by

col = F.col
DIMENSIONS = ("years", "locations", "thresholds", "scopes")
MATRIX = ("subject", "action", "time", "threshold", "scope", "resolution")


def sides(k: dict[str, Column], p: dict[str, Column], dimensions: tuple[str, ...] = DIMENSIONS) -> tuple[Column, Column]:
    """(dimensions that one side states alone, dimensions in which both exclude each other)."""
    one = F.array_compact(F.array(*(F.when((F.size(k[d]) > 0) != (F.size(p[d]) > 0), F.lit(d)) for d in dimensions)))
    clash = F.array_compact(F.array(*(F.when(disjoint(k[d], p[d]), F.lit(d)) for d in dimensions)))
    return one, clash


def envelope(df: DataFrame, kind: str, k_id: str = "k_id", p_id: str = "p_id") -> DataFrame:
    """Candidates with a stable pair id and their type."""
    body = {"kind": F.lit(kind), "k": col(k_id).cast("string"), "p": col(p_id).cast("string")}
    return df.withColumn("candidate_type", F.lit(kind)).withColumn("pair_id", F.substring(F.sha2(canonical_json(body), 256), 1, 24))


def payload(fields: dict[str, Column], limits: dict[str, int] | None = None) -> Column:
    """Compact JSON of the fields that aren't empty; arrays are cut to their limits, keys sorted."""
    out = {}
    for name, c in fields.items():
        n = (limits or {}).get(name)
        out[name] = F.when(F.size(c) > 0, F.slice(c, 1, n)) if n else F.nullif(c, F.lit(""))
    return canonical_json(out)


def pair_key(df: DataFrame) -> DataFrame:
    """Ids of flat (k_id, p_id) or nested (k.event_id, p.event_id) pairs."""
    flat = lambda side: col(f"{side}_id") if f"{side}_id" in df.columns else F.lit(None).cast("string")
    nested = lambda side: col(f"{side}.event_id") if side in df.columns else F.lit(None).cast("string")
    return df.withColumn("_k", F.coalesce(flat("k"), nested("k"))).withColumn("_p", F.coalesce(flat("p"), nested("p"))).drop("k_id", "p_id").withColumnsRenamed({"_k": "k_id", "_p": "p_id"})


def common_keywords(c: Column, k_tokens: Column, p_tokens: Column) -> Column:
    """P20: keywords from a list literal or a text with bars; without them the shared title tokens."""
    text = safe_text(c)
    listed = F.transform(F.regexp_extract_all(text, F.lit(r"'((?:[^'\\]|\\.)*)'|\"((?:[^\"\\]|\\.)*)\""), F.lit(0)), lambda s: F.substring(s, F.lit(2), F.length(s) - 2))
    barred = F.filter(F.transform(F.split(text, r"\|"), lambda s: F.trim(s)), lambda s: s != "")
    parsed = F.when(text.rlike(r"^[\[{(].*[\])}]$"), listed).otherwise(barred)
    return F.when(F.size(parsed) > 0, parsed).otherwise(F.array_intersect(k_tokens, p_tokens))


def confirmed_rows(records: DataFrame, envelopes: DataFrame) -> DataFrame:
    """Flat confirmed rows of matching records."""
    joined = records.where("status = 'valid' and decision = 'MATCH'").join(envelopes, "pair_id")
    return joined.select("k_id", "p_id", "k_title", "p_title", F.array_join("common_keywords", "|").alias("common_keywords"), col("quality").alias("match_score"), "relation", F.lit("New").alias("sync_status"))


def clusters(pairs: DataFrame, index: DataFrame, order: list[Column]) -> DataFrame:
    """Ordered pairs with both events' records and sequential ids."""
    from xmarket.operators.sync import sequential_ids

    k = index.select(col("event_id").alias("k_id"), F.struct("title", "category", "sub_category").alias("k_event"))
    p = index.select(col("event_id").alias("p_id"), F.struct("title", "category", "sub_category").alias("p_event"))
    return sequential_ids(pairs.join(k, "k_id", "left").join(p, "p_id", "left"), order)


def graph_nodes(edges: DataFrame, details: DataFrame) -> DataFrame:
    """The records of the ids that an edge touches."""
    ids = edges.select(col("k_id").alias("id")).unionByName(edges.select(col("p_id").alias("id")))
    return details.join(ids, "id", "left_semi")


def contexts(rows: DataFrame) -> DataFrame:
    """Per event the longest description (the first among equals) and its distinct contracts by bet id."""
    longest = rows.groupBy("event_id").agg(F.max_by("description", F.struct(F.length(safe_text(col("description"))), -col("ord"))).alias("description"))
    first = first_by(rows, ["event_id", "bet_id"], [F.asc("ord")])
    listed = first.groupBy("event_id").agg(F.array_sort(F.collect_list(F.struct("ord", "bet_id", "bet_title"))).alias("_c"))
    return longest.join(listed, "event_id").select("event_id", "description", F.transform("_c", lambda c: F.struct(c["bet_id"].alias("bet_id"), c["bet_title"].alias("bet_title"))).alias("contracts"))


def short_contexts(rows: DataFrame, titles: int = 4) -> DataFrame:
    """G9, the older form: the longest of three texts, and the first distinct titles in order."""
    texts = F.array(*(safe_text(col(c)) for c in ("description", "rules", "event_description")))
    longest = F.element_at(F.array_sort(F.transform(texts, lambda t: F.struct((-F.length(t)).alias("n"), t.alias("t")))), 1)["t"]
    flat = rows.select("event_id", "ord", "bet_title", longest.alias("text"))
    best = flat.groupBy("event_id").agg(F.max_by("text", F.struct(F.length("text"), -col("ord"))).alias("text"))
    first = flat.groupBy("event_id", "bet_title").agg(F.min("ord").alias("ord"))
    named = first_by(first, ["event_id"], [F.asc("ord")], titles).groupBy("event_id").agg(F.array_sort(F.collect_list(F.struct("ord", "bet_title"))).alias("_t"))
    return best.join(named, "event_id").select("event_id", "text", F.transform("_t", lambda t: t["bet_title"]).alias("titles"))


def with_contexts(envelopes: DataFrame, ctx: DataFrame) -> DataFrame:
    """Both events' contexts beside each envelope."""
    k = ctx.select(col("event_id").alias("k_id"), F.struct("description", "contracts").alias("k_context"))
    p = ctx.select(col("event_id").alias("p_id"), F.struct("description", "contracts").alias("p_context"))
    return envelopes.join(k, "k_id", "left").join(p, "p_id", "left")


def import_confirmed(confirmed: DataFrame, envelopes: DataFrame, cache: DataFrame) -> DataFrame:
    """Confirmed pairs that have an envelope and no cached decision, as legacy matches."""
    joined = envelopes.select("pair_id", "k_id", "p_id").join(confirmed.select("k_id", "p_id").distinct(), ["k_id", "p_id"])
    return joined.join(cache.select("pair_id").distinct(), "pair_id", "left_anti").withColumn("decision", F.lit("MATCH")).withColumn("stage", F.lit("legacy")).withColumn("status", F.lit("valid"))


def with_labels(candidates: DataFrame, labels: DataFrame) -> DataFrame:
    """Candidates that a human or annotators resolved, with the label."""
    return candidates.join(labels.select("pair_id", col("decision").alias("expected"), "relation"), "pair_id")


def verification_status(clusters_: DataFrame, confirmed: DataFrame, rejects: DataFrame) -> DataFrame:
    """Confirmed, skipped as an end is confirmed elsewhere, or the reason of the rejection; null if open."""
    pair = confirmed.select("k_id", "p_id").distinct().withColumn("_pair", F.lit(True))
    k, p = confirmed.select("k_id").distinct().withColumn("_k", F.lit(True)), confirmed.select("p_id").distinct().withColumn("_p", F.lit(True))
    df = clusters_.join(pair, ["k_id", "p_id"], "left").join(k, "k_id", "left").join(p, "p_id", "left").join(rejects.select("k_id", "p_id", "reason"), ["k_id", "p_id"], "left")
    status = F.when(col("_pair"), "confirmed").when(col("_k") | col("_p"), "skipped").when(col("reason").isNotNull(), "rejected")
    return df.withColumn("status", status).withColumn("reason", F.when(status == "rejected", col("reason"))).drop("_pair", "_k", "_p")


def check_matrix(df: DataFrame, matrix: str = "matrix", decision: str = "decision") -> DataFrame:
    """Answers with six dimensions of same, conflict or unknown; a MATCH with any that isn't same is AMBIGUOUS.

    Rows that lack a dimension or hold another value are errors.
    """
    at = lambda d: F.element_at(col(matrix), d)
    good = lambda d: F.coalesce(at(d).isin("same", "conflict", "unknown"), F.lit(False))
    complete, same = F.lit(True), F.lit(True)
    for d in MATRIX:
        complete, same = complete & good(d), same & (at(d) == "same")
    conflicts = F.array_compact(F.array(*(F.when(at(d) == "conflict", F.lit(d)) for d in MATRIX)))
    said = F.when(~complete, "AMBIGUOUS").when((col(decision) == "MATCH") & ~same, "AMBIGUOUS").when((col(decision) == "NO_MATCH") & (F.size(conflicts) == 0), "AMBIGUOUS").otherwise(col(decision))
    return df.withColumn("status", F.when(complete, "valid").otherwise("error")).withColumn("conflicts", conflicts).withColumn("decision", said)


def mutations(positives: DataFrame) -> DataFrame:
    """Hard negatives from matching pairs: another subject, another year, a dropped year, another threshold.

    Each change replaces the first hit in the P title; pairs without a hit give no row of that kind.
    """
    title = col("p_title")
    first = lambda pattern, to: F.regexp_replace(title, rf"^(.*?){pattern}", F.concat(F.lit("$1"), to))
    year, number = F.regexp_extract(title, r"\b(20[2-3][0-9])\b", 1), F.regexp_extract(title, r"\b(\d+)(?:\.\d+)?%", 1)
    changes = (
        ("subject_conflict", F.when(col("k_subject") != "", F.replace(title, col("k_subject"), F.lit("Someone Else"))), "NO_MATCH", "subject"),
        ("year_conflict", F.when(year != "", first(r"\b20[2-3][0-9]\b", (year.cast("int") + 1).cast("string"))), "NO_MATCH", "time"),
        ("missing_year", F.when(year != "", F.trim(first(r"\s*\b20[2-3][0-9]\b", F.lit("")))), "AMBIGUOUS", "time"),
        ("threshold_conflict", F.when(number != "", first(r"\b\d+(?:\.\d+)?%", F.concat((number.cast("int") + 5).cast("string"), F.lit("%")))), "NO_MATCH", "threshold"),
    )
    made = F.array(*(F.struct(F.lit(n).alias("kind"), t.alias("p_title"), F.lit(e).alias("expected"), F.lit(d).alias("dimension")) for n, t, e, d in changes))
    rows = positives.select("pair_id", "k_title", col("p_title").alias("_from"), F.explode(made).alias("m")).select("pair_id", "k_title", "_from", "m.*")
    kept = rows.where(col("p_title").isNotNull() & (col("p_title") != col("_from"))).drop("_from")
    return kept.withColumn("example_id", F.concat_ws(":", "pair_id", "kind"))


def quota_sample(df: DataFrame, order: list[str], quotas: dict[str, int], provenance: str = "provenance") -> DataFrame:
    """Unique pairs, the earlier provenance winning, and the first of each in hash order up to its quota."""
    rank = F.array_position(strings(order), col(provenance))
    unique = first_by(df.where(rank > 0), ["k_id", "p_id"], [rank.asc(), F.asc("pair_id")])
    w = Window.partitionBy(provenance).orderBy(F.sha2(col("pair_id").cast("string"), 256), "pair_id")
    quota = F.coalesce(F.element_at(F.create_map(*(F.lit(x) for kv in quotas.items() for x in kv)), col(provenance)), F.lit(0))
    return unique.withColumn("_rn", F.row_number().over(w)).where(col("_rn") <= quota).drop("_rn")


def treatments(examples: DataFrame, names: list[str]) -> DataFrame:
    """Every example under every treatment; treatments are a short list, exploded onto the rows."""
    return examples.select("*", F.explode(strings(names)).alias("treatment"))


def requests(envelopes: DataFrame, model: str, instructions: str, max_tokens: int = 400) -> DataFrame:
    """Request bodies of envelopes, one JSON text each."""
    message = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    body = F.struct(F.lit(model).alias("model"), F.array(message("system", F.lit(instructions)), message("user", col("payload"))).alias("messages"), F.lit(max_tokens).alias("max_completion_tokens"), F.struct(F.lit("json_object").alias("type")).alias("response_format"))
    return envelopes.select(col("pair_id").alias("custom_id"), F.lit(model).alias("model"), F.to_json(body).alias("body"))


def pass_inputs(envelopes: DataFrame, done: DataFrame, stage: str) -> DataFrame:
    """Envelopes that a pass still has to ask: all in the first, later those whose route asks for it."""
    if stage == "primary":
        return envelopes.join(done.select("pair_id"), "pair_id", "left_anti")
    need = {"secondary": F.lit(True), "frontier": col("needs_frontier"), "tiebreak": col("needs_tiebreak")}[stage]
    return envelopes.join(done.where(need).select("pair_id"), "pair_id", "left_semi")


def display_output(profile: DataFrame) -> DataFrame:
    """The nested output record of an outcome profile, its years sorted."""
    return profile.select("bet_id", F.struct("event_id", "bet_id", "title", "outcome_key", F.array_sort("event_years").alias("event_years"), "scope_terms", "deadline").alias("profile"))


def one_to_one(pairs: DataFrame, conflict: Column, order: list[Column]) -> DataFrame:
    """Within each event pair, first come in order, contracts one to one, and none with a hard conflict."""
    from xmarket.operators.candidates import greedy_exclusive

    keyed = pairs.where(~conflict)
    k, p = F.concat_ws("|", "k_id", "p_id", "k_bet_id"), F.concat_ws("|", "k_id", "p_id", "p_bet_id")
    return greedy_exclusive(keyed.withColumn("_kb", k).withColumn("_pb", p), order, "_kb", "_pb").drop("_kb", "_pb")


def load_matches(rows: DataFrame) -> DataFrame:
    """IO17: matches with both bet ids; Identical and Same by default; per id the last row wins."""
    defaults = {"relation": "Identical", "mapping": "Same"}
    for name, value in defaults.items():
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(value))
    kept = rows.where((safe_text(col("k_bet_id")) != "") & (safe_text(col("p_bet_id")) != ""))
    for key in ("k_bet_id", "p_bet_id"):
        kept = first_by(kept, [key], [F.desc("ord")])
    return kept


def token_ids(markets: DataFrame, known: DataFrame, lookup=None) -> DataFrame:
    """IO16: an id of over 20 characters is a token already; others by the known map, the rest by a lookup on executors."""
    import pandas as pd

    rows = markets.join(known.select(col("market_id"), col("token").alias("_known")), "market_id", "left")
    rows = rows.withColumn("token", F.when(F.length("market_id") > 20, col("market_id")).otherwise(col("_known"))).drop("_known")
    if lookup is None:
        return rows
    missing = rows.where("token is null").select("market_id").distinct()

    def run(parts):
        for pdf in parts:
            yield pd.DataFrame({"market_id": pdf["market_id"], "_found": [lookup(m) for m in pdf["market_id"]]})

    found = missing.mapInPandas(run, "market_id string, _found string")
    return rows.join(found, "market_id", "left").withColumn("token", F.coalesce("token", "_found")).drop("_found")
