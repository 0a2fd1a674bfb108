"""Queries of single rules, outcome terms, payload projections, live updates and routing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from xmarket.functions import contracts, events, text
from xmarket.functions import outcome_lexicon as ox
from xmarket.operators import candidates, decisions, envelopes, matching, metrics, outcomes, rules
from xmarket.plans.q_book import LEVELS
from xmarket.plans.q_decisions import _FOUR, _with_evidence
from xmarket.plans.q_pairs import ACCOUNT_PAIRS, _account_pairs
from xmarket.plans.q_text import _LOWPCT, sql_list, sql_named
from xmarket.plans.registry import query
from xmarket.plans.views import base, view
from xmarket.sources import files, markets
from xmarket.streaming import books

col = F.col

_PHRASE = r"trim(regexp_replace(replace(lower(title), '&', ' and '), '[^a-z0-9.#%$]+', ' ', 'g'))"


@query(f"SELECT event_id, {_PHRASE} AS phrase FROM v_titles")
def x10_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "v_titles").select("event_id", outcomes.phrase(col("title")).alias("phrase"))


@query(rf"""SELECT event_id, array_to_string(list_sort(list_distinct(list_concat(list_filter(string_split({_PHRASE}, ' '), lambda w: length(w) > 1 AND NOT list_contains({sql_list(ox.STOP_WORDS)}, w)),
 list_transform(regexp_extract_all({_PHRASE}, '\bgroup\s+([a-z])\b', 1), lambda g: 'group ' || g)))), '|') AS tokens FROM v_titles""")
def x11_outcome_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "v_titles").withColumn("p", outcomes.phrase(col("title"))).select("event_id", F.array_join(outcomes.tokens(col("p")), "|").alias("tokens"))


@query(f"SELECT event_id, {sql_named(_PHRASE, ox.DIMENSIONS)} AS dimensions, {sql_named(_PHRASE, ox.COMPETITIONS)} AS competitions FROM v_titles")
def x36_dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = col("p")
    t = view(spark, sf_dir, "v_titles").withColumn("p", outcomes.phrase(col("title")))
    return t.select("event_id", F.array_join(text.named(p, ox.DIMENSIONS), "|").alias("dimensions"), F.array_join(text.named(p, ox.COMPETITIONS), "|").alias("competitions"))


@query()
def x36_scope_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X36 and X37 whole; cases are compared in the tests."""
    t = outcomes.with_scope_terms(view(spark, sf_dir, "v_titles").withColumn("p", outcomes.phrase(col("title"))), "p")
    context = outcomes.context_scope_terms(col("event_id").cast("string"), col("category"), col("sub_category"))
    return t.select("event_id", F.array_join("scope_terms", "|").alias("scope_terms"), F.array_join(context, "|").alias("context_terms"))


def _rows(spark: SparkSession, sf_dir: str, venue: str) -> DataFrame:
    t = view(spark, sf_dir, "v_titles").where(col("platform") == venue)
    outcome = F.when(col("event_id") % 3 == 0, "Yes").otherwise(F.concat(F.lit("Team "), (F.floor(col("event_id") / 2) % 997).cast("string")))
    return t.select(col("sub_category").alias("Event ID"), col("event_id").cast("string").alias("Bet ID"), col("title").alias("Market Title"), outcome.alias("Bet Title"), F.lit("Sports").alias("Category"), col("sub_category").alias("Sub-Category"), F.lit("Yes").alias("Outcome_Name"), F.lit("Settled by December 31, 2026.").alias("Bet_Rules"))


@query()
def x38_outcome_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X33 to X38 whole."""
    p = outcomes.outcome_profiles(_rows(spark, sf_dir, "P"), "P")
    return p.select("bet_id", "outcome_key", "market_intent", F.array_join("scope_terms", "|").alias("scope_terms"), "deadline", "actor", "event_subject_count")


@query()
def j3_outcome_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J3 with R20 to R22 and W2 on outcome profiles of both venues."""
    k, p = outcomes.outcome_profiles(_rows(spark, sf_dir, "K"), "K"), outcomes.outcome_profiles(_rows(spark, sf_dir, "P"), "P")
    return outcomes.outcome_candidates(k, p).select("k_bet", "p_bet", "candidate_type", "match_score", "outcome_key")


_YEARS = r"list_sort(list_distinct(regexp_extract_all({0}, '\b(20[2-3][0-9])\b', 1)))"


@query(f"""WITH {ACCOUNT_PAIRS}, y AS (SELECT k_id, p_id, {_YEARS.format('k_title')} AS ky, {_YEARS.format('p_title')} AS py FROM nb)
SELECT k_id, p_id, len(ky) > 0 AND len(py) > 0 AND len(list_filter(ky, lambda a: len(list_filter(py, lambda b: abs(CAST(a AS INT) - CAST(b AS INT)) <= 1)) > 0)) = 0 AS signature_conflict,
 len(ky) > 0 AND len(py) > 0 AND len(list_intersect(ky, py)) = 0 AS hard_conflict FROM y""")
def r2_r3_year_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = F.array().cast("array<string>")
    ky, py = events.years(col("k_title")), events.years(col("p_title"))
    return _account_pairs(spark, sf_dir).select("k_id", "p_id", rules.signature_conflict(ky, py, none, none).alias("signature_conflict"), rules.hard_conflict(ky, py, none, none).alias("hard_conflict"))


def _has(words, expr: str) -> str:
    inner = _LOWPCT.replace("title", expr)
    joined = "|".join(words)
    return f"regexp_matches({inner}, '\\b(?:{joined})\\b')"


_UP, _DOWN = events.lx.UP_TERMS, events.lx.DOWN_TERMS


@query(f"""WITH {ACCOUNT_PAIRS}, d AS (SELECT k_id, p_id, {_has(_UP, 'k_title')} AS ku, {_has(_DOWN, 'k_title')} AS kd, {_has(_UP, 'p_title')} AS pu, {_has(_DOWN, 'p_title')} AS pd FROM nb)
SELECT k_id, p_id, (ku AND NOT kd AND pd AND NOT pu) OR (kd AND NOT ku AND pu AND NOT pd) AS conflict FROM d""")
def r6_direction_conflict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _account_pairs(spark, sf_dir).select("k_id", "p_id", rules.direction_conflict().alias("conflict"))


_QUARTERS = lambda c: rf"list_distinct(regexp_extract_all(lower({c}), '\b(q[1-4] 20[2-3][0-9])\b', 1))"
_MARK = events._DATE.replace("'", "''")
_MARKS = lambda c: f"list_transform(regexp_extract_all({c}, '{_MARK}', ['m', 'd', 'y']), lambda p: {{'m': lower(substr(p.m, 1, 3)), 'd': CAST(p.d AS INT), 'y': coalesce(p.y, '')}})"


@query(f"""WITH {ACCOUNT_PAIRS}, d AS (SELECT k_id, p_id, {_QUARTERS('k_title')} AS kq, {_QUARTERS('p_title')} AS pq, {_MARKS('k_title')} AS km, {_MARKS('p_title')} AS pm FROM nb)
SELECT k_id, p_id, (len(kq) > 0 AND len(pq) > 0 AND len(list_intersect(kq, pq)) = 0) OR (len(km) > 0 AND len(pm) > 0 AND len(list_filter(km, lambda a: len(list_filter(pm, lambda b: a.m = b.m AND a.d = b.d AND (a.y = '' OR b.y = '' OR a.y = b.y))) > 0)) = 0) AS conflict FROM d""")
def r5_date_conflict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _account_pairs(spark, sf_dir).select("k_id", "p_id", rules.date_scope_conflict().alias("conflict"))


@query(f"""WITH {ACCOUNT_PAIRS} SELECT k_id, p_id, len(common) > 0 AND len(kt) > 0 AND len(pt) > 0 AND (kt = pt OR (ov >= 0.85 AND jac >= 0.75) OR (n >= 4 AND ov >= 0.45) OR (n >= 3 AND ov >= 0.55) OR (n >= 2 AND ov >= 0.70) OR (n >= 2 AND d > 0 AND ov >= 0.55) OR (n = 1 AND d > 0 AND ov >= 0.75 AND jac >= 0.50)) AS by_title FROM m""")
def r13_textual_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.with_evidence(_account_pairs(spark, sf_dir)).select("k_id", "p_id", rules.keeps_by_title().alias("by_title"))


@query("""SELECT p_partkey, CASE WHEN p_size % 4 = 3 THEN 'exact_title' WHEN p_size % 5 = 0 THEN 'fixture' WHEN p_size % 3 = 0 THEN 'multi_anchor' WHEN p_size % 2 = 0 THEN 'rare_keyword_only' WHEN p_size % 4 = 0 THEN 'weak' WHEN p_size % 4 = 1 THEN 'other' END AS segment FROM part""")
def r27_risk_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = col("p_size")
    tier = F.element_at(text.strings(["weak", "medium", "strong", "exact"]), (s % 4 + 1).cast("int"))
    anchors = F.when(s % 5 == 0, text.strings(["fixture"])).when(s % 3 == 0, text.strings(["entity", "location"])).when(s % 2 == 0, text.strings(["rare_keyword"])).otherwise(F.array().cast("array<string>"))
    return base(spark, sf_dir, "part").select("p_partkey", metrics.risk_segment({"tier": tier, "anchors": anchors}).alias("segment"))


@query("SELECT p_partkey, p_size % 8 <= 3 OR p_size % 9 <= 3 OR p_size / 50.0 <= 0.82 OR p_size % 2 = 0 OR p_size % 11 = 0 AS uncertain FROM part")
def f10_uncertain(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = col("p_size")
    numbers = F.when(s % 2 == 0, text.strings(["1"])).otherwise(text.strings(["2"]))
    return base(spark, sf_dir, "part").select("p_partkey", metrics.uncertain(s % 8, s % 9, s / F.lit(50.0), numbers, text.strings(["2"]), s % 11 == 0).alias("uncertain"))


@query(f"""WITH {_FOUR}, r AS (SELECT pair_id, CASE WHEN s1 <> 'valid' OR s2 <> 'valid' THEN 'invalid_initial' WHEN d1 = d2 AND d2 <> 'AMBIGUOUS' THEN 'agree' WHEN s3 IS NULL THEN 'front' WHEN d2 = d3 AND d3 <> 'MATCH' THEN 'strong' WHEN s4 IS NULL THEN 'tie' ELSE 'rest' END AS route FROM f)
SELECT pair_id, route IN ('invalid_initial', 'front') AS needs_frontier, route = 'tie' AS needs_tiebreak FROM r""")
def f13_consensus_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, pid = view(spark, sf_dir, "v_decisions"), col("pair_id")
    rows = d.select(
        "pair_id", col("status").alias("primary_status"), F.when(pid % 7 == 0, "error").otherwise("valid").alias("secondary_status"), F.when(pid % 5 != 0, "valid").alias("frontier_status"), F.when(pid % 4 != 0, "valid").alias("tiebreak_status"),
        col("expected").alias("primary_decision"), col("actual").alias("secondary_decision"), F.when(pid % 3 == 0, "NO_MATCH").when(pid % 3 == 1, "MATCH").otherwise("AMBIGUOUS").alias("frontier_decision"),
        F.when(pid % 2 == 0, "NO_MATCH").otherwise("MATCH").alias("tiebreak_decision"), *(F.lit("Identical").alias(f"{n}_relation") for n in ("primary", "secondary", "frontier", "tiebreak")),
    )
    return decisions.consensus(rows).select("pair_id", "needs_frontier", "needs_tiebreak")


@query("SELECT pair_id, actual = 'NO_MATCH' AND status = 'valid' AND confidence >= 0.5 AND pair_id % 6 = 0 AND pair_id % 5 <> 0 AS eligible FROM v_decisions")
def f14_auto_reject(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F14, the strict strategy."""
    d = _with_evidence(view(spark, sf_dir, "v_decisions"))
    return d.select("pair_id", metrics.eligible(0.5, "strict").alias("eligible"))


@query("""SELECT 'E' || o_custkey AS "Event ID", 'M' || o_orderkey AS "Bet ID", 'Race ' || o_custkey AS "Market Title", '2026 ' || CASE o_orderkey % 3 WHEN 0 THEN 'Anna' WHEN 1 THEN 'Question (sub)' ELSE 'Question' END AS "Bet Title", 'first second' AS "Description" FROM orders WHERE o_orderstatus <> 'F'""")
def p1_k_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = base(spark, sf_dir, "orders")
    k = col("o_orderkey") % 3
    market = F.struct(
        F.concat(F.lit("M"), "o_orderkey").alias("ticker"), F.when(col("o_orderstatus") == "F", "closed").otherwise("active").alias("status"), F.lit("Question").alias("title"),
        F.when(k == 1, "sub").otherwise("").alias("subtitle"), F.when(k == 0, "Anna").otherwise("Yes").alias("yes_sub_title"), F.lit("first").alias("rules_primary"), F.lit("second").alias("rules_secondary"), F.lit("2026-01-01T00:00:00Z").alias("expiration_time"),
    )
    ev = o.select(F.concat(F.lit("E"), "o_custkey").alias("event_ticker"), F.lit("S").alias("series_ticker"), F.concat(F.lit("Race "), "o_custkey", F.lit(": 2026")).alias("title"), F.lit("C").alias("category"), F.lit("").alias("sub_title"), F.array(market).alias("markets"))
    return markets.k_rows(ev).select("Event ID", "Bet ID", "Market Title", "Bet Title", "Description")


@query("SELECT event_id, CASE WHEN event_id % 4 = 0 THEN false ELSE ts < TIMESTAMP '2024-01-15 00:00:00' END AS expired FROM events")
def p5_expired(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.when(col("event_id") % 4 == 0, "soon").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
    return base(spark, sf_dir, "events").select("event_id", markets.is_expired(raw, F.lit("2024-01-15").cast("timestamp")).alias("expired"))


@query("SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'a|b' WHEN 1 THEN 'x|y z' ELSE 'k' END AS keywords FROM part")
def p20_common_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.when(col("p_partkey") % 3 == 0, "['a', 'b']").when(col("p_partkey") % 3 == 1, " x | y z |").otherwise("")
    return base(spark, sf_dir, "part").select("p_partkey", F.array_join(envelopes.common_keywords(raw, text.strings(["k", "l"]), text.strings(["k"])), "|").alias("keywords"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'YEAR:2026|PERSON:x y' ELSE '' END AS tokens FROM part")
def io10_token_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.when(col("p_partkey") % 2 == 0, "['YEAR:2026', 'PERSON:x y']").otherwise("broken")
    return base(spark, sf_dir, "part").select("p_partkey", F.array_join(files.parse_token_list(raw), "|").alias("tokens"))


@query("SELECT n_nationkey, array_to_string(list_transform(string_split(lower(n_name), ' '), lambda w: CASE w WHEN 'united' THEN 'utd' WHEN 'france' THEN 'fra' ELSE w END), ' ') AS expanded FROM nation")
def x7_abbreviations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return base(spark, sf_dir, "nation").select("n_nationkey", text.expand_abbreviations(col("n_name"), {"united": "utd", "France": "fra"}).alias("expanded"))


@query(r"SELECT event_id, array_to_string(list_sort(list_distinct(regexp_extract_all(title, '(\d+(?:\.\d+)?)', 1))), '|') AS numbers, regexp_extract(title, '\b(20\d{2})\b', 1) AS year FROM v_titles")
def x32_numbers_and_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "v_titles").select("event_id", F.array_join(contracts.numbers(col("title")), "|").alias("numbers"), contracts.first_year(col("title")).alias("year"))


@query()
def x30_relevant_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X30 and T7 on whole documents; cases are compared in the tests."""
    return base(spark, sf_dir, "documents").select("doc_id", contracts.relevant_sentences(col("text"), text.strings(["the", "la"]), 200).alias("sentences"))


@query("SELECT c_custkey, 'c' || c_custkey || ',' || CASE WHEN c_custkey % 2 = 0 THEN 'other' ELSE 'two' END AS ranked FROM customer")
def t8_contract_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = lambda i, t: F.struct(i.alias("bet_id"), t.alias("title"))
    own = F.concat(F.lit("c"), "c_custkey")
    hit = F.when(col("c_custkey") % 2 == 0, "other").otherwise("two")
    listed = F.array(one(F.lit("miss"), F.lit("nothing here")), one(hit, F.lit("about the cup")), one(own, F.lit("own")))
    ranked = contracts.rank_contracts(listed, own, text.strings(["cup"]))
    return base(spark, sf_dir, "customer").select("c_custkey", F.array_join(F.transform(ranked, lambda c: c["bet_id"]), ",").alias("ranked"))


@query("SELECT k_id, p_id, row_number() OVER (ORDER BY quality DESC, k_id, p_id) AS place FROM v_edges")
def t1_candidate_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    from xmarket.operators.sync import sequential_ids

    e = view(spark, sf_dir, "v_edges").withColumns({"semantic_score": col("quality"), "quality_score": F.lit(0), "n": F.lit(0), "ov": F.lit(0.0), "jac": F.lit(0.0)})
    return sequential_ids(e, candidates.candidate_order(), "place").select("k_id", "p_id", "place")


@query("""SELECT ticker, side, tick, seq FROM (SELECT 'k' || user_id AS ticker, CASE WHEN event_type IN ('click', 'view') THEN 'bid' ELSE 'ask' END AS side,
 CASE WHEN event_type IN ('click', 'view') THEN CAST((event_id % 99 + 1) * 100 AS INT) ELSE CAST(10000 - (event_id % 99 + 1) * 100 AS INT) END AS tick, event_id AS seq FROM events) x""")
def st2_delta_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST2: level updates of delta messages."""
    cents = (col("event_id") % 99 + 1).cast("int")
    msg = F.struct(
        F.concat(F.lit("k"), "user_id").alias("market_ticker"), F.when(col("event_type").isin("click", "view"), "yes").otherwise("no").alias("side"), F.format_string("0.%02d", cents).alias("price_dollars"), F.lit("1.5").alias("delta_fp"),
        F.lit(None).cast("double").alias("price"), F.lit(None).cast("double").alias("delta"), *(F.lit(None).cast("array<array<string>>").alias(n) for n in ("yes_dollars_fp", "no_dollars_fp")), *(F.lit(None).cast("array<array<double>>").alias(n) for n in ("yes", "no")),
    )
    m = base(spark, sf_dir, "events").select(F.lit("orderbook_delta").alias("type"), col("event_id").alias("seq"), col("ts"), msg.alias("msg"))
    return books.k_updates(m).where("kind = 'add'").select("ticker", "side", "tick", "seq")


@query("SELECT 'p' || user_id AS ticker, CASE WHEN event_id % 2 = 0 THEN 'bid' ELSE 'ask' END AS side, CAST((event_id % 99 + 1) * 100 AS INT) AS tick, CAST(event_id % 7 AS DOUBLE) AS size, event_id AS seq FROM events")
def st4_price_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST4: level updates of price changes."""
    cents = (col("event_id") % 99 + 1).cast("int")
    none = F.lit(None).cast("string")
    change = F.struct(F.concat(F.lit("p"), "user_id").alias("asset_id"), F.format_string("0.%02d", cents).alias("price"), (col("event_id") % 7).cast("string").alias("size"), F.when(col("event_id") % 2 == 0, "BUY").otherwise("SELL").alias("side"), none.alias("best_bid"), none.alias("best_ask"))
    levels = F.lit(None).cast("array<struct<price:string,size:string>>")
    m = base(spark, sf_dir, "events").select(F.lit("price_change").alias("event_type"), col("event_id").alias("seq"), "ts", none.alias("asset_id"), levels.alias("bids"), levels.alias("asks"), F.array(change).alias("price_changes"))
    return books.p_updates(m).select("ticker", "side", "tick", "size", "seq")


@query(f"""WITH {LEVELS}, p AS (SELECT *, row_number() OVER (PARTITION BY pair_id ORDER BY profit DESC, buy_venue DESC) AS rn FROM walk WHERE profit > 0) SELECT pair_id, buy_venue, round(profit + 1e-7, 4) AS profit, round(volume + 1e-7, 4) AS volume FROM p WHERE rn = 1""")
def st5_live_evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST5: what the live state evaluates, on whole books pair by pair (the stream itself is compared in the tests)."""
    import pandas as pd

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        own = {"K": books.Book(), "P": books.Book()}
        for r in pdf.itertuples():
            own[r.venue].apply("put", r.side, round(r.price * books.TICKS), r.size)
        found = books.evaluate(own["K"], own["P"])
        return pd.DataFrame([{"pair_id": pdf["pair_id"].iloc[0], "buy_venue": found["buy_venue"], "profit": found["profit"], "volume": found["volume"]}] if found else [], columns=["pair_id", "buy_venue", "profit", "volume"])

    levels = view(spark, sf_dir, "v_book").withColumnRenamed("size", "size")
    out = levels.groupBy("pair_id").applyInPandas(run, "pair_id long, buy_venue string, profit double, volume double")
    return out.select("pair_id", "buy_venue", F.round(col("profit") + 1e-7, 4).alias("profit"), F.round(col("volume") + 1e-7, 4).alias("volume"))


@query("SELECT pair_id, provenance FROM v_decisions WHERE pair_id % 3 = 0")
def s4_pass_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = view(spark, sf_dir, "v_decisions").select("pair_id", "provenance")
    done = d.select("pair_id", (col("pair_id") % 3 == 0).alias("needs_frontier"), F.lit(False).alias("needs_tiebreak"))
    return envelopes.pass_inputs(d, done, "frontier")


@query("""SELECT CAST(pair_id AS VARCHAR) AS custom_id, '{"model":"m","messages":[{"role":"system","content":"judge"},{"role":"user","content":"' || tier || '"}],"max_completion_tokens":400,"response_format":{"type":"json_object"}}' AS body FROM v_decisions""")
def x50_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = view(spark, sf_dir, "v_decisions").select(col("pair_id").cast("string").alias("pair_id"), col("tier").alias("payload"))
    return envelopes.requests(d, "m", "judge").select("custom_id", "body")


@query("SELECT pair_id, CAST(pair_id % 9 AS INT) AS number, pair_id % 2 = 0 AS yes FROM v_decisions")
def s15_parsed_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.concat((col("pair_id") % 9).cast("string"), F.when(col("pair_id") % 2 == 0, ". YES").otherwise(") no, since"), F.lit("\nand 7 more"))
    return view(spark, sf_dir, "v_decisions").select("pair_id", F.explode(contracts.parsed_answers(line)).alias("a")).select("pair_id", "a.number", "a.yes")


@query("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey, l_linenumber ORDER BY l_quantity DESC, l_orderkey, l_partkey) AS rn FROM lineitem) SELECT l_suppkey AS k_bet_id, l_linenumber AS p_bet_id, l_quantity AS weight FROM r WHERE rn = 1""")
def s5_contract_bridges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best decision per contract key; event matches come from S6."""
    li = base(spark, sf_dir, "lineitem")
    records = li.select(
        F.concat(F.lpad(col("l_orderkey").cast("string"), 12, "0"), F.lpad(col("l_partkey").cast("string"), 12, "0")).alias("pair_id"), F.lit("outcome_outcome").alias("candidate_type"), F.lit("valid").alias("status"), F.lit("MATCH").alias("decision"),
        col("l_quantity").alias("weight"), F.lit("k").alias("k_id"), F.lit("p").alias("p_id"), col("l_suppkey").alias("k_bet_id"), col("l_linenumber").alias("p_bet_id"),
    )
    from pyspark.sql.window import Window

    w = Window.partitionBy("k_id", "p_id", "k_bet_id", "p_bet_id").orderBy(F.desc("weight"), "pair_id")
    return matching.bridges(records, w).select("k_bet_id", "p_bet_id", "weight")


@query("SELECT c_custkey, c_custkey % 3 <> 0 AND (c_custkey % 2 = 0 OR c_custkey % 5 < 3) AS second_check FROM customer")
def r25_second_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = col("c_custkey")
    other = F.when(k % 3 == 0, "Team A wins").otherwise("Team A wins it")
    needs = contracts.needs_second_check(F.lit("Team A wins"), other, F.when(k % 5 < 3, 0.5).otherwise(0.9), F.lit("2026-01-01"), F.when(k % 2 == 0, "").otherwise("2026-01-01"))
    return base(spark, sf_dir, "customer").select("c_custkey", needs.alias("second_check"))
