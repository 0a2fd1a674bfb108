"""Queries of keywords, signatures, envelopes, contexts, review data and outcome rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from xmarket.functions.text import strings
from xmarket.operators import envelopes, keywords, metrics, outcomes
from xmarket.plans.q_pairs import index
from xmarket.plans.q_text import LEXICON
from xmarket.plans.registry import query
from xmarket.plans.views import base, view

col = F.col


@query(r"""SELECT event_id, array_to_string(list_sort(list_distinct(list_concat(list_transform(regexp_extract_all(title, '\b(20[2-3][0-9])\b', 1), lambda v: 'year:' || v), list_transform(regexp_extract_all(title, '(?i)\b([a-z]{2}-(?:\d{1,2}|al))\b', 1), lambda v: 'district:' || upper(v)),
 list_transform(list_filter(regexp_extract_all(title, '(?i)\bgroup\s+([a-z0-9]+)\b', 1), lambda v: length(v) = 1 OR regexp_matches(v, '^[0-9]+$')), lambda v: 'group:' || upper(v))))), '|') AS structured FROM v_titles""")
def x13_structured_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "v_titles").select("event_id", F.array_join(F.array_sort(keywords.structured(col("title"))), "|").alias("structured"))


@query()
def x14_event_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X12 to X14 whole; cases are compared in the tests."""
    t = view(spark, sf_dir, "v_titles")
    return t.select("event_id", F.array_join(keywords.extract_keywords(col("title"), col("category"), col("sub_category"), LEXICON), "|").alias("keywords"))


@query()
def x15_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X15 and IO10: half of the events come from the cache."""
    t = view(spark, sf_dir, "v_titles")
    sig = t.select("event_id", keywords.signature(col("title"), col("category"), LEXICON).alias("signature"))
    out = keywords.refresh_signatures(t, sig.where("event_id % 2 = 0"), LEXICON)
    return out.select("event_id", F.array_join("signature", "|").alias("signature"))


@query(r"""SELECT event_id, array_to_string(list_sort(list_distinct(list_filter(string_split(trim(regexp_replace(lower(title), '[^a-z]+', ' ', 'g')), ' '), lambda w: length(w) > 1 AND NOT list_contains(['a','an','and','any','are','at','be','before','by','does','end','for','from','have','has','how','if','in','is','many','much','next','of','on','or','the','this','to','what','when','where','which','who','will','with'], w)))), '|') AS tokens FROM v_titles""")
def x17_cleanup_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "v_titles").select("event_id", F.array_join(keywords.cleanup_title_tokens(col("title")), "|").alias("tokens"))


@query()
def x21_x22_consolidated_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of nations, part types and segments from three sources, merged by their variants."""
    names = base(spark, sf_dir, "nation").select(col("n_name").alias("name"), F.lit("gpe").alias("kind"), F.lit("nation").alias("source"))
    more = base(spark, sf_dir, "customer").select(col("c_mktsegment").alias("name"), F.lit("topic").alias("kind"), F.lit("customer").alias("source")).distinct()
    parts = base(spark, sf_dir, "part").select(col("p_type").alias("name"), F.lit("topic").alias("kind"), F.lit("part").alias("source")).distinct()
    out = keywords.consolidate(names.unionByName(more).unionByName(parts))
    return out.select("canonical", "kind", F.array_join("variants", "|").alias("variants"), F.array_join("sources", "|").alias("sources"))


@query("SELECT k_id, p_id, left(sha256('{\"k\":\"' || k_id || '\",\"kind\":\"event\",\"p\":\"' || p_id || '\"}'), 24) AS pair_id FROM v_matches")
def p17_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelopes.envelope(view(spark, sf_dir, "v_matches"), "event").select("k_id", "p_id", "pair_id")


@query("""SELECT p_partkey, '{' || CASE WHEN p_partkey % 2 = 0 THEN '"k":["a","b"],' ELSE '' END || '"t":"' || p_brand || '"}' AS payload FROM part""")
def p18_compact_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.when(col("p_partkey") % 2 == 0, strings(["a", "b", "c"])).otherwise(F.array().cast("array<string>"))
    return base(spark, sf_dir, "part").select("p_partkey", envelopes.payload({"t": col("p_brand"), "k": words, "e": F.lit("")}, {"k": 2}).alias("payload"))


@query("""WITH d AS (SELECT o_custkey AS event_id, o_orderkey AS bet_id, o_orderpriority AS description, o_orderkey AS ord FROM orders),
r AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY length(description) DESC, ord) AS rn FROM d)
SELECT d.event_id, max(r.description) AS description, string_agg(CAST(d.bet_id AS VARCHAR), ',' ORDER BY d.ord) AS bets FROM d JOIN r ON r.event_id = d.event_id AND rn = 1 GROUP BY d.event_id""")
def g9_contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = base(spark, sf_dir, "orders").select(col("o_custkey").alias("event_id"), col("o_orderkey").alias("bet_id"), col("o_orderstatus").alias("bet_title"), col("o_orderpriority").alias("description"), col("o_orderkey").alias("ord"))
    return envelopes.contexts(o).select("event_id", "description", F.array_join(F.transform("contracts", lambda c: c["bet_id"].cast("string")), ",").alias("bets"))


@query("""WITH f AS (SELECT o_custkey AS event_id, o_orderpriority AS title, min(o_orderkey) AS ord FROM orders GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ord) AS rn FROM f)
SELECT event_id, string_agg(title, '|' ORDER BY ord) AS titles FROM r WHERE rn <= 4 GROUP BY event_id""")
def g9_short_contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = base(spark, sf_dir, "orders").select(col("o_custkey").alias("event_id"), col("o_orderpriority").alias("bet_title"), col("o_orderstatus").alias("description"), F.lit("").alias("rules"), F.lit("x").alias("event_description"), col("o_orderkey").alias("ord"))
    return envelopes.short_contexts(o).select("event_id", F.array_join("titles", "|").alias("titles"))


@query("""SELECT count(*) AS n, count(k.o_custkey) AS with_k, count(p.p_partkey) AS with_p FROM (SELECT DISTINCT k_id, p_id FROM v_matches) m LEFT JOIN (SELECT DISTINCT o_custkey FROM orders) k ON k.o_custkey = m.k_id LEFT JOIN part p ON p.p_partkey = m.p_id AND p_size > 10""")
def j15_context_attach(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = base(spark, sf_dir, "orders").select(col("o_custkey").alias("event_id"), F.lit("d").alias("description"), F.lit("c").alias("contracts")).distinct()
    p = base(spark, sf_dir, "part").where("p_size > 10").select(col("p_partkey").alias("event_id"), F.lit("d").alias("description"), F.lit("c").alias("contracts"))
    m = view(spark, sf_dir, "v_matches").select("k_id", "p_id").distinct()
    both = envelopes.with_contexts(m, k).drop("p_context").join(envelopes.with_contexts(m, p).select("k_id", "p_id", "p_context"), ["k_id", "p_id"])
    return both.agg(F.count(F.lit(1)).alias("n"), F.count("k_context").alias("with_k"), F.count("p_context").alias("with_p"))


@query("SELECT DISTINCT k_id, p_id FROM v_matches WHERE k_id % 2 = 0 AND (k_id + p_id) % 3 <> 0")
def j17_legacy_import(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J17 and J18."""
    m = envelopes.envelope(view(spark, sf_dir, "v_matches").select("k_id", "p_id").distinct(), "event")
    return envelopes.import_confirmed(m.where("k_id % 2 = 0"), m, m.where("(k_id + p_id) % 3 = 0").select("pair_id")).select("k_id", "p_id")


@query("SELECT DISTINCT x.id, n_name AS name FROM (SELECT k_id AS id FROM v_edges UNION SELECT p_id FROM v_edges) x JOIN nation ON n_nationkey = x.id")
def j14_graph_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    details = base(spark, sf_dir, "nation").select(col("n_nationkey").cast("long").alias("id"), col("n_name").alias("name"))
    return envelopes.graph_nodes(view(spark, sf_dir, "v_edges"), details)


@query("""WITH e AS (SELECT *, row_number() OVER (ORDER BY quality DESC, k_id, p_id) AS cluster_id FROM v_edges) SELECT cluster_id, k_id, p_id, n.n_name AS k_name, p.p_brand AS p_name FROM e LEFT JOIN nation n ON n_nationkey = k_id LEFT JOIN part p ON p_partkey = p_id""")
def j13_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    record = lambda df, key, name: df.select(col(key).cast("long").alias("event_id"), col(name).alias("title"), F.lit("").alias("category"), F.lit("").alias("sub_category"))
    nations, parts = record(base(spark, sf_dir, "nation"), "n_nationkey", "n_name"), record(base(spark, sf_dir, "part"), "p_partkey", "p_brand")
    k = nations.select(col("event_id").alias("k_id"), col("title").alias("k_name"))
    p = parts.select(col("event_id").alias("p_id"), col("title").alias("p_name"))
    out = envelopes.clusters(view(spark, sf_dir, "v_edges"), nations.limit(0), [F.desc("quality"), F.asc("k_id"), F.asc("p_id")])
    return out.drop("k_event", "p_event").join(k, "k_id", "left").join(p, "p_id", "left").select("cluster_id", "k_id", "p_id", "k_name", "p_name")


@query("""WITH m AS (SELECT DISTINCT k_id, p_id FROM v_matches), c AS (SELECT k_id, p_id FROM m WHERE (k_id + p_id) % 97 = 0)
SELECT m.k_id, m.p_id, CASE WHEN (m.k_id + m.p_id) % 97 = 0 THEN 'confirmed' WHEN m.k_id IN (SELECT k_id FROM c) OR m.p_id IN (SELECT p_id FROM c) THEN 'skipped' WHEN (m.k_id + m.p_id) % 5 = 1 THEN 'rejected' END AS status FROM m""")
def g22_verification_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = view(spark, sf_dir, "v_matches").select("k_id", "p_id").distinct()
    out = envelopes.verification_status(m, m.where("(k_id + p_id) % 97 = 0"), m.where("(k_id + p_id) % 5 = 1").withColumn("reason", F.lit("date")))
    return out.select("k_id", "p_id", "status")


@query("""SELECT pair_id, CASE WHEN pair_id % 7 = 0 THEN 'error' ELSE 'valid' END AS status, CASE WHEN pair_id % 7 = 0 THEN 'AMBIGUOUS' WHEN actual = 'MATCH' AND pair_id % 2 = 0 THEN 'AMBIGUOUS' WHEN actual = 'NO_MATCH' AND pair_id % 2 <> 0 THEN 'AMBIGUOUS' ELSE actual END AS decision FROM v_decisions""")
def x52_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    pid = col("pair_id")
    cells = [x for d in envelopes.MATRIX for x in (F.lit(d), F.when((pid % 2 == 0) & F.lit(d == "time"), "conflict").when((pid % 7 == 0) & F.lit(d == "scope"), "maybe").otherwise("same"))]
    rows = view(spark, sf_dir, "v_decisions").select("pair_id", col("actual").alias("decision"), F.create_map(*cells).alias("matrix"))
    return envelopes.check_matrix(rows).select("pair_id", "status", "decision")


@query(r"""WITH t AS (SELECT event_id, title, regexp_extract(title, '\b(20[2-3][0-9])\b', 1) AS y, regexp_extract(title, '\b(\d+)(?:\.\d+)?%', 1) AS n, sub_category AS s FROM v_titles)
SELECT event_id || ':subject_conflict' AS example_id, replace(title, s, 'Someone Else') AS p_title FROM t WHERE contains(title, s)
UNION ALL SELECT event_id || ':year_conflict', regexp_replace(title, '\b20[2-3][0-9]\b', CAST(CAST(y AS INT) + 1 AS VARCHAR)) FROM t WHERE y <> ''
UNION ALL SELECT event_id || ':missing_year', trim(regexp_replace(title, '\s*\b20[2-3][0-9]\b', '')) FROM t WHERE y <> ''
UNION ALL SELECT event_id || ':threshold_conflict', regexp_replace(title, '\b\d+(?:\.\d+)?%', CAST(CAST(n AS INT) + 5 AS VARCHAR) || '%') FROM t WHERE n <> ''""")
def x53_mutations(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = view(spark, sf_dir, "v_titles").select(col("event_id").cast("string").alias("pair_id"), col("title").alias("k_title"), col("title").alias("p_title"), col("sub_category").alias("k_subject"))
    return envelopes.mutations(t).select("example_id", "p_title")


@query("""WITH u AS (SELECT *, CASE provenance WHEN 'src1' THEN 1 WHEN 'src2' THEN 2 WHEN 'src3' THEN 3 END AS rk FROM v_decisions WHERE provenance IN ('src1', 'src2', 'src3')), r AS (SELECT *, row_number() OVER (PARTITION BY provenance ORDER BY sha256(CAST(pair_id AS VARCHAR)), pair_id) AS rn FROM u)
SELECT pair_id, treatment FROM r, (SELECT unnest(['a', 'b']) AS treatment) t WHERE rn <= CASE provenance WHEN 'src1' THEN 3 WHEN 'src2' THEN 5 ELSE 0 END""")
def s13_quota_and_treatments(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = view(spark, sf_dir, "v_decisions").select("pair_id", col("pair_id").alias("k_id"), col("pair_id").alias("p_id"), "provenance")
    return envelopes.treatments(envelopes.quota_sample(d, ["src1", "src2", "src3"], {"src1": 3, "src2": 5}), ["a", "b"]).select("pair_id", "treatment")


@query("""WITH c AS (SELECT k_id, p_id FROM v_edges WHERE k_id % 2 = 0), r AS (SELECT e.*, CASE WHEN quality > 25 THEN 'high' ELSE 'low' END AS segment, greatest(count(*) OVER (PARTITION BY k_id), count(*) OVER (PARTITION BY p_id)) AS degree FROM v_edges e)
SELECT segment, count(*) AS n, count(*) FILTER (k_id % 2 = 0) AS confirmed, max(degree) AS max_degree, count(*) FILTER (degree > 10) AS high_degree FROM r GROUP BY segment""")
def g8_audit_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = view(spark, sf_dir, "v_edges").withColumn("segment", F.when(col("quality") > 25, "high").otherwise("low"))
    return metrics.audit(e, e.where("k_id % 2 = 0"))[0]


@query("""WITH r AS (SELECT e.*, CASE WHEN quality > 25 THEN 'high' ELSE 'low' END AS segment FROM v_edges e), s AS (SELECT *, row_number() OVER (PARTITION BY segment ORDER BY k_id, p_id) AS rn FROM r) SELECT segment, k_id, p_id, rn FROM s WHERE rn <= 25""")
def g8_audit_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = view(spark, sf_dir, "v_edges").withColumn("segment", F.when(col("quality") > 25, "high").otherwise("low"))
    return metrics.audit(e, e.where("k_id % 2 = 0"))[1].select("segment", "k_id", "p_id", "rn")


@query(r"""SELECT p_partkey, regexp_matches(p_name, '(?i)[\[(]no[\])]\s*$') OR p_partkey % 5 = 0 AS no_side, p_partkey % 3 = 0 OR false AS generic FROM part""")
def f2_f3_outcome_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.when(col("p_partkey") % 5 == 0, "No").otherwise("Yes")
    subject = F.when(col("p_partkey") % 3 == 0, F.element_at(strings(["Other", "March 5", "2026", "Q1 2026"]), (col("p_partkey") % 4 + 1).cast("int"))).otherwise(F.concat(F.lit("team "), "p_name"))
    return base(spark, sf_dir, "part").select("p_partkey", outcomes.drops_no_side(name, col("p_name")).alias("no_side"), outcomes.is_generic_subject(subject).alias("generic"))


@query("""SELECT l_orderkey, l_linenumber, abs(datediff('day', CAST(l_shipdate AS DATE), CAST(l_shipdate AS DATE) + CAST(l_partkey % 4 AS INT))) <= 1 AS compatible, NOT (strftime(l_shipdate, '%m-%d') IN ('12-31', '01-01')) AS window_conflict FROM lineitem""")
def j23_x39_deadlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = F.date_format("l_shipdate", "yyyy-MM-dd")
    b = F.date_format(F.date_add(F.to_date("l_shipdate"), (col("l_partkey") % 4).cast("int")), "yyyy-MM-dd")
    return base(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", outcomes.deadlines_compatible(a, b).alias("compatible"), outcomes.annual_window_conflict(F.lit(True), a).alias("window_conflict"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_name ELSE 'question' END AS subject, 'win the ' || lower(c_mktsegment) || ' cup' AS intent FROM customer")
def x33_subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = F.concat(F.lit("Will "), F.when(col("c_custkey") % 2 == 0, col("c_name")).otherwise("the question"), F.lit(" win the cup?"))
    intent = F.concat(F.lit("will "), col("c_name"), F.lit(" win the "), F.lower("c_mktsegment"), F.lit(" cup"))
    c = base(spark, sf_dir, "customer").select("c_custkey", title.alias("title"), outcomes.intent_without_subject(intent, col("c_name")).alias("intent"))
    return outcomes.with_subject_from_title(c, "title").select("c_custkey", "subject", "intent")


@query(r"""SELECT event_id, CASE WHEN regexp_matches(title, '(?i)\b(before|by|until|through)\b.{0,25}\b20[2-3][0-9]') THEN '' ELSE array_to_string(list_sort(list_distinct(regexp_extract_all(title, '\b(20[2-3][0-9])\b', 1))), '|') END AS years FROM v_titles""")
def x35_event_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "v_titles").select("event_id", F.array_join(outcomes.event_years(col("title")), "|").alias("years"))


@query("SELECT p_partkey, p_size % 4 + 3 * (p_size % 3) + CASE WHEN p_size % 2 = 0 THEN 12 ELSE 0 END + CASE WHEN p_size % 5 = 0 THEN 3 ELSE 0 END + CASE WHEN p_size % 7 = 0 THEN 2 ELSE 0 END AS score, CASE WHEN p_size % 2 = 0 AND p_size % 3 = 0 THEN 'outcome_outcome' ELSE 'event_outcome' END AS kind FROM part")
def r22_outcome_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = col("p_size")
    some = lambda n: F.slice(strings(["a", "b", "c", "d"]), F.lit(1), n.cast("int"))
    score = outcomes.pair_score(some(s % 4), some(s % 3), s % 2 == 0, some(F.when(s % 5 == 0, 1).otherwise(0)), s % 7 == 0)
    return base(spark, sf_dir, "part").select("p_partkey", score.cast("long").alias("score"), outcomes.candidate_type(s % 2 == 0, s % 3 == 0).alias("kind"))


@query("""SELECT p_partkey, (p_size % 2 = 1 AND p_size % 3 = 1) OR p_size % 5 = 0 OR p_size % 7 = 0 OR p_size % 11 = 0 AS conflict FROM part""")
def r20_scope_conflict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R20 with one exclusive set, one namespace, and deadlines five days apart."""
    s = col("p_size")
    terms = lambda *pairs: F.array_compact(F.array(*(F.when(test, F.lit(t)) for test, t in pairs)))
    rows = base(spark, sf_dir, "part").select(
        "p_partkey", terms((s % 2 == 1, "winner"), (F.lit(True), "competition:a")).alias("k_scope_terms"), terms((s % 3 == 1, "qualifier"), (s % 5 == 0, "competition:b")).alias("p_scope_terms"),
        F.lit("2026-03-01").alias("k_deadline"), F.when(s % 7 == 0, "2026-03-06").otherwise("2026-03-02").alias("p_deadline"),
        F.array().cast("array<string>").alias("k_event_years"), F.array().cast("array<string>").alias("p_event_years"), F.lit("xi").alias("k_actor"), F.when(s % 11 == 0, "putin").otherwise("xi jinping").alias("p_actor"),
    )
    return rows.select("p_partkey", outcomes.scope_conflict("k", "p", [["winner", "qualifier"]], ["competition:"]).alias("conflict"))


@query()
def r26_contract_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R26 on all lines: a supplier and a line status are an event pair, parts are K bets, shipping days P bets, a return is a conflict; compared with a scan in the tests."""
    line = base(spark, sf_dir, "lineitem")
    rows = line.select(col("l_suppkey").alias("k_id"), col("l_linestatus").alias("p_id"), col("l_partkey").alias("k_bet_id"), F.to_date("l_shipdate").alias("p_bet_id"), "l_quantity", (col("l_returnflag") == "R").alias("conflict")).distinct()
    order = [F.desc("l_quantity"), F.asc("k_bet_id"), F.asc("p_bet_id"), F.asc("k_id"), F.asc("p_id")]
    return envelopes.one_to_one(rows, col("conflict"), order).select("k_id", "p_id", "k_bet_id", "p_bet_id", "l_quantity").distinct()


@query("SELECT c_custkey AS market_id, CASE WHEN c_custkey % 3 = 0 THEN 'tok' || c_custkey ELSE 'found' || c_custkey END AS token FROM customer")
def io16_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = base(spark, sf_dir, "customer").select(col("c_custkey").cast("string").alias("market_id"))
    known = c.where("market_id % 3 = 0").select("market_id", F.concat(F.lit("tok"), "market_id").alias("token"))
    return envelopes.token_ids(c, known, lambda m: f"found{m}").select(col("market_id").cast("long").alias("market_id"), "token")


_ORD = "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice"  # lines of an order may share a number


@query(f"""WITH m AS (SELECT row({_ORD}) AS ord, l_orderkey, CAST(l_partkey AS VARCHAR) AS k, CAST(l_suppkey AS VARCHAR) AS p FROM lineitem WHERE l_partkey % 4 <> 0),
a AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY ord DESC) AS r1 FROM m), b AS (SELECT *, row_number() OVER (PARTITION BY p ORDER BY ord DESC) AS r2 FROM a WHERE r1 = 1) SELECT l_orderkey, k AS k_bet_id, p AS p_bet_id FROM b WHERE r2 = 1""")
def io17_load_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IO17 on all lines; every fourth part has no id."""
    line = base(spark, sf_dir, "lineitem")
    rows = line.select("l_orderkey", F.struct(*_ORD.split(", ")).alias("ord"), F.when(col("l_partkey") % 4 != 0, col("l_partkey").cast("string")).alias("k_bet_id"), col("l_suppkey").cast("string").alias("p_bet_id"))
    return envelopes.load_matches(rows).select("l_orderkey", "k_bet_id", "p_bet_id")


@query("SELECT c_custkey, c_custkey < 100 AS in_budget FROM customer")
def t3_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = base(spark, sf_dir, "customer").select(col("c_custkey").alias("cust_id"))
    return metrics.budget_split(c, [F.asc("cust_id")], 100).select(col("cust_id").alias("c_custkey"), "in_budget")


@query("SELECT p_partkey, p_partkey % 4 >= 2 AS kept FROM part")
def f8_quality_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    tier = F.element_at(strings(["weak", "medium", "strong", "exact"]), (col("p_partkey") % 4 + 1).cast("int"))
    return base(spark, sf_dir, "part").select("p_partkey", metrics.meets_quality(tier, "strong").alias("kept"))


@query("SELECT DISTINCT o_custkey, o_orderstatus FROM orders o WHERE o_orderkey = (SELECT max(o_orderkey) FROM orders i WHERE i.o_custkey = o.o_custkey)")
def p14_last_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    from xmarket.sources.markets import rows_by_id

    return rows_by_id(base(spark, sf_dir, "orders"), "o_custkey", "o_orderkey", "o_orderstatus")


@query()
def j1_candidate_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole of J1 and J2 on all keywords: blocking, categories, keep rules, rejecting rules, quality."""
    from xmarket.operators.candidates import build_pairs

    out = build_pairs(index(spark, sf_dir, "v_listings").drop("bet_titles"), {})
    return out.select("k_id", "p_id", "mode", "path", "quality_score", "quality_tier", F.array_join("common_keywords", "|").alias("common_keywords"))


