"""Queries of snapshots, caches, unions and source normalisation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from xmarket.functions.text import title_case
from xmarket.operators import sync
from xmarket.plans.registry import query
from xmarket.plans.views import base, view
from xmarket.sources import markets

col = F.col


@query("SELECT n.bet_id, n.title, coalesce(o.sync_status, 'New') AS sync_status FROM v_new n LEFT JOIN v_old o USING (bet_id)")
def j5_snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sync.snapshot_diff(view(spark, sf_dir, "v_old"), view(spark, sf_dir, "v_new"))


@query("""SELECT (SELECT count(*) FROM (SELECT bet_id FROM v_new EXCEPT SELECT bet_id FROM v_old) a) AS new, (SELECT count(*) FROM (SELECT bet_id FROM v_new INTERSECT SELECT bet_id FROM v_old) b) AS existing,
 (SELECT count(*) FROM (SELECT bet_id FROM v_old EXCEPT SELECT bet_id FROM v_new) c) AS removed""")
def u2_diff_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sync.diff_counts(view(spark, sf_dir, "v_old"), view(spark, sf_dir, "v_new"))


@query("SELECT bet_id AS \"Bet ID\", title AS \"Market Title\", '' AS \"Platform\", 'x' AS extra FROM v_new")
def p6_align_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "v_new").select(col("bet_id").alias("Bet ID"), col("title").alias("Market Title"), F.lit("x").alias("extra"))
    return sync.align(rows, ["Platform", "Bet ID", "Market Title"])


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders) x WHERE rn = 1")
def w7_first_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P7, J9 and W7."""
    return sync.first_by(base(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"], [F.asc("o_orderkey")])


_TAKEN = "taken AS (SELECT k_id, p_id FROM v_matches WHERE k_id % 7 = 0)"


@query(f"WITH {_TAKEN} SELECT k_id, p_id FROM v_matches WHERE k_id NOT IN (SELECT k_id FROM taken) AND p_id NOT IN (SELECT p_id FROM taken)")
def j6_not_yet_matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J6, J7 and J12."""
    m = view(spark, sf_dir, "v_matches").select("k_id", "p_id")
    return sync.without_ids(m, m.where("k_id % 7 = 0"), ("k_id", "k_id"), ("p_id", "p_id"))


_ACTIVE = "ka AS (SELECT o_orderkey AS id FROM orders WHERE o_orderstatus <> 'F'), pa AS (SELECT p_partkey AS id FROM part WHERE p_size > 20), rej AS (SELECT k_id, p_id FROM v_matches WHERE (k_id + p_id) % 5 = 0)"


def _active(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    m = view(spark, sf_dir, "v_matches").select("k_id", "p_id")
    k = base(spark, sf_dir, "orders").where("o_orderstatus <> 'F'").select(col("o_orderkey").alias("id"))
    p = base(spark, sf_dir, "part").where("p_size > 20").select(col("p_partkey").alias("id"))
    return m, k, p, m.where("(k_id + p_id) % 5 = 0")


@query(f"WITH {_ACTIVE} SELECT k_id, p_id FROM v_matches m WHERE k_id IN (SELECT id FROM ka) AND p_id IN (SELECT id FROM pa) AND NOT EXISTS (SELECT 1 FROM rej r WHERE r.k_id = m.k_id AND r.p_id = m.p_id)")
def j8_active_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    m, k, p, rejected = _active(spark, sf_dir)
    return sync.active_matches(m, m, k, p, rejected)[0]


@query(f"""WITH {_ACTIVE}, kept AS (SELECT k_id, p_id FROM v_matches m WHERE k_id IN (SELECT id FROM ka) AND p_id IN (SELECT id FROM pa) AND NOT EXISTS (SELECT 1 FROM rej r WHERE r.k_id = m.k_id AND r.p_id = m.p_id))
SELECT l_orderkey AS k_id, l_partkey AS p_id, l_linenumber AS bet_no FROM lineitem WHERE EXISTS (SELECT 1 FROM kept WHERE k_id = l_orderkey AND p_id = l_partkey)""")
def j8_active_bets(spark: SparkSession, sf_dir: str) -> DataFrame:
    m, k, p, rejected = _active(spark, sf_dir)
    bets = base(spark, sf_dir, "lineitem").select(col("l_orderkey").alias("k_id"), col("l_partkey").alias("p_id"), col("l_linenumber").alias("bet_no"))
    return sync.active_matches(m, bets, k, p, rejected)[1]


@query("SELECT s_suppkey, unnest([CAST(s_suppkey AS VARCHAR), CAST(s_nationkey AS VARCHAR)]) AS id FROM supplier")
def j10_ids_of_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = base(spark, sf_dir, "supplier").select("s_suppkey", F.concat_ws(" ; ", col("s_suppkey").cast("string"), col("s_nationkey").cast("string"), F.lit("")).alias("ids"))
    return sync.explode_ids(rows, "ids").drop("ids")


@query("SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN coalesce(n_name, 'Unknown') ELSE c_name END AS title FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_nationkey % 2 = 0) n ON c_nationkey = n_nationkey")
def j11_fill_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = base(spark, sf_dir, "customer").select("c_custkey", col("c_nationkey").alias("key"), F.when(col("c_custkey") % 4 == 0, "NaN").otherwise(col("c_name")).alias("title"))
    names = base(spark, sf_dir, "nation").where("n_nationkey % 2 = 0").select(col("n_nationkey").alias("key"), col("n_name").alias("title"))
    return sync.fill_titles(rows, names, "key").select("c_custkey", "title")


@query("""WITH u AS (SELECT bet_id, title, sync_status AS note, 1 AS ord FROM v_old UNION ALL SELECT bet_id, title, NULL, 2 FROM v_new), r AS (SELECT *, row_number() OVER (PARTITION BY bet_id ORDER BY ord DESC) AS rn FROM u)
SELECT bet_id, title, note, ord FROM r WHERE rn = 1""")
def u1_union_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = view(spark, sf_dir, "v_old").select("bet_id", "title", col("sync_status").alias("note"), F.lit(1).alias("ord"))
    return sync.union_latest(old, view(spark, sf_dir, "v_new").withColumn("ord", F.lit(2)), ["bet_id"], "ord")


@query("""SELECT bet_id, title, CASE WHEN bet_id IN (SELECT bet_id FROM v_new) THEN '2026-02-01' ELSE '2026-01-01' END AS last_verified_at, '2026-01-01' AS created_at, false AS is_expired FROM (SELECT bet_id, coalesce(n.title, o.title) AS title FROM v_old o LEFT JOIN v_new n USING (bet_id)) x
UNION ALL SELECT bet_id, title, '2026-02-01', '2026-02-01', false FROM v_new WHERE bet_id NOT IN (SELECT bet_id FROM v_old)""")
def u4_cache_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    cache = view(spark, sf_dir, "v_old").select("bet_id", "title", F.lit("2026-01-01").alias("last_verified_at"), F.lit("2026-01-01").alias("created_at"), F.lit(False).alias("is_expired"))
    return sync.upsert(cache, view(spark, sf_dir, "v_new"), ["bet_id"], "2026-02-01")


@query(f"""WITH {_ACTIVE} SELECT k_id, p_id, (k_id % 11 = 0 OR k_id NOT IN (SELECT id FROM ka) OR p_id NOT IN (SELECT id FROM pa)) AS is_expired,
 CASE WHEN k_id % 11 = 0 THEN 'old' WHEN k_id NOT IN (SELECT id FROM ka) OR p_id NOT IN (SELECT id FROM pa) THEN 'inactive' ELSE '' END AS expire_reason FROM v_matches""")
def u5_cache_expiry(spark: SparkSession, sf_dir: str) -> DataFrame:
    m, k, p, _ = _active(spark, sf_dir)
    cache = m.withColumn("is_expired", col("k_id") % 11 == 0).withColumn("expire_reason", F.when(col("k_id") % 11 == 0, "old").otherwise(""))
    return sync.expire(cache, k, p)


@query("SELECT k_id, p_id, (k_id % 3 = 0) AS covered FROM v_matches")
def u3_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = view(spark, sf_dir, "v_matches").select("k_id", "p_id")
    return sync.coverage(m, m.where("k_id % 3 = 0"))


@query(r"""SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'not a date' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS normalized FROM events""")
def p4_normalize_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    offset = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00"))
    raw = F.when(col("event_id") % 3 == 0, "not a date").when(col("event_id") % 3 == 1, iso).otherwise(offset)
    return base(spark, sf_dir, "events").select("event_id", markets.normalize_date(raw).alias("normalized"))


@query("""SELECT n_nationkey, CASE n_nationkey % 3 WHEN 0 THEN 'Other' WHEN 1 THEN 'Sports' ELSE upper(left(w1, 1)) || lower(substr(w1, 2)) || CASE WHEN w2 <> '' THEN ' ' || upper(left(w2, 1)) || lower(substr(w2, 2)) ELSE '' END || '-A' END AS category
FROM (SELECT n_nationkey, split_part(n_name, ' ', 1) AS w1, split_part(n_name, ' ', 2) AS w2 FROM nation) x""")
def p3_normalize_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.when(col("n_nationkey") % 3 == 0, F.lit("")).when(col("n_nationkey") % 3 == 1, F.lit(" NBA ")).otherwise(F.concat(F.lower("n_name"), F.lit("-a")))
    return base(spark, sf_dir, "nation").select("n_nationkey", markets.normalize_category(raw, {"nba": "Sports"}).alias("category"))


@query("SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(left(w, 1)) || lower(substr(w, 2))), ' ') AS title FROM part")
def p3_title_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    return base(spark, sf_dir, "part").select("p_partkey", title_case(col("p_name")).alias("title"))


@query("""WITH m AS (SELECT c_custkey AS id, c_name AS question, CASE WHEN c_custkey % 3 = 0 THEN [] WHEN c_custkey % 3 = 1 THEN ['Yes', 'No'] ELSE ['Alpha'] END AS outs FROM customer),
x AS (SELECT id, question, CASE WHEN len(outs) = 0 THEN ['Yes'] ELSE outs END AS outs FROM m)
SELECT CAST(id AS VARCHAR) AS market_id, i - 1 AS place, outs[i] AS outcome, CASE WHEN i = 1 AND id % 3 <> 0 THEN 't' || id ELSE CAST(id AS VARCHAR) || '_' || CAST(i - 1 AS VARCHAR) END AS bet_id, question || ' [' || outs[i] || ']' AS bet_title
FROM (SELECT id, question, outs, unnest(range(1, len(outs) + 1)) AS i FROM x) y""")
def p2_explode_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    outs = F.when(col("c_custkey") % 3 == 0, F.lit("[]")).when(col("c_custkey") % 3 == 1, F.lit('["Yes","No"]')).otherwise(F.lit('["Alpha"]'))
    tokens = F.when(col("c_custkey") % 3 == 0, F.lit("[]")).otherwise(F.concat(F.lit('["t'), "c_custkey", F.lit('"]')))
    rows = base(spark, sf_dir, "customer").select(col("c_custkey").cast("string").alias("market_id"), col("c_name").alias("question"), outs.alias("outcomes"), tokens.alias("tokens"))
    return markets.explode_outcomes(rows).select("market_id", "place", "outcome", "bet_id", "bet_title")


@query("SELECT count(*) AS n, count(*) FILTER (o_orderstatus = 'O') AS active FROM orders WHERE o_orderstatus <> 'F'")
def f1_active_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = base(spark, sf_dir, "orders").select(F.when(col("o_orderstatus") == "O", "active").otherwise(col("o_orderstatus")).alias("status"), (col("o_orderstatus") == "F").alias("closed"))
    open_rows = rows.where(~col("closed"))
    return open_rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(markets.is_active(col("status"), F.lit(True), F.lit(False))).alias("active"))


@query("""SELECT DISTINCT o_custkey AS event_id FROM orders o WHERE NOT (o_custkey % 2 = 0) OR o_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')""")
def f4_events_to_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events that aren't indexed yet or have a new row."""
    o = base(spark, sf_dir, "orders").select(col("o_custkey").alias("event_id"), F.when(col("o_orderstatus") == "P", "New").otherwise("Existing").alias("sync_status"))
    indexed = o.where("event_id % 2 = 0").select("event_id").distinct()
    return markets.to_index(o, indexed)


@query("""SELECT o_custkey AS event_id, count(DISTINCT o_orderpriority) AS bet_title_count, string_agg(DISTINCT o_orderpriority, '|' ORDER BY o_orderpriority) AS bet_titles, min(o_orderkey) AS first_row FROM orders GROUP BY o_custkey""")
def g2_event_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = base(spark, sf_dir, "orders").select(col("o_custkey").alias("event_id"), col("o_orderpriority").alias("bet_title"), col("o_orderkey").cast("string").alias("title"), F.lit("c").alias("category"), F.lit("s").alias("sub_category"), col("o_orderkey").alias("ord"))
    out = markets.event_index(o)
    return out.select("event_id", "bet_title_count", F.array_join("bet_titles", "|").alias("bet_titles"), col("title").cast("long").alias("first_row"))
