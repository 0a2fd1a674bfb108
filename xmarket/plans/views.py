"""Synthetic market tables over the driver's tables, as SQL that Spark and DuckDB both read.

Base tables are written as {name}: Spark gets DataFrames, DuckDB the bare names.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

VIEWS: dict[str, str] = {}

VIEWS["v_titles"] = """
SELECT o.o_orderkey AS event_id, CASE WHEN o.o_orderkey % 2 = 0 THEN 'K' ELSE 'P' END AS platform,
  CASE CAST(floor(o.o_orderkey / 2) AS BIGINT) % 8
    WHEN 0 THEN 'Will ' || n.n_name || ' win Group ' || substr('ABCDEFGH', CAST(o.o_orderkey % 8 + 1 AS INT), 1) || ' by ' || m.m_name || ' ' || CAST(o.o_custkey % 28 + 1 AS VARCHAR(4)) || ', ' || CAST(2025 + o.o_orderkey % 3 AS VARCHAR(4)) || '?'
    WHEN 1 THEN n.n_name || ' vs ' || n2.n_name
    WHEN 2 THEN 'Will the price be above ' || CAST(o.o_custkey % 90 + 5 AS VARCHAR(4)) || '% in Q' || CAST(o.o_orderkey % 4 + 1 AS VARCHAR(4)) || ' ' || CAST(2025 + o.o_orderkey % 3 AS VARCHAR(4)) || '?'
    WHEN 3 THEN 'CA-' || CAST(o.o_custkey % 30 + 10 AS VARCHAR(4)) || ' nominee ' || CAST(2025 + o.o_orderkey % 3 AS VARCHAR(4))
    WHEN 4 THEN 'Highest temperature in ' || n.n_name || ' on ' || m.m_name || ' ' || CAST(o.o_custkey % 28 + 1 AS VARCHAR(4)) || '?'
    WHEN 5 THEN 'Fed decision in ' || m.m_name || ' ' || CAST(2025 + o.o_orderkey % 3 AS VARCHAR(4)) || ' meeting'
    WHEN 6 THEN n.n_name || ' presidential election winner ' || CAST(2025 + o.o_orderkey % 3 AS VARCHAR(4))
    ELSE 'Group ' || substr('ABCDEFGH', CAST(o.o_orderkey % 8 + 1 AS INT), 1) || ' champion of the 2025-26 season, less than ' || CAST(o.o_custkey % 9 + 1 AS VARCHAR(4)) || '.50 points'
  END AS title,
  c.c_mktsegment AS category, n.n_name AS sub_category, o.o_custkey AS account
FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey JOIN {nation} n ON c.c_nationkey = n.n_nationkey
  JOIN {nation} n2 ON n2.n_nationkey = (c.c_nationkey + o.o_orderkey % 7 + 1) % 25
  JOIN (VALUES (0, 'January'), (1, 'February'), (2, 'March'), (3, 'April'), (4, 'May'), (5, 'June'), (6, 'July'), (7, 'August'), (8, 'Sept.'), (9, 'Oct'), (10, 'November'), (11, 'December')) AS m(m_id, m_name)
    ON m.m_id = o.o_custkey % 12"""

# titles whose words are as rare as names and prices are: what blocking joins on grows with the orders of one customer
VIEWS["v_listings"] = """
SELECT o.o_orderkey AS event_id, CASE WHEN o.o_orderkey % 2 = 0 THEN 'K' ELSE 'P' END AS platform,
  'Will Holder' || CAST(o.o_custkey AS VARCHAR(12)) || ' be at Price' || CAST(CAST(floor(o.o_totalprice) AS BIGINT) AS VARCHAR(12)) || '?' AS title,
  c.c_mktsegment AS category, n.n_name AS sub_category, o.o_custkey AS account
FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey JOIN {nation} n ON c.c_nationkey = n.n_nationkey"""

VIEWS["v_book"] = """
SELECT pair_id, venue, side, tick / 10000.0 AS price, size FROM (
  SELECT pair_id, venue, side, tick, CAST(sum(quantity) AS DOUBLE) AS size FROM (
    SELECT l_suppkey AS pair_id, CASE WHEN l_linenumber % 2 = 0 THEN 'K' ELSE 'P' END AS venue, 'bid' AS side,
      CAST(4400 - round(l_tax * 10000) + (CASE WHEN l_linenumber % 2 = 0 THEN 0 ELSE 600 END) AS INT) AS tick, l_quantity AS quantity FROM {lineitem}
    UNION ALL
    SELECT l_suppkey, CASE WHEN l_linenumber % 2 = 0 THEN 'K' ELSE 'P' END, 'ask',
      CAST(4500 + round(l_discount * 10000) + (CASE WHEN l_linenumber % 2 = 0 THEN 0 ELSE 600 END) AS INT), l_quantity FROM {lineitem}) x
  GROUP BY pair_id, venue, side, tick) y"""

VIEWS["v_delta"] = """
SELECT user_id AS ticker, CASE WHEN event_type IN ('click', 'view') THEN 'yes' ELSE 'no' END AS side, event_id % 20 + 1 AS tick, event_id AS seq,
  CAST(CASE WHEN event_id % 2 = 0 THEN value ELSE -value END AS DECIMAL(18,4)) AS delta FROM {events}"""

VIEWS["v_edges"] = """
SELECT DISTINCT l_suppkey AS k_id, l_partkey AS p_id, l_quantity AS quality FROM {lineitem}"""

VIEWS["v_decisions"] = """
SELECT d.doc_id AS pair_id, d.source AS provenance, d.lang AS tier, CASE WHEN l.quality = 1 THEN 'MATCH' ELSE 'NO_MATCH' END AS expected,
  CASE WHEN d.doc_id % 11 = 0 THEN 'AMBIGUOUS' WHEN l.toxic = 1 THEN 'NO_MATCH' ELSE 'MATCH' END AS actual,
  CASE WHEN d.doc_id % 13 = 0 THEN 'error' ELSE 'valid' END AS status, (d.doc_id % 100) / 100.0 AS confidence
FROM {documents} d JOIN {labels} l ON d.doc_id = l.doc_id"""

VIEWS["v_usage"] = """
SELECT conv_id, turn, role, length(text) AS chars, CASE WHEN turn % 2 = 0 THEN 'gpt-5-mini' ELSE 'gpt-5' END AS model, conv_id % 12 + 1 AS month_no,
  CAST(length(text) AS BIGINT) AS input_tokens, CAST(floor(length(text) / 3) AS BIGINT) AS cached_tokens, CAST(turn * 10 + 5 AS BIGINT) AS output_tokens
FROM {conversations}"""

VIEWS["v_old"] = "SELECT CAST(c_custkey AS VARCHAR(20)) AS bet_id, c_name AS title, CASE WHEN c_custkey % 3 = 0 THEN 'New' ELSE 'Existing' END AS sync_status FROM {customer} WHERE c_custkey % 10 <> 0"
VIEWS["v_new"] = "SELECT CAST(c_custkey AS VARCHAR(20)) AS bet_id, c_name || ' v2' AS title FROM {customer} WHERE c_custkey % 10 <> 1"

VIEWS["v_outcomes"] = """
SELECT p_partkey AS bet_id, CASE WHEN p_partkey % 2 = 0 THEN 'K' ELSE 'P' END AS venue, p_brand AS event_id, p_name AS title,
  lower(p_type) AS outcome_key, p_size AS size_no, p_retailprice AS price FROM {part}"""

VIEWS["v_matches"] = "SELECT DISTINCT l_orderkey AS k_id, l_partkey AS p_id, l_suppkey AS quality FROM {lineitem}"


def frames(spark: SparkSession, sf_dir: str, sql: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in BASE if "{" + name + "}" in sql}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sql = VIEWS[name]
    return spark.sql(sql, **frames(spark, sf_dir, sql))


def base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def duck(query: str) -> str:
    """A DuckDB query with the views that it names as common table expressions in front."""
    used = [name for name in VIEWS if re.search(rf"\b{name}\b", query)]
    bare = lambda sql: re.sub(r"\{(\w+)\}", r"\1", sql)
    heads = ", ".join(f"{name} AS ({bare(VIEWS[name])})" for name in used)
    if not used:
        return query
    text = query.strip()
    for start in ("WITH RECURSIVE ", "WITH "):
        if text.upper().startswith(start):
            return f"{start}{heads}, {text[len(start):]}"
    return f"WITH {heads} {text}"
