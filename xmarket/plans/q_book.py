"""Queries of the order-book operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from xmarket.operators import book
from xmarket.plans.registry import query
from xmarket.plans.views import base, view

LEVELS = """cum AS (SELECT *, sum(size) OVER (PARTITION BY pair_id, venue, side ORDER BY CASE WHEN side = 'ask' THEN price ELSE -price END ROWS UNBOUNDED PRECEDING) AS hi FROM v_book),
overlap AS (SELECT a.pair_id, a.venue AS buy_venue, a.price AS a, b.price AS b, least(a.hi, b.hi) - greatest(a.hi - a.size, b.hi - b.size) AS q,
    CASE WHEN a.venue = 'K' THEN 0.07 * a.price * (1 - a.price) ELSE 0 END AS bf, CASE WHEN b.venue = 'K' THEN 0.07 * (1 - b.price) * b.price ELSE 0 END AS sf
  FROM cum a JOIN cum b ON a.pair_id = b.pair_id AND a.side = 'ask' AND b.side = 'bid' AND a.venue <> b.venue
   AND greatest(a.hi - a.size, b.hi - b.size) < least(a.hi, b.hi)),
best AS (SELECT a.pair_id, a.venue AS buy_venue, min(a.price) AS best_ask, max(b.price) AS best_bid FROM v_book a JOIN v_book b ON a.pair_id = b.pair_id AND a.side = 'ask' AND b.side = 'bid' AND a.venue <> b.venue GROUP BY ALL),
walk AS (SELECT best.pair_id, best.buy_venue, best_ask, best_bid, coalesce(sum(q), 0) AS volume, coalesce(sum(q * (b - a - bf - sf)), 0) AS profit,
    coalesce(sum(q * (a + bf)), 0) AS buy_investment, coalesce(sum(q * (1 - b + sf)), 0) AS sell_investment, coalesce(sum(q * (bf + sf)), 0) AS fees
  FROM best LEFT JOIN overlap o ON o.pair_id = best.pair_id AND o.buy_venue = best.buy_venue AND b - a - bf - sf > 1e-12 GROUP BY ALL)"""


def _rounded(df: DataFrame, *cols: str) -> DataFrame:
    """To four decimals; a small push keeps halves from falling either way by the order of a sum."""
    return df.select(*(F.round(F.col(c) + 1e-7, 4).alias(c) if c in cols else c for c in df.columns))


MONEY = ("volume", "profit", "buy_investment", "sell_investment", "fees", "roi", "spread", "investment", "k_investment", "p_investment", "best_ask", "best_bid")


@query(f"""WITH {LEVELS} SELECT pair_id, buy_venue, round(best_ask + 1e-7, 4) AS best_ask, round(best_bid + 1e-7, 4) AS best_bid, round(volume + 1e-7, 4) AS volume, round(profit + 1e-7, 4) AS profit,
 round(buy_investment + 1e-7, 4) AS buy_investment, round(sell_investment + 1e-7, 4) AS sell_investment, round(fees + 1e-7, 4) AS fees,
 round(CASE WHEN buy_investment + sell_investment > 0 THEN profit / (buy_investment + sell_investment) ELSE 0 END + 1e-7, 4) AS roi, round((best_bid - best_ask) / best_ask + 1e-7, 4) AS spread FROM walk""")
def s9_depth_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(book.depth_walk(view(spark, sf_dir, "v_book"), "pair_id"), *MONEY)


@query(f"""WITH {LEVELS}, p AS (SELECT *, profit / nullif(buy_investment + sell_investment, 0) AS roi FROM walk WHERE profit > 0),
r AS (SELECT *, row_number() OVER (PARTITION BY pair_id ORDER BY profit DESC, buy_venue DESC) AS rn FROM p)
SELECT pair_id, buy_venue, CASE WHEN buy_venue = 'K' THEN 'P' ELSE 'K' END AS sell_venue, round(volume + 1e-7, 4) AS volume, round(profit + 1e-7, 4) AS profit, round(roi + 1e-7, 4) AS roi,
 round((best_bid - best_ask) / best_ask + 1e-7, 4) AS spread, round(fees + 1e-7, 4) AS fees, round(buy_investment + sell_investment + 1e-7, 4) AS investment,
 round(CASE WHEN buy_venue = 'K' THEN buy_investment ELSE sell_investment END + 1e-7, 4) AS k_investment, round(CASE WHEN buy_venue = 'K' THEN sell_investment ELSE buy_investment END + 1e-7, 4) AS p_investment
FROM r WHERE rn = 1""")
def s11_opportunities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(book.opportunities(view(spark, sf_dir, "v_book"), "pair_id"), *MONEY)


@query(f"""WITH {LEVELS}, p AS (SELECT *, profit / nullif(buy_investment + sell_investment, 0) AS roi FROM walk WHERE profit > 0),
r AS (SELECT *, row_number() OVER (PARTITION BY pair_id ORDER BY profit DESC, buy_venue DESC) AS rn FROM p)
SELECT pair_id, round(profit + 1e-7, 4) AS profit, round(roi + 1e-7, 4) AS roi FROM r WHERE rn = 1 AND profit >= 10 AND roi >= 0.01""")
def f9_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = book.listed(book.opportunities(view(spark, sf_dir, "v_book"), "pair_id"), 10.0, 0.01)
    return _rounded(found.select("pair_id", "profit", "roi"), "profit", "roi")


@query("SELECT pair_id, venue, CASE WHEN side = 'bid' THEN 'ask' ELSE 'bid' END AS side, round(1 - price, 4) AS price, size FROM v_book")
def s10_opposite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return book.opposite(view(spark, sf_dir, "v_book")).select("pair_id", "venue", "side", F.round("price", 4).alias("price"), "size")


@query("""SELECT pair_id, venue, side, round(price, 4) AS price, size, sum(size) OVER (PARTITION BY pair_id, venue, side ORDER BY CASE WHEN side = 'ask' THEN price ELSE -price END ROWS UNBOUNDED PRECEDING) AS hi,
 sum(size) OVER (PARTITION BY pair_id, venue, side ORDER BY CASE WHEN side = 'ask' THEN price ELSE -price END ROWS UNBOUNDED PRECEDING) - size AS lo FROM v_book""")
def w4_cumulative_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return book.cumulative(view(spark, sf_dir, "v_book"), "pair_id").withColumn("price", F.round("price", 4))


@query("""WITH b AS (SELECT pair_id, venue, max(price) FILTER (side = 'bid') AS bb, min(price) FILTER (side = 'ask') AS ba FROM v_book GROUP BY ALL)
SELECT pair_id FROM b GROUP BY pair_id HAVING count(*) = 2 AND count(*) FILTER (bb > 0 AND bb < 1 AND ba > 0 AND ba < 1) = 2""")
def f15_book_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return book.tradable(view(spark, sf_dir, "v_book"), "pair_id")


@query("""WITH RECURSIVE o AS (SELECT ticker, side, tick, seq, CAST(delta AS DECIMAL(28,4)) AS delta, row_number() OVER (PARTITION BY ticker, side, tick ORDER BY seq) AS rn FROM v_delta),
q AS (SELECT ticker, side, tick, seq, rn, CAST(greatest(0, delta) AS DECIMAL(28,4)) AS size FROM o WHERE rn = 1
  UNION ALL SELECT o.ticker, o.side, o.tick, o.seq, o.rn, CAST(greatest(0, q.size + o.delta) AS DECIMAL(28,4)) FROM q JOIN o ON o.ticker = q.ticker AND o.side = q.side AND o.tick = q.tick AND o.rn = q.rn + 1)
SELECT ticker, side, tick, seq, CAST(size AS DOUBLE) AS size FROM q""")
def w5_delta_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = book.replay_deltas(view(spark, sf_dir, "v_delta"), "ticker", "side", "tick")
    return out.select("ticker", "side", "tick", "seq", F.col("size").cast("double").alias("size"))


@query("""WITH r AS (SELECT ticker, side, tick, CAST(delta AS DOUBLE) AS size, row_number() OVER (PARTITION BY ticker, side, tick ORDER BY seq DESC) AS rn FROM v_delta)
SELECT ticker, side, tick, size FROM r WHERE rn = 1 AND size > 0""")
def w6_latest_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = view(spark, sf_dir, "v_delta").select("ticker", "side", "tick", "seq", F.col("delta").cast("double").alias("size"))
    return book.final_levels(messages, "ticker", "side", "tick")


@query("""SELECT 'm' || CAST(l_orderkey % 50 AS VARCHAR) AS pair_id, 'P' AS venue, CASE WHEN l_linenumber % 2 = 0 THEN 'ask' ELSE 'bid' END AS side, round(CASE WHEN l_orderkey % 50 < 25 THEN 1 - l_discount ELSE l_discount END, 4) AS price,
 CAST(count(*) AS BIGINT) AS n FROM (SELECT *, CASE WHEN l_linenumber % 2 = 0 THEN 1 ELSE 0 END FROM lineitem WHERE l_orderkey % 50 < 25) GROUP BY ALL
UNION ALL SELECT 'm' || CAST(l_orderkey % 50 AS VARCHAR), 'P', CASE WHEN l_linenumber % 2 = 0 THEN 'bid' ELSE 'ask' END, round(l_discount, 4), count(*) FROM lineitem WHERE l_orderkey % 50 >= 25 GROUP BY ALL""")
def j20_book_pairing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = base(spark, sf_dir, "lineitem")
    ticker = (F.col("l_orderkey") % 50).cast("string")
    side = F.when(F.col("l_linenumber") % 2 == 0, "bid").otherwise("ask")
    books = rows.select(F.lit("P").alias("venue"), ticker.alias("ticker"), side.alias("side"), F.col("l_discount").alias("price"), F.col("l_quantity").alias("size"))
    ids = spark.range(50)
    mapping = ids.select(F.concat(F.lit("m"), "id").alias("pair_id"), F.lit("none").alias("k_ticker"), F.col("id").cast("string").alias("p_ticker"), F.when(F.col("id") < 25, "Opposite").otherwise("Same").alias("mapping"))
    paired = book.pair_books(books, mapping)
    return paired.groupBy("pair_id", "venue", "side", F.round("price", 4).alias("price")).agg(F.count(F.lit(1)).alias("n"))
