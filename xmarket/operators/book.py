"""Order books in long form (pair, venue, side, price, size) and the depth walk over them.

A walk buys the asks of one venue and sells into the bids of the other, cheapest and dearest first, as long as
the margin after fees is positive.  The margin falls along the walk, so "stop at the first loss" is "keep what
has a gain", and the walk is a sweep: both sides are cut at each other's cumulative sizes.  The sweep sorts
each pair's levels once (no join of levels with levels), so a deep book costs its length, not its square.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from xmarket.functions.pricing import venue_fee

FEE_VENUE = "K"


def opposite(books: DataFrame) -> DataFrame:
    """The book of the complementary outcome: sides swap at 1 - price, to four decimals."""
    return books.withColumn("side", F.when(F.col("side") == "bid", "ask").otherwise("bid")).withColumn("price", F.bround(F.lit(1.0) - F.col("price"), 4))


def best_levels(books: DataFrame, *keys: str) -> DataFrame:
    """best_bid and best_ask per key; null where a side is empty."""
    return books.groupBy(*keys).agg(F.max(F.when(F.col("side") == "bid", F.col("price"))).alias("best_bid"), F.min(F.when(F.col("side") == "ask", F.col("price"))).alias("best_ask"))


def tradable(books: DataFrame, *keys: str) -> DataFrame:
    """keys whose books have all four sides, with every best price inside (0, 1)."""
    inside = lambda c: (c > 0) & (c < 1)
    by_venue = best_levels(books, *keys, "venue")
    ok = inside(F.col("best_bid")) & inside(F.col("best_ask"))
    return by_venue.groupBy(*keys).agg(F.count_if(ok).alias("good"), F.count(F.lit(1)).alias("all")).where("good = 2 and all = 2").select(*keys)


def cumulative(books: DataFrame, *keys: str) -> DataFrame:
    """(lo, hi] of every level in its side's walk: asks from the cheapest, bids from the dearest."""
    order = F.when(F.col("side") == "ask", F.col("price")).otherwise(-F.col("price"))
    w = Window.partitionBy(*keys, "venue", "side").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return books.withColumn("hi", F.sum("size").over(w)).withColumn("lo", F.col("hi") - F.col("size"))


def _fee(venue: Column, price: Column) -> Column:
    return F.when(venue == FEE_VENUE, venue_fee(price)).otherwise(F.lit(0.0))


def depth_walk(books: DataFrame, *keys: str) -> DataFrame:
    """S9 in both directions: per key and buying venue the volume, investments, fees, profit, roi and spread.

    books must have two venues per key; keys without asks on one venue and bids on the other give no row.
    """
    levels = cumulative(books, *keys)
    buys = levels.where("side = 'ask'").select(*keys, F.col("venue").alias("buy_venue"), "hi", F.col("price").alias("ask"), F.lit(None).cast("double").alias("bid"))
    other = F.when(F.col("venue") == "K", F.lit("P")).otherwise(F.lit("K"))
    sells = levels.where("side = 'bid'").select(*keys, other.alias("buy_venue"), "hi", F.lit(None).cast("double").alias("ask"), F.col("price").alias("bid"))
    points = buys.unionByName(sells)
    sweep = Window.partitionBy(*keys, "buy_venue").orderBy("hi")
    ahead = sweep.rangeBetween(Window.currentRow, Window.unboundedFollowing)
    pieces = (
        points.withColumn("quantity", F.col("hi") - F.coalesce(F.lag("hi").over(sweep), F.lit(0.0)))
        .withColumn("a", F.first("ask", ignorenulls=True).over(ahead))
        .withColumn("b", F.first("bid", ignorenulls=True).over(ahead))
    )
    buy_fee = _fee(F.col("buy_venue"), F.col("a"))
    sell_fee = F.when(F.col("buy_venue") != FEE_VENUE, venue_fee(F.lit(1.0) - F.col("b"))).otherwise(F.lit(0.0))
    pieces = pieces.withColumn("buy_unit", F.col("a") + buy_fee).withColumn("sell_unit", F.lit(1.0) - F.col("b") + sell_fee).withColumn("fee", buy_fee + sell_fee)
    gain = F.lit(1.0) - F.col("buy_unit") - F.col("sell_unit")
    trades = (F.col("a").isNotNull()) & F.col("b").isNotNull() & (gain > 1e-12)
    total = lambda c: F.sum(F.when(trades, c * F.col("quantity")).otherwise(F.lit(0.0)))
    walked = pieces.groupBy(*keys, "buy_venue").agg(
        total(F.lit(1.0)).alias("volume"), total(gain).alias("profit"), total(F.col("buy_unit")).alias("buy_investment"),
        total(F.col("sell_unit")).alias("sell_investment"), total(F.col("fee")).alias("fees"), F.min("ask").alias("best_ask"), F.max("bid").alias("best_bid"),
    )
    capital = F.col("buy_investment") + F.col("sell_investment")
    return (
        walked.where(F.col("best_ask").isNotNull() & F.col("best_bid").isNotNull())
        .withColumn("roi", F.when(capital > 0, F.col("profit") / capital).otherwise(F.lit(0.0)))
        .withColumn("spread", F.when(F.col("best_ask") > 0, (F.col("best_bid") - F.col("best_ask")) / F.col("best_ask")).otherwise(F.lit(0.0)))
    )


def opportunities(books: DataFrame, *keys: str, source: str = "K") -> DataFrame:
    """The better direction per key; buying at the source wins only if strictly better and positive."""
    walks = depth_walk(books, *keys)
    fields = ["volume", "profit", "buy_investment", "sell_investment", "fees", "roi", "spread"]
    side = lambda here: F.max(F.when((F.col("buy_venue") == source) == F.lit(here), F.struct(F.col("buy_venue").alias("buy_venue"), *fields)))
    both = walks.groupBy(*keys).agg(side(True).alias("first"), side(False).alias("second"))
    one, two = F.coalesce("first.profit", F.lit(0.0)), F.coalesce("second.profit", F.lit(0.0))
    best = both.withColumn("best", F.when((one > two) & (one > 0), F.col("first")).when(two > 0, F.col("second"))).where("best is not null")
    buys_k = F.col("best.buy_venue") == "K"
    return best.select(
        *keys, "best.buy_venue", F.when(buys_k, "P").otherwise("K").alias("sell_venue"), "best.volume", "best.profit", "best.roi", "best.spread", "best.fees",
        (F.col("best.buy_investment") + F.col("best.sell_investment")).alias("investment"),
        F.when(buys_k, F.col("best.buy_investment")).otherwise(F.col("best.sell_investment")).alias("k_investment"),
        F.when(buys_k, F.col("best.sell_investment")).otherwise(F.col("best.buy_investment")).alias("p_investment"),
    )


def listed(found: DataFrame, min_profit: float = 0.0, min_roi: float = 0.0) -> DataFrame:
    """Opportunities at or above both bounds, best first."""
    return found.where((F.col("profit") >= min_profit) & (F.col("roi") >= min_roi)).orderBy(F.desc("profit"), F.desc("roi"))


def pair_books(books: DataFrame, mapping: DataFrame) -> DataFrame:
    """Books (venue, ticker, side, price, size) of the tickers in mapping(pair_id, k_ticker, p_ticker, mapping).

    A ticker in several pairs is fanned out to each; P books of opposite pairs are mirrored.
    """
    k = mapping.select("pair_id", F.lit("K").alias("venue"), F.col("k_ticker").alias("ticker"), F.lit(False).alias("mirror"))
    p = mapping.select("pair_id", F.lit("P").alias("venue"), F.col("p_ticker").alias("ticker"), (F.col("mapping") == "Opposite").alias("mirror"))
    joined = books.join(k.unionByName(p), ["venue", "ticker"])
    flip = F.col("mirror")
    return joined.select(
        "pair_id", "venue", F.when(flip, F.when(F.col("side") == "bid", "ask").otherwise("bid")).otherwise(F.col("side")).alias("side"),
        F.when(flip, F.bround(F.lit(1.0) - F.col("price"), 4)).otherwise(F.col("price")).alias("price"), "size",
    )


def replay_deltas(messages: DataFrame, *keys: str, seq: str = "seq") -> DataFrame:
    """W5, the batch twin of ST1 and ST2: the size of every level after each message, for messages (keys, epoch, delta, seq).

    Sizes add up and never go below zero: q = S - least(0, running minimum of S), two running windows over exact
    decimals.  A snapshot starts a new epoch with its sizes as first deltas.
    """
    w = Window.partitionBy(*keys).orderBy(seq).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = messages.withColumn("s", F.sum(F.col("delta").cast("decimal(18,4)")).over(w))
    return total.withColumn("size", F.col("s") - F.least(F.lit(0).cast("decimal(28,4)"), F.min("s").over(w))).drop("s")


def final_levels(messages: DataFrame, *keys: str, seq: str = "seq") -> DataFrame:
    """W6, the batch twin of ST4: the last absolute size per level; sizes of zero or less are gone."""
    return messages.groupBy(*keys).agg(F.max_by("size", seq).alias("size")).where("size > 0")
