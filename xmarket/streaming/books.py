"""Live books as Structured Streaming: messages become level updates, state is kept per pair, opportunities are upserts.

Messages of both venues are normalised to rows (venue, ticker, kind, side, tick, size, seq, ts), fanned out to
every pair that holds the ticker, and keyed by pair, so that both books of a pair share one state (RocksDB when the
session names it).  Price levels are integer ticks of 1/10000.  A watermark and a time to live are options.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from xmarket.functions.pricing import FEE_RATE

col = F.col
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
TICKS = 10_000

K_MESSAGE = "type string, seq long, ts timestamp, msg struct<market_ticker:string,side:string,price_dollars:string,delta_fp:string,price:double,delta:double,yes_dollars_fp:array<array<string>>,no_dollars_fp:array<array<string>>,yes:array<array<double>>,no:array<array<double>>>"
P_MESSAGE = "event_type string, seq long, ts timestamp, asset_id string, bids array<struct<price:string,size:string>>, asks array<struct<price:string,size:string>>, price_changes array<struct<asset_id:string,price:string,size:string,side:string,best_bid:string,best_ask:string>>"
UPDATE = "venue string, ticker string, kind string, side string, tick int, size double, best_bid double, best_ask double, seq long, ts timestamp"


def _tick(price: Column) -> Column:
    return F.round(price.cast("double") * TICKS).cast("int")


def k_updates(messages: DataFrame) -> DataFrame:
    """ST1 and ST2: snapshots replace a book, deltas add to a level; a price of the no side is an ask at 1 - price.

    Prices come as dollar texts, or in the older form as cents.  Messages without a ticker, or deltas without side,
    price or amount, are ignored.
    """
    m = messages.where("msg.market_ticker is not null")
    level = lambda c, side, scale: F.transform(c, lambda x: F.struct(F.lit(side).alias("side"), (x[0].cast("double") / scale).alias("price"), x[1].cast("double").alias("size")))
    none = F.array().cast("array<struct<side:string,price:double,size:double>>")
    both = lambda fp, cents, side: F.coalesce(level(fp, side, 1.0), level(cents, side, 100.0), none)
    snap = m.where("type = 'orderbook_snapshot'").withColumn("l", F.concat(both(col("msg.yes_dollars_fp"), col("msg.yes"), "yes"), both(col("msg.no_dollars_fp"), col("msg.no"), "no")))
    head = snap.select(F.lit("K").alias("venue"), col("msg.market_ticker").alias("ticker"), F.lit("clear").alias("kind"), F.lit("").alias("side"), F.lit(0).alias("tick"), F.lit(0.0).alias("size"), "seq", "ts")
    as_book = lambda side, price: (F.when(side == "yes", "bid").otherwise("ask"), _tick(F.when(side == "yes", price).otherwise(F.lit(1.0) - price)))
    puts = snap.select("*", F.explode("l").alias("x"))
    side, tick = as_book(col("x.side"), col("x.price"))
    puts = puts.select(F.lit("K").alias("venue"), col("msg.market_ticker").alias("ticker"), F.lit("put").alias("kind"), side.alias("side"), tick.alias("tick"), col("x.size").alias("size"), "seq", "ts")
    price, amount = F.coalesce(col("msg.price_dollars").cast("double"), col("msg.price") / 100.0), F.coalesce(col("msg.delta_fp").cast("double"), col("msg.delta"))
    delta = m.where("type = 'orderbook_delta'").where(col("msg.side").isin("yes", "no") & price.isNotNull() & amount.isNotNull())
    side, tick = as_book(col("msg.side"), price)
    adds = delta.select(F.lit("K").alias("venue"), col("msg.market_ticker").alias("ticker"), F.lit("add").alias("kind"), side.alias("side"), tick.alias("tick"), amount.alias("size"), "seq", "ts")
    return _shaped(head.unionByName(puts).unionByName(adds))


def p_updates(messages: DataFrame) -> DataFrame:
    """ST3 and ST4: books replace; price changes set a level to an absolute size and may override the best prices."""
    book = messages.where("event_type = 'book' and asset_id is not null")
    head = book.select(F.lit("P").alias("venue"), col("asset_id").alias("ticker"), F.lit("clear").alias("kind"), F.lit("").alias("side"), F.lit(0).alias("tick"), F.lit(0.0).alias("size"), "seq", "ts")
    tagged = lambda c, side: F.transform(F.coalesce(c, F.array().cast("array<struct<price:string,size:string>>")), lambda x: F.struct(F.lit(side).alias("side"), x["price"].alias("price"), x["size"].alias("size")))
    puts = book.select("asset_id", "seq", "ts", F.explode(F.concat(tagged(col("bids"), "bid"), tagged(col("asks"), "ask"))).alias("x"))
    puts = puts.select(F.lit("P").alias("venue"), col("asset_id").alias("ticker"), F.lit("put").alias("kind"), col("x.side").alias("side"), _tick(col("x.price")).alias("tick"), col("x.size").cast("double").alias("size"), "seq", "ts")
    change = messages.where("event_type = 'price_change'").select("seq", "ts", F.explode("price_changes").alias("x")).where("x.asset_id is not null and x.price is not null and x.size is not null")
    sets = change.select(
        F.lit("P").alias("venue"), col("x.asset_id").alias("ticker"), F.lit("put").alias("kind"), F.when(F.upper("x.side") == "BUY", "bid").otherwise("ask").alias("side"), _tick(col("x.price")).alias("tick"),
        col("x.size").cast("double").alias("size"), "seq", "ts", col("x.best_bid").cast("double").alias("best_bid"), col("x.best_ask").cast("double").alias("best_ask"),
    )
    return _shaped(head.unionByName(puts).unionByName(sets, allowMissingColumns=True))


def _shaped(df: DataFrame) -> DataFrame:
    for c in ("best_bid", "best_ask"):
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("double"))
    return df.select("venue", "ticker", "kind", "side", "tick", "size", "best_bid", "best_ask", "seq", "ts")


def by_pair(updates: DataFrame, mapping: DataFrame) -> DataFrame:
    """ST5: updates of every pair that holds the ticker; mapping(pair_id, k_ticker, p_ticker, mapping) is a static table."""
    k = mapping.select("pair_id", F.lit("K").alias("venue"), col("k_ticker").alias("ticker"), F.lit(False).alias("mirror"))
    p = mapping.select("pair_id", F.lit("P").alias("venue"), col("p_ticker").alias("ticker"), (col("mapping") == "Opposite").alias("mirror"))
    return updates.join(k.unionByName(p), ["venue", "ticker"])


class Book:
    """Levels of one side-by-side book: {(side, tick): size}; sizes of zero or less are gone."""

    def __init__(self, levels: dict[tuple[str, int], float] | None = None):
        self.levels = dict(levels or {})

    def apply(self, kind: str, side: str, tick: int, size: float) -> None:
        if kind == "clear":
            self.levels.clear()
            return
        now = size if kind == "put" else self.levels.get((side, tick), 0.0) + size
        if now > 1e-9:
            self.levels[side, tick] = now
        else:
            self.levels.pop((side, tick), None)

    def side(self, side: str) -> list[tuple[float, float]]:
        rows = [(t / TICKS, s) for (x, t), s in self.levels.items() if x == side]
        return sorted(rows, reverse=side == "bid")

    def mirrored(self) -> Book:
        return Book({("ask" if s == "bid" else "bid", TICKS - t): n for (s, t), n in self.levels.items()})


def walk(asks: list[tuple[float, float]], bids: list[tuple[float, float]], buy_fee: bool, sell_fee: bool) -> dict[str, float]:
    """S9 for one pair in memory, as the table operator says it: cumulative depths of both sides cut each other into
    intervals of quantity, each interval has one ask and one bid, and those with a gain are summed."""
    ask, bid = np.array(asks, float).reshape(-1, 2), np.array(bids, float).reshape(-1, 2)
    depth, offer = np.cumsum(ask[:, 1]), np.cumsum(bid[:, 1])
    ends = np.union1d(depth, offer)
    ends = ends[ends <= min(depth[-1], offer[-1])] if len(ask) and len(bid) else ends[:0]
    quantity = np.diff(ends, prepend=0.0)
    a, b = ask[np.searchsorted(depth, ends), 0], bid[np.searchsorted(offer, ends), 0]
    buy, sell = a + FEE_RATE * a * (1 - a) * buy_fee, 1 - b + FEE_RATE * b * (1 - b) * sell_fee
    gain = 1 - buy - sell
    traded = np.where(gain > 1e-12, quantity, 0.0)
    return {"volume": float(traded.sum()), "profit": float(traded @ gain), "buy": float(traded @ buy), "sell": float(traded @ sell), "fees": float(traded @ (b - a - gain))}


def evaluate(k: Book, p: Book) -> dict[str, Any] | None:
    """ST5 and S11: the better direction, None without a gain; books need all four sides inside (0, 1)."""
    sides = (k.side("ask"), k.side("bid"), p.side("ask"), p.side("bid"))
    if not all(sides) or not all(0 < s[0][0] < 1 for s in sides):
        return None
    one, two = walk(sides[0], sides[3], True, False), walk(sides[2], sides[1], False, True)
    best, buy = (one, "K") if one["profit"] > two["profit"] and one["profit"] > 0 else (two, "P")
    if best["profit"] <= 0:
        return None
    capital = best["buy"] + best["sell"]
    return {"buy_venue": buy, "volume": best["volume"], "profit": best["profit"], "investment": capital, "fees": best["fees"], "roi": best["profit"] / capital if capital else 0.0}


OUT = StructType([StructField("pair_id", StringType()), StructField("action", StringType()), StructField("seq", LongType()), StructField("buy_venue", StringType()), *(StructField(c, DoubleType()) for c in ("volume", "profit", "investment", "fees", "roi"))])


class PairBooks(StatefulProcessor):
    """Levels of both books of a pair in a map state; emits an upsert per batch with a gain, else a delete."""

    def __init__(self, ttl_ms: int | None = None):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.levels = handle.getMapState("levels", "venue string, side string, tick int", "size double", ttlDurationMs=self.ttl_ms)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        books, before = {"K": Book(), "P": Book()}, {}
        for (venue, side, tick), (size,) in self.levels.iterator():
            books[venue].levels[side, tick] = before[venue, side, tick] = size
        batch = pd.concat(list(rows)).sort_values("seq", kind="stable")
        order = {"clear": 0}
        batch = batch.assign(_o=[order.get(k, 1) for k in batch["kind"]]).sort_values(["seq", "_o"], kind="stable")
        for r in batch.itertuples():
            side, tick = r.side, int(r.tick)
            if r.mirror and r.kind != "clear":
                side, tick = ("ask" if side == "bid" else "bid"), TICKS - tick
            books[r.venue].apply(r.kind, side, tick, float(r.size))
        now = {(venue, *at): size for venue, book in books.items() for at, size in book.levels.items()}
        for at in before.keys() - now.keys():
            self.levels.removeKey(at)
        for at, size in now.items():
            if before.get(at) != size:  # only levels that changed are written
                self.levels.updateValue(at, (size,))
        found = evaluate(books["K"], books["P"])
        row = {"pair_id": key[0], "action": "upsert" if found else "delete", "seq": int(batch["seq"].max())} | (found or {"buy_venue": "", "volume": 0.0, "profit": 0.0, "investment": 0.0, "fees": 0.0, "roi": 0.0})
        yield pd.DataFrame([row])

    def close(self) -> None:
        pass


def opportunities(updates: DataFrame, ttl_ms: int | None = None) -> DataFrame:
    """ST5: a stream of upserts and deletes of opportunities per pair, from by_pair() rows."""
    return updates.groupBy("pair_id").transformWithStateInPandas(PairBooks(ttl_ms), OUT, outputMode="Update", timeMode="ProcessingTime" if ttl_ms else "None")


class Scanner:
    """ST6: start, stop and status of the live query; the latest row per pair is kept in a table folder by batch."""

    def __init__(self, messages: DataFrame, mapping: DataFrame, checkpoint: str, sink: str, ttl_ms: int | None = None):
        self.stream = opportunities(by_pair(messages, mapping), ttl_ms)
        self.checkpoint, self.sink = checkpoint, sink
        self.query: Any = None

    def start(self, available_now: bool = False) -> Scanner:
        sink = self.sink

        def upsert(batch: DataFrame, number: int) -> None:
            batch.write.mode("overwrite").parquet(f"{sink}/batch={number}")  # a retried batch replaces its own folder

        writer = self.stream.writeStream.outputMode("update").option("checkpointLocation", self.checkpoint).foreachBatch(upsert)
        self.query = (writer.trigger(availableNow=True) if available_now else writer).start()
        return self

    def stop(self) -> None:
        if self.query is not None:
            self.query.stop()

    def status(self) -> dict[str, Any]:
        return {"running": bool(self.query is not None and self.query.isActive), "progress": self.query.lastProgress if self.query is not None else None}

    def current(self) -> DataFrame:
        """The latest row per pair that is no delete, best first."""
        rows = self.stream.sparkSession.read.parquet(self.sink)
        latest = rows.groupBy("pair_id").agg(F.max_by(F.struct(*(c for c in rows.columns if c not in ("pair_id", "batch"))), F.struct("batch", "seq")).alias("r")).select("pair_id", "r.*")
        return latest.where("action = 'upsert'").orderBy(F.desc("profit"), F.desc("roi"))
