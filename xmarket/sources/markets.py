"""Market rows of both venues: REST sources as Python data sources, and the projections to one shape (IO1 to IO5, P1 to P4)."""

from __future__ import annotations

import json
import time
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from xmarket.functions.text import literal_map, safe_text, title_case

col = F.col
PAGES, K_PAGE, P_PAGE = 50, 200, 500


def get_json(url: str, params: dict[str, Any], opener: Callable[[str], str] | None = None, retries: int = 4, backoff: float = 0.5, timeout: float = 20.0, pause: Callable[[float], None] = time.sleep) -> Any:
    """IO4: a GET that retries on errors, 429 and 5xx with doubling pauses; None if all tries fail."""
    full = f"{url}?{urllib.parse.urlencode(params)}" if params else url
    for n in range(retries):
        try:
            if opener is not None:
                return json.loads(opener(full))
            with urllib.request.urlopen(full, timeout=timeout) as answer:  # noqa: S310
                return json.loads(answer.read())
        except Exception as e:  # noqa: BLE001
            code = getattr(e, "code", 500)
            if code != 429 and code < 500:
                return None
            if n + 1 < retries:
                pause(backoff * 2**n)
    return None


def cursor_pages(url: str, page: int, params: dict[str, Any], items: str, cursor: str, fetch: Callable[[str, dict[str, Any]], Any], max_pages: int = PAGES) -> Iterator[dict[str, Any]]:
    """IO1 and IO2: the items of all pages; ends on an empty or repeated cursor, or at the cap."""
    seen: set[str] = set()
    at = ""
    for _ in range(max_pages):
        answer = fetch(url, params | {"limit": page} | ({"cursor": at} if at else {})) or {}
        yield from answer.get(items, [])
        at = str(answer.get(cursor) or "")
        if not at or at in seen:
            return
        seen.add(at)


class _Chain(InputPartition):
    def __init__(self, url: str):
        self.url = url


class _EventReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options = options

    def partitions(self) -> list[InputPartition]:
        return [_Chain(u) for u in self.options["url"].split(",")]  # a cursor chain is sequential: one partition each

    def read(self, partition: InputPartition) -> Iterator[tuple[str]]:
        o = self.options
        fetch = lambda url, params: get_json(url, params)
        pages = cursor_pages(partition.url, int(o.get("page", K_PAGE)), json.loads(o.get("params", "{}")), o.get("items", "events"), o.get("cursor", "cursor"), fetch, int(o.get("max_pages", PAGES)))
        for item in pages:
            yield (json.dumps(item),)


class RestEvents(DataSource):
    """spark.read.format("rest_events").option("url", ...): one JSON text per event; options page, params, items, cursor, max_pages."""

    @classmethod
    def name(cls) -> str:
        return "rest_events"

    def schema(self) -> str:
        return "value string"

    def reader(self, schema: Any) -> DataSourceReader:
        return _EventReader(dict(self.options))


K_EVENT = "event_ticker string, series_ticker string, title string, category string, sub_title string, markets array<struct<ticker:string,status:string,title:string,subtitle:string,yes_sub_title:string,rules_primary:string,rules_secondary:string,expiration_time:string>>"
P_EVENT = "id string, title string, description string, active boolean, closed boolean, tags array<struct<label:string>>, markets array<struct<id:string,question:string,groupItemTitle:string,active:boolean,closed:boolean,outcomes:string,clobTokenIds:string,description:string,endDate:string>>"


def is_active(status: Column, active: Column, closed: Column) -> Column:
    """F1."""
    return (status == "active") & F.coalesce(active, F.lit(True)) & ~F.coalesce(closed, F.lit(False))


def normalize_date(c: Column) -> Column:
    """The wall clock of an ISO time, its offset dropped; other texts stay."""
    head = F.try_to_timestamp(F.replace(F.substring(c, 1, 19), F.lit("T"), F.lit(" ")), F.lit("yyyy-MM-dd HH:mm:ss"))
    return F.coalesce(F.date_format(head, "yyyy-MM-dd HH:mm:ss"), c)


def is_expired(c: Column, now: Column | None = None) -> Column:
    """P5: an unreadable date is not expired."""
    return F.coalesce(F.try_to_timestamp(normalize_date(c), F.lit("yyyy-MM-dd HH:mm:ss")) < (now if now is not None else F.current_timestamp()), F.lit(False))


def normalize_category(c: Column, known: dict[str, str]) -> Column:
    """The table's name for a category, else its title case, Other if empty."""
    key = F.lower(F.trim(F.coalesce(c, F.lit(""))))
    return F.when(key == "", F.lit("Other")).otherwise(F.coalesce(F.element_at(literal_map(known), key), title_case(F.trim(c))))


def k_rows(events: DataFrame) -> DataFrame:
    """Rows of K_EVENT frames: one per active market."""
    m = events.select("*", F.explode("markets").alias("m")).where("m.status = 'active'")
    title, event_title = safe_text(col("m.title")), safe_text(col("title"))
    parts = F.split(event_title, ": ", 2)
    head, tail = F.element_at(parts, 1), F.coalesce(F.try_element_at(parts, F.lit(2)), F.lit(""))
    yes, sub = safe_text(col("m.yes_sub_title")), safe_text(col("m.subtitle"))
    plain = F.lower(yes).isin("", "yes", "no")
    bet = F.when(~plain, yes).when((sub != "") & (sub != title), F.concat(title, F.lit(" ("), sub, F.lit(")"))).when(title == event_title, F.concat(title, F.lit(" (Yes)"))).otherwise(title)
    rules = F.array_join(F.filter(F.array(safe_text(col("m.rules_primary")), safe_text(col("m.rules_secondary"))), lambda r: r != ""), " ")
    return m.select(
        F.lit("K").alias("Platform"), col("event_ticker").alias("Event ID"), col("m.ticker").alias("Bet ID"), head.alias("Market Title"),
        F.when(tail != "", F.concat(tail, F.lit(" "), bet)).otherwise(bet).alias("Bet Title"), safe_text(col("category")).alias("Category"),
        F.coalesce(F.nullif(safe_text(col("sub_title")), F.lit("")), F.lit("N/A")).alias("Sub-Category"), col("series_ticker").alias("Series Ticker"),
        rules.alias("Description"), rules.alias("Bet_Rules"), F.lit("").alias("Event_Description"), col("m.status").alias("Status"), normalize_date(col("m.expiration_time")).alias("Expiration Date"), F.lit("").alias("SyncStatus"),
    )


def explode_outcomes(markets: DataFrame) -> DataFrame:
    """(market_id, question, outcomes, tokens as JSON or plain text) to one row per outcome.

    Unreadable JSON is a single outcome; none at all is one Yes row; a token that is missing becomes market_place.
    """
    listed = lambda c: F.coalesce(F.from_json(c, "array<string>"), F.when(F.trim(F.coalesce(c, F.lit(""))).isin("", "[]"), F.array().cast("array<string>")).otherwise(F.array(c)))
    rows = markets.withColumn("_o", listed(col("outcomes"))).withColumn("_t", listed(col("tokens")))
    rows = rows.withColumn("_o", F.when(F.size("_o") > 0, col("_o")).otherwise(F.array(F.lit("Yes"))))
    out = rows.select("*", F.posexplode("_o").alias("place", "outcome"))
    token = F.coalesce(F.nullif(F.try_element_at("_t", col("place") + 1), F.lit("")), F.concat_ws("_", "market_id", "place"))
    base = F.substring_index(safe_text(col("question")), "\n", 1)
    return out.withColumn("bet_id", token).withColumn("bet_title", F.concat(base, F.lit(" ["), "outcome", F.lit("]"))).drop("_o", "_t")


def p_rows(events: DataFrame) -> DataFrame:
    """Rows of P_EVENT frames: one per outcome of active, open events and markets."""
    live = events.where("active and not closed").select("*", F.explode("markets").alias("m")).where("m.active and not m.closed")
    base = F.coalesce(F.nullif(safe_text(col("m.groupItemTitle")), F.lit("")), safe_text(col("m.question")))
    flat = live.select(
        col("id").alias("event_id"), col("title").alias("event_title"), col("description"), F.array_join(F.transform("tags", lambda t: t["label"]), ", ").alias("tags"),
        col("m.id").alias("market_id"), base.alias("question"), col("m.outcomes").alias("outcomes"), col("m.clobTokenIds").alias("tokens"), col("m.description").alias("rules"), col("m.endDate").alias("end"),
    )
    out = explode_outcomes(flat)
    return out.select(
        F.lit("P").alias("Platform"), col("event_id").alias("Event ID"), col("bet_id").alias("Bet ID"), col("event_title").alias("Market Title"), col("bet_title").alias("Bet Title"),
        F.trim(F.substring_index("tags", ",", 1)).alias("Category"), col("tags").alias("Sub-Category"), col("rules").alias("Description"), col("rules").alias("Bet_Rules"),
        col("description").alias("Event_Description"), F.lit("active").alias("Status"), normalize_date(col("end")).alias("Expiration Date"), F.lit("").alias("SyncStatus"),
        col("outcomes").alias("Outcomes"), col("tokens").alias("Token_IDs"), col("market_id").alias("Original_Market_ID"), col("outcome").alias("Outcome_Name"),
    )


def series_tags(rows: DataFrame, lookup: Callable[[str], list[str]], ticker_col: str = "Series Ticker") -> DataFrame:
    """IO3: rows with the tags of their series, joined by commas; each distinct ticker is looked up once."""
    import pandas as pd

    tickers = rows.select(F.col(f"`{ticker_col}`").alias("_ticker")).where("_ticker <> ''").distinct()

    def run(parts):
        for pdf in parts:
            yield pd.DataFrame({"_ticker": pdf["_ticker"], "tags": [", ".join(lookup(t)) for t in pdf["_ticker"]]})

    found = tickers.mapInPandas(run, "_ticker string, tags string")
    return rows.join(found, F.col(f"`{ticker_col}`") == F.col("_ticker"), "left").drop("_ticker")


def to_index(rows: DataFrame, indexed: DataFrame) -> DataFrame:
    """ids of events that the index lacks or that have a row marked New."""
    seen = rows.groupBy("event_id").agg(F.bool_or(F.col("sync_status") == "New").alias("fresh"))
    have = indexed.select("event_id").withColumn("_have", F.lit(True))
    return seen.join(have, "event_id", "left").where("fresh or _have is null").select("event_id")


def event_index(rows: DataFrame) -> DataFrame:
    """Per event the title and category of its first row (ord), and its distinct bet titles."""
    first = F.min_by(F.struct("title", "category", "sub_category"), "ord").alias("first")
    titles = F.array_sort(F.collect_set(F.when(F.trim("bet_title") != "", F.trim("bet_title")))).alias("bet_titles")
    out = rows.groupBy("event_id").agg(first, titles)
    return out.select("event_id", "first.*", "bet_titles", F.size("bet_titles").cast("long").alias("bet_title_count"))


def rows_by_id(rows: DataFrame, key: str, order: str, *fields: str) -> DataFrame:
    """The display record of each id; the last row wins."""
    return rows.groupBy(key).agg(F.max_by(F.struct(*fields), order).alias("r")).select(key, "r.*")
