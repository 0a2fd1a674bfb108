"""Sources, file readers and the live stream."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from xmarket.sources import files, markets
from xmarket.streaming import books


def test_retrying_get():
    calls, pauses = [], []

    def opener(url):
        calls.append(url)
        if len(calls) < 3:
            raise OSError("down")
        return '{"ok": 1}'

    assert markets.get_json("http://x/y", {"a": 1}, opener, pause=pauses.append) == {"ok": 1}
    assert pauses == [0.5, 1.0] and calls[0] == "http://x/y?a=1"
    assert markets.get_json("http://x", {}, lambda u: 1 / 0, pause=pauses.append) is None


def test_pages_end_on_a_repeated_cursor():
    answers = iter([{"events": [1], "cursor": "a"}, {"events": [2], "cursor": "b"}, {"events": [3], "cursor": "a"}, {"events": [4]}])
    assert list(markets.cursor_pages("u", 200, {}, "events", "cursor", lambda u, p: next(answers))) == [1, 2, 3]


def test_k_and_p_rows(spark):
    k = {"event_ticker": "E", "series_ticker": "S", "title": "Race: 2026", "category": "Politics", "sub_title": "", "markets": [
        {"ticker": "E-1", "status": "active", "title": "Who wins?", "yes_sub_title": "Anna", "rules_primary": "r", "expiration_time": "2026-03-01T10:00:00Z"}, {"ticker": "E-2", "status": "closed", "title": "x"}]}
    rows = markets.k_rows(spark.createDataFrame([(json.dumps(k),)], "v string").select(F.from_json("v", markets.K_EVENT).alias("e")).select("e.*")).collect()
    assert [(r["Bet ID"], r["Market Title"], r["Bet Title"], r["Expiration Date"]) for r in rows] == [("E-1", "Race", "2026 Anna", "2026-03-01 10:00:00")]
    p = {"id": "1", "title": "T", "description": "d", "active": True, "closed": False, "tags": [{"label": "Sports"}], "markets": [
        {"id": "m", "question": "Q?", "active": True, "closed": False, "outcomes": '["Yes", "No"]', "clobTokenIds": '["t1", "t2"]', "endDate": "2026-01-01"}]}
    rows = markets.p_rows(spark.createDataFrame([(json.dumps(p),)] * 2, "v string").select(F.from_json("v", markets.P_EVENT).alias("e")).select("e.*")).collect()
    assert len(rows) == 4 and {r["Bet ID"] for r in rows} == {"t1", "t2"} and rows[0]["Category"] == "Sports"


def test_guarded_files(spark, tmp_path):
    assert files.load_snapshot(spark, str(tmp_path / "no.csv"), ["Bet ID", "x"]).count() == 0
    (tmp_path / "lfs.csv").write_text("version https://git-lfs.github.com/spec/v1\noid 1\n")
    assert files.load_snapshot(spark, str(tmp_path / "lfs.csv"), ["Bet ID"]).count() == 0
    (tmp_path / "a.csv").write_text('Bet ID,t\n1,"two\nlines"\n')
    r = files.load_snapshot(spark, str(tmp_path / "a.csv"), ["Platform", "Bet ID"]).first()
    assert (r.Platform, r["Bet ID"], r.t) == ("", "1", "two\nlines")
    (tmp_path / "l.jsonl").write_text('{"a": 1}\nnot json\n{"a": 2}\n')
    assert sorted(r.a for r in files.read_json_lines(spark, str(tmp_path / "l.jsonl"), "a int").collect()) == [1, 2]
    with pytest.raises(FileNotFoundError):
        files.read_json_list(spark, str(tmp_path / "none.json"), "a int", required=True)
    got = spark.range(1).select(files.parse_token_list(F.lit("['YEAR:2026', \"PERSON:o'neil\"]")).alias("v"), files.parse_token_list(F.lit("broken")).alias("w")).first()
    assert got.v == ["YEAR:2026", "PERSON:o'neil"] and got.w == []


def test_requests_are_of_one_model(spark, tmp_path):
    df = spark.createDataFrame([("a", "m1"), ("b", "m1")], "id string, model string")
    assert files.write_requests(df, str(tmp_path / "r")) == 2
    with pytest.raises(ValueError, match="one model"):
        files.write_requests(df.union(spark.createDataFrame([("c", "m2")], df.schema)), str(tmp_path / "r"))
    assert files.purge(spark, [str(tmp_path / "r"), str(tmp_path / "q")]) == [str(tmp_path / "r")]


def k_message(kind, seq, **msg):
    return json.dumps({"type": kind, "seq": seq, "msg": {"market_ticker": "k1", **msg}})


def k_frame(spark, *messages):
    return spark.createDataFrame([(m,) for m in messages], "v string").select(F.from_json("v", books.K_MESSAGE).alias("m")).select("m.*")


def replay(updates):
    out = {}
    for r in sorted(updates.collect(), key=lambda r: (r.seq, r.kind != "clear")):
        out.setdefault(r.ticker, books.Book()).apply(r.kind, r.side, r.tick, r["size"])
    return out


def test_k_snapshot_and_deltas(spark):
    snap = k_message("orderbook_snapshot", 1, yes_dollars_fp=[["0.1234", "2.5"], ["0.1200", "3"]], no_dollars_fp=[["0.8765", "4.25"]])
    book = replay(books.k_updates(k_frame(spark, snap)))["k1"]
    assert book.side("bid") == [(0.1234, 2.5), (0.12, 3.0)] and book.side("ask") == [(0.1235, 4.25)]
    deltas = [("yes", "0.1240", "1.25"), ("no", "0.8750", "2"), ("no", "0.8765", "-4.25"), ("yes", "0.1240", "-1.25")]
    messages = [k_message("orderbook_delta", i, side=s, price_dollars=p, delta_fp=d) for i, (s, p, d) in enumerate(deltas, 2)]
    assert replay(books.k_updates(k_frame(spark, snap, *messages[:1])))["k1"].side("bid")[0] == (0.124, 1.25)
    book = replay(books.k_updates(k_frame(spark, snap, *messages)))["k1"]
    assert book.side("bid")[0][0] == 0.1234 and book.side("ask") == [(0.125, 2.0)]


def test_p_book_and_changes(spark):
    def p(**x):
        return json.dumps(x)

    rows = [
        p(event_type="book", seq=1, asset_id="p1", bids=[{"price": ".48", "size": "30"}], asks=[{"price": ".52", "size": "25"}]),
        p(event_type="price_change", seq=2, price_changes=[{"asset_id": "p1", "price": ".49", "size": "12", "side": "BUY"}]),
        p(event_type="price_change", seq=3, price_changes=[{"asset_id": "p1", "price": ".49", "size": "0", "side": "BUY"}]),
    ]
    frame = lambda n: spark.createDataFrame([(r,) for r in rows[:n]], "v string").select(F.from_json("v", books.P_MESSAGE).alias("m")).select("m.*")
    assert replay(books.p_updates(frame(2)))["p1"].side("bid") == [(0.49, 12.0), (0.48, 30.0)]
    assert replay(books.p_updates(frame(3)))["p1"].side("bid") == [(0.48, 30.0)]


def test_live_stream_equals_batch(spark, tmp_path):
    now = dt.datetime(2026, 1, 1)
    rows = [("K", "k1", "put", "ask", 4000, 10.0, None, None, 1, now), ("K", "k1", "put", "bid", 3900, 10.0, None, None, 2, now), ("P", "p1", "put", "ask", 6100, 8.0, None, None, 3, now), ("P", "p1", "put", "bid", 6000, 8.0, None, None, 4, now)]
    spark.createDataFrame(rows, books.UPDATE).coalesce(1).write.parquet(str(tmp_path / "in"))
    mapping = spark.createDataFrame([("pair", "k1", "p1", "Same")], "pair_id string, k_ticker string, p_ticker string, mapping string")
    stream = spark.readStream.schema(books.UPDATE).parquet(str(tmp_path / "in"))
    scanner = books.Scanner(stream, mapping, str(tmp_path / "cp"), str(tmp_path / "out")).start(available_now=True)
    scanner.query.awaitTermination(120)
    r = scanner.current().first()
    want = books.evaluate(books.Book({("ask", 4000): 10.0, ("bid", 3900): 10.0}), books.Book({("ask", 6100): 8.0, ("bid", 6000): 8.0}))
    assert r.pair_id == "pair" and r.buy_venue == "K" and r.profit == pytest.approx(want["profit"])
    assert scanner.status()["running"] is False
