"""The engine end to end on a small snapshot."""

from __future__ import annotations

import json

import pytest

from xmarket.__main__ import main
from xmarket.plans.engine import Engine, Settings

ROWS = [
    ("K", "k1", "Will Brazil win Group A in 2026?", "Sports", "Soccer", "Brazil", 1), ("P", "p1", "Brazil to win Group A 2026", "Sports", "Soccer", "Brazil", 2),
    ("K", "k2", "Will Germany win Group B in 2026?", "Sports", "Soccer", "Germany", 3), ("P", "p2", "Germany to win Group B 2026", "Sports", "Soccer", "Germany", 4),
    ("K", "k3", "Bitcoin above 100000 by December 31, 2026?", "Crypto", "Bitcoin", "Yes", 5), ("P", "p3", "Will Bitcoin be above 100000 by December 31, 2026?", "Crypto", "Bitcoin", "Yes", 6),
]


def test_refresh(spark):
    def answer(pdf):  # local, so that it travels to the workers by value
        say = lambda i: json.dumps({"decisions": [{"id": i, "d": "M", "r": "I", "c": 0.9, "x": [], "m": [], "e": ["same"], "q": 1}]})
        return pdf["pair_id"].map(say)

    rows = spark.createDataFrame(ROWS, "platform string, event_id string, title string, category string, sub_category string, bet_title string, ord int")
    none = spark.createDataFrame([], "k_id string, p_id string")
    cache = spark.createDataFrame([], "pair_id string, status string")
    out = Engine(spark).refresh(rows, none, cache, answer)
    matches = {(r.k_id, r.p_id) for r in out["matches"].collect()}
    assert {("k1", "p1"), ("k2", "p2"), ("k3", "p3")} == matches
    assert out["report"]["pairs"] >= 3 and out["report"]["kept"] >= 3
    dry = Engine(spark, Settings(budget_rows=1)).refresh(rows, none, cache, answer, apply=False)
    assert dry["todo"].count() == 1 and "matches" not in dry


def test_lifecycle_without_a_start(spark):
    engine = Engine(spark)
    assert engine.health()["status"] == "ok" and engine.status()["running"] is False
    with pytest.raises(RuntimeError, match="never started"):
        engine.opportunities()


def test_list_command(capsys):
    assert main(["list"]) == 0 and "s11_opportunities" in capsys.readouterr().out
