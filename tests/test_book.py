"""Books: restated cases, and properties against plain loops."""

from __future__ import annotations

import random

import pytest

from xmarket.operators import book
from xmarket.streaming.books import Book, evaluate, walk


def frame(spark, rows):
    return spark.createDataFrame(rows, "pair_id string, venue string, side string, price double, size double")


def test_one_level_each_without_fee(spark):
    books = frame(spark, [("a", "P", "ask", 0.40, 100.0), ("a", "Q", "bid", 0.60, 100.0)]).replace("Q", "K")
    r = book.depth_walk(books, "pair_id").where("buy_venue = 'P'").first()
    fee = 0.07 * 0.4 * 0.6
    assert r.volume == 100 and r.buy_investment == pytest.approx(40) and r.sell_investment == pytest.approx(40 + 100 * fee)
    assert r.profit == pytest.approx(20 - 100 * fee) and r.spread == pytest.approx(0.5)


def test_no_overlap_has_zero_volume_and_a_spread(spark):
    books = frame(spark, [("a", "P", "ask", 0.70, 5.0), ("a", "K", "bid", 0.60, 5.0)])
    r = book.depth_walk(books, "pair_id").first()
    assert r.volume == 0 and r.roi == 0 and r.spread == pytest.approx((0.6 - 0.7) / 0.7)


def test_walk_equals_a_loop_on_random_books(spark):
    rng = random.Random(5)
    rows, want = [], {}
    for n in range(60):
        sides = {}
        for venue in "KP":
            for side in ("ask", "bid"):
                ticks = rng.sample(range(3000, 7000), rng.randint(1, 6))
                sides[venue, side] = sorted(((t / 10000, float(rng.randint(1, 50))) for t in ticks), reverse=side == "bid")
                rows += [(str(n), venue, side, p, s) for p, s in sides[venue, side]]
        want[str(n), "K"] = walk(sides["K", "ask"], sides["P", "bid"], True, False)
        want[str(n), "P"] = walk(sides["P", "ask"], sides["K", "bid"], False, True)
    for r in book.depth_walk(frame(spark, rows), "pair_id").collect():
        w = want[r.pair_id, r.buy_venue]
        assert (r.volume, r.profit, r.fees) == pytest.approx((w["volume"], w["profit"], w["fees"]))


def test_delta_replay_equals_a_fold(spark):
    rng = random.Random(1)
    rows = [(rng.randint(0, 3), n, float(rng.randint(-5, 5))) for n in range(400)]
    want, state = {}, {}
    for level, n, d in rows:
        state[level] = max(0.0, state.get(level, 0.0) + d)
        want[n] = state[level]
    got = book.replay_deltas(spark.createDataFrame(rows, "level int, seq int, delta double"), "level").collect()
    assert {r.seq: float(r.size) for r in got} == want


def test_opposite_book(spark):
    r = book.opposite(frame(spark, [("a", "P", "bid", 0.4, 3.0)])).first()
    assert (r.side, r.price) == ("ask", 0.6)


def test_evaluate_needs_four_sides():
    k, p = Book({("ask", 4000): 5.0, ("bid", 3900): 5.0}), Book({("ask", 6100): 5.0})
    assert evaluate(k, p) is None
    p.apply("put", "bid", 6000, 5.0)
    assert evaluate(k, p)["buy_venue"] == "K"
