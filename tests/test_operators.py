"""Selection, matching, components, snapshots, decisions and batching against plain Python."""

from __future__ import annotations

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from xmarket.operators import candidates, decisions, matching, metrics, sync
from xmarket.operators.graph import connected_components


def test_components_equal_union_find(spark):
    rng = random.Random(2)
    edges = [(rng.randint(0, 80), rng.randint(0, 80)) for _ in range(70)] + [(100 + i, 101 + i) for i in range(40)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {x: find(x) for x in parent}
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_greedy_equals_a_scan(spark):
    rng = random.Random(3)
    rows = list({(rng.randint(0, 12), rng.randint(0, 12)): None for _ in range(60)})
    rows = [(k, p, rng.randint(0, 4)) for k, p in rows]
    used_k, used_p, want = set(), set(), set()
    for k, p, _ in sorted(rows, key=lambda r: (-r[2], r[0], r[1])):
        if k not in used_k and p not in used_p:
            used_k.add(k), used_p.add(p), want.add((k, p))
    got = candidates.greedy_exclusive(spark.createDataFrame(rows, "k_id int, p_id int, q int"), [F.desc("q"), F.asc("k_id"), F.asc("p_id")])
    assert {(r.k_id, r.p_id) for r in got.collect()} == want


def test_assignment_equals_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(60):
        n, m = rng.integers(1, 6, 2)
        w = np.where(rng.random((n, m)) < 0.5, rng.integers(1, 20, (n, m)), 0).astype(float)
        got = matching.best_assignment(w)
        assert len({a for a, _ in got}) == len(got) == len({b for _, b in got})
        size = max(n, m)
        square = np.zeros((size, size))
        square[:n, :m] = w
        best = max(sum(square[i, p[i]] for i in range(size)) for p in itertools.permutations(range(size)))
        assert sum(w[a, b] for a, b in got) == pytest.approx(best)


def test_global_optimum_beats_greedy(spark):
    rows = [("K1", "P1", 0.90), ("K1", "P2", 0.80), ("K2", "P1", 0.70)]
    got = matching.maximum_weight_matching(spark.createDataFrame(rows, "k_id string, p_id string, weight double"))
    assert {(r.k_id, r.p_id) for r in got.collect()} == {("K1", "P2"), ("K2", "P1")}


def test_snapshot_keeps_new(spark):
    old = spark.createDataFrame([("B1", "New"), ("B2", "New")], "bet_id string, sync_status string")
    new = spark.createDataFrame([("B1",), ("B3",)], "bet_id string")
    assert {r.bet_id: r.sync_status for r in sync.snapshot_diff(old, new).collect()} == {"B1": "New", "B3": "New"}
    assert tuple(sync.diff_counts(old, new).first()) == (1, 1, 1)
    with pytest.raises(ValueError, match="shrank"):
        sync.shrink_guard(2000, 900)
    with pytest.raises(ValueError, match="venue"):
        sync.schema_of("X")


def test_cleanup_of_a_bad_pair(spark):
    events = spark.createDataFrame([("k1", "p1"), ("k2", "p2")], "k_id string, p_id string")
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "id string")
    bad = spark.createDataFrame([("k2", "p2")], "k_id string, p_id string")
    kept, bets = sync.active_matches(events, events, ids("k1", "k2"), ids("p1", "p2"), bad)
    assert [tuple(r) for r in kept.collect()] == [("k1", "p1")] == [tuple(r) for r in bets.collect()]


def test_batches_equal_a_loop(spark):
    rng = random.Random(4)
    rows = [(f"p{i:03d}", rng.randint(1, 30)) for i in range(90)]
    got = {r.id: r.batch for r in decisions.batches(spark.createDataFrame(rows, "pair_id string, chars int"), 5, 60).collect()}
    number = items = chars = 0
    for name, size in sorted(rows, key=lambda r: (r[1], r[0])):
        if items and (items + 1 > 5 or chars + size > 60):
            number, items, chars = number + 1, 0, 0
        items, chars = items + 1, chars + size
        assert got[name] == number


def test_scorer_runs_for_cache_misses_only(spark):
    env = spark.createDataFrame([("a", 1), ("b", 2)], "pair_id string, n int")
    cache = spark.createDataFrame([("a", "valid")], "pair_id string, status string")
    out = decisions.verify_missing(env, cache, ["pair_id"], lambda pdf: pdf["pair_id"] + "!")
    assert [r.answer for r in out.collect()] == ["b!"]
    with pytest.raises(RuntimeError, match="budget"):
        decisions.verify_missing(env, cache, ["pair_id"], lambda pdf: pdf["pair_id"], budget=0.1, cost_per_row=1.0)


def test_quality_floor_and_projection(spark):
    with pytest.raises(ValueError, match="tier"):
        metrics.meets_quality(F.lit("weak"), "best")
    assert metrics.project_cost(1.0, 100, 1000)["incremental"] == pytest.approx(0.5)


def test_sequential_ids_follow_the_order(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"))
    got = sync.sequential_ids(df, [F.asc("v")])
    assert all(r.cluster_id == r.v + 1 for r in got.collect())
