"""Pair queries on groups of rows that are alike: results of a plain loop, and work that doesn't grow with their product."""

from __future__ import annotations

import hashlib
import random
import time

from pyspark.sql import functions as F

from xmarket.operators import outcomes

TITLES = ["Will France win the 2026 World Cup?", "Will France win Group B by March 5, 2026?", "Who will be the winner of the 2026 World Cup?", "2026 World Cup: golden boot winner", "France vs Spain"]


def _profiles(spark, venue: str, n: int, names: int):
    rows = [(f"{venue}{i % 3}", f"{venue}{i:05d}", TITLES[i * 7 % len(TITLES)], f"Team {i % names}", "Sports", "Soccer", "Yes", "Settled by December 31, 2026.") for i in range(n)]
    names = ["Event ID", "Bet ID", "Market Title", "Bet Title", "Category", "Sub-Category", "Outcome_Name", "Bet_Rules"]
    return outcomes.outcome_profiles(spark.createDataFrame(rows, names), venue)


def _plainly(k, p, per_bet: int) -> set:
    """Each pair of bets on its own."""
    from xmarket.functions import category
    from xmarket.operators import rules

    side = lambda df, s: rules.side(rules.pair_features(df.withColumn("title", F.col("market_title"))), s).withColumn("outcome_key", F.col(f"{s}_outcome_key"))
    pairs = side(k, "k").join(side(p, "p"), "outcome_key").where("k_event_subject_count > 1 or p_event_subject_count > 1")
    shared, scopes = F.array_intersect("k_market_keywords", "p_market_keywords"), F.array_intersect("k_scope_terms", "p_scope_terms")
    conflicts = rules.granularity_conflict() | rules.location_conflict() | rules.sports_conflict() | ~category.categories_overlap(F.col("k_terms"), F.col("p_terms")) | outcomes.scope_conflict("k", "p")
    kept = pairs.where(outcomes.intent_compatible(shared, scopes, conflicts))
    score = outcomes.pair_score(shared, outcomes.tokens(F.col("outcome_key")), F.lit(True), scopes, F.lit(True))
    per = {}
    for r in kept.select("k_bet_id", "p_bet_id", "outcome_key", score.alias("score"), F.array_join(F.array_sort(shared), "|").alias("words")).collect():
        per.setdefault(r[0], []).append((-r[3], r[1], r[2], r[4]))
    return {(k_bet, *x) for k_bet, found in per.items() for x in sorted(found)[:per_bet]}


def test_outcome_candidates_equal_all_pairs_and_group_bets(spark):
    k, p = _profiles(spark, "K", 60, 4), _profiles(spark, "P", 60, 4)
    got = outcomes.outcome_candidates(k, p, 3).collect()
    assert got and {(r.k_bet, -r.match_score, r.p_bet, r.outcome_key, "|".join(r.shared_market_keywords)) for r in got} == _plainly(k, p, 3)
    k, p = _profiles(spark, "K", 6000, 2), _profiles(spark, "P", 6000, 2)
    began = time.time()
    got = outcomes.outcome_candidates(k, p).collect()
    assert time.time() - began < 60  # 18 million pairs of bets, each with some hundred tests
    per = {}
    for r in got:
        per.setdefault(r.k_bet, set()).add(r.p_bet)
    assert len(per) > 1000 and all(len(v) == 5 for v in per.values()) and len(got) == 5 * len(per)


def test_outcome_patterns_run_once_a_text_and_keys_are_divided(spark, monkeypatch):
    seen, scopes = [], outcomes.with_scope_terms
    monkeypatch.setattr(outcomes, "with_scope_terms", lambda df, *a, **b: (seen.append(df.count()), scopes(df, *a, **b))[1])
    k, p = _profiles(spark, "K", 60, 4), _profiles(spark, "P", 60, 4)
    assert len(seen) == 2 and max(seen) <= len(TITLES)  # not 60 rows
    monkeypatch.setattr(outcomes, "PAIRS_A_TASK", 3)
    got = outcomes.outcome_candidates(k, p, 3).collect()
    assert got and {(r.k_bet, -r.match_score, r.p_bet, r.outcome_key, "|".join(r.shared_market_keywords)) for r in got} == _plainly(k, p, 3)


def test_matching_needs_memory_for_edges_only(spark):
    import tracemalloc

    import numpy as np

    from xmarket.operators import matching

    n = 20_000  # a table of both sides would be 3.2 GB
    own = np.arange(n) % 4 + 1
    left, right, weight = np.tile(np.arange(n), 2), np.concatenate((np.zeros(n, int), np.arange(1, n + 1))), np.concatenate((np.full(n, 5.0), own.astype(float)))
    tracemalloc.start()
    chosen = matching.best_edges(left, right, weight)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(set(left[chosen])) == len(set(right[chosen])) == len(chosen) == n and weight[chosen].sum() == own.sum() + 4
    assert peak < 20e6
    rows = list(zip(left[:3000:10].tolist(), right[:3000:10].tolist(), weight[:3000:10].tolist(), strict=True)) + [(i, i + 1, float(i % 4 + 1)) for i in range(0, 3000, 10)]
    got = matching.maximum_weight_matching(spark.createDataFrame(rows + rows[:50], "k_id long, p_id long, weight double")).collect()
    assert len({r.k_id for r in got}) == len({r.p_id for r in got}) == len(got) == 300 and sum(r.weight for r in got) == sum(i % 4 + 1 for i in range(0, 3000, 10)) + 4


def test_components_are_found_between_packets_of_edges(spark, monkeypatch):
    import numpy as np

    from xmarket.operators import matching

    rng = np.random.default_rng(3)
    rows = [(int(part * 20 + rng.integers(20)), int(part * 50 + rng.integers(50)), float(rng.integers(-2, 30))) for part in range(4) for _ in range(900)] + [(1000 + i, 1000 + i, 1.0) for i in range(5)]
    w = np.zeros((1005, 1005))
    for k, p, x in rows:
        w[k, p] = max(w[k, p], x)
    best = sum(w[a, b] for a, b in matching.best_assignment(w))
    df = spark.createDataFrame(rows, "k_id long, p_id long, weight double")
    sizes, components = [], matching.connected_components
    monkeypatch.setattr(matching, "connected_components", lambda edges, *a: (sizes.append(edges.count()), components(edges, *a))[1])
    for forest in (getattr(matching, "FOREST_EDGES", 0), 50):
        monkeypatch.setattr(matching, "FOREST_EDGES", forest, raising=False)
        got = matching.maximum_weight_matching(df).collect()
        assert len({r.k_id for r in got}) == len({r.p_id for r in got}) == len(got)
        assert sum(r.weight for r in got) == best and all(w[int(r.k_id), int(r.p_id)] == r.weight for r in got)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sizes and sizes[-1] <= 85 * tasks  # K nodes of a task, not some 2,000 edges
    none = spark.createDataFrame([(None, 1, 99.0), (1, None, 99.0), (2, 3, 4.0)], df.schema)  # without an end a row is no edge
    assert [tuple(r) for r in matching.maximum_weight_matching(none).collect()] == [("2", "3", 4.0)]


def test_matching_of_random_graphs_equals_brute_force():
    import itertools

    import numpy as np

    from xmarket.operators import matching

    rng = np.random.default_rng(7)
    for _ in range(200):
        n, m = rng.integers(1, 6, 2)
        w = np.where(rng.random((n, m)) < rng.random(), rng.random((n, m)) * 9, 0)
        square = np.zeros((6, 6))
        square[:n, :m] = w
        best = max(sum(square[i, p[i]] for i in range(6)) for p in itertools.permutations(range(6)))
        assert abs(sum(w[a, b] for a, b in matching.best_assignment(w)) - best) < 1e-9


def test_nearest_outcomes_equal_a_scan(spark):
    rng = random.Random(5)
    ks = [(i // 2, f"o{rng.randint(0, 2)}", rng.randint(1, 40)) for i in range(120)] + [(900, "o1", None), (901, None, 3)]
    ps = [(rng.randint(0, 150), f"o{rng.randint(0, 2)}", rng.randint(1, 40)) for _ in range(200)] + [(151, "o1", None)]
    want = []
    for bet in {k[0] for k in ks}:
        found = sorted((abs(s - t), p) for b, o, s in ks for p, q, t in ps if b == bet and o == q and o and s is not None and t is not None and abs(s - t) <= 3)
        want += [(bet, p, gap, i + 1) for i, (gap, p) in enumerate(found[:4])]
    k, p = spark.createDataFrame(ks, "k_bet long, outcome_key string, ks int"), spark.createDataFrame(ps, "p_bet long, outcome_key string, ps int")
    got = outcomes.nearest_outcomes(k, p, 3, 4)
    assert got.dtypes == [("k_bet", "bigint"), ("p_bet", "bigint"), ("gap", "int"), ("rn", "int")]
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)


def _parts(path, n: int) -> str:
    """n parts of one type, size and two brands: every K bet joins every P bet."""
    import pandas as pd

    pd.DataFrame({"p_partkey": range(n), "p_name": "x", "p_brand": [f"Brand#{i // 2 % 2}" for i in range(n)], "p_type": "TIN", "p_size": 7, "p_retailprice": 1.0}).astype({"p_size": "int32"}).to_parquet(path / "part.parquet")
    return str(path)


def test_best_five_of_a_hot_key(spark, tmp_path):
    from xmarket import catalogue

    n, began = 60_000, time.time()
    got = catalogue.queries()["j3_w2_outcome_join"](spark, _parts(tmp_path, n)).collect()
    assert time.time() - began < 40  # 900 million pairs
    assert len(got) == 5 * n // 2 and all((r.p_bet, r.gap) == (2 * r.rn - 1, 0) for r in got)


def test_joined_bundles_equal_a_scan(spark):
    rng = random.Random(6)
    ks = [(f"E{rng.randint(0, 3)}", rng.randint(0, 60), f"o{rng.randint(0, 2)}") for _ in range(90)]  # some bets stand there twice
    ps = [(f"F{rng.randint(0, 3)}", rng.randint(0, 60), f"o{rng.randint(0, 2)}") for _ in range(90)]
    members = {}
    for e, a, o in ks:
        for f, b, q in ps:
            if o == q:
                members.setdefault((e, f), []).append((a, b))
    k, p = spark.createDataFrame(ks, "k_event string, k_bet int, on string"), spark.createDataFrame(ps, "p_event string, p_bet int, on string")
    got = outcomes.joined_bundles(k, p, ["on"], "bet").collect()
    assert {(r.k_event, r.p_event): (r.n, r.first_k, r.members) for r in got} == {x: (len(m), min(m)[0], ",".join(str(b) for _, b in sorted(m))) for x, m in members.items()}
    pairs = k.join(p, "on").withColumn("candidate_type", F.lit("bet"))
    want = outcomes.bundles(pairs, ["k_bet", "p_bet"]).collect()
    assert {(r.bundle_id, r.k_event, r.p_event, r.n) for r in got} == {(r.bundle_id, r.k_event, r.p_event, r["size"]) for r in want} and len(got) == len(want)


def test_bundles_of_a_hot_key(spark, tmp_path):
    from xmarket import catalogue

    n, began = 16_000, time.time()
    out = catalogue.queries()["g7_bundles"](spark, _parts(tmp_path, n))
    got = out.select("k_event", "p_event", "n", "first_k", F.sha2("members", 256).alias("h"), F.length("members").alias("size")).collect()
    assert time.time() - began < 30  # 64 million pairs
    per = n // 4
    assert len(got) == 4 and all(r.n == per * per for r in got)
    for r in got:
        text = ",".join(str(i) for i in range(1, n, 2) if f"Brand#{i // 2 % 2}" == r.p_event)
        assert r["size"] == per * (len(text) + 1) - 1 and r.h == hashlib.sha256(",".join([text] * per).encode()).hexdigest()
