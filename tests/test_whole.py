"""Queries run over all their rows: each against plain Python on the smallest tables."""

from __future__ import annotations

import pandas as pd

from conftest import SF
from xmarket import catalogue
from xmarket.operators import candidates
from xmarket.plans import q_pairs
from xmarket.plans.q_pairs import index
from xmarket.plans.views import view


def test_blocking_uses_every_keyword(spark):
    words = {r.event_id: (r.platform, set(r.keywords)) for r in index(spark, SF).select("event_id", "platform", "keywords").collect()}
    ks, ps = ([(i, w) for i, (v, w) in words.items() if v == venue] for venue in "KP")
    want = {(k, p): "|".join(sorted(a & b)) for k, a in ks for p, b in ps if a & b}
    got = candidates.blocked_pairs(index(spark, SF)).collect()
    assert len(got) == len(want) and {(r.k_id, r.p_id): "|".join(r.common_keywords) for r in got} == want
    kept = candidates.build_pairs(index(spark, SF).drop("bet_titles"), {}).collect()
    assert kept and all("|".join(sorted(r.common_keywords)) == want[r.k_id, r.p_id] for r in kept)


def test_blocking_queries_use_every_listing(spark):
    words = {r.event_id: (r.platform, set(r.keywords)) for r in index(spark, SF, "v_listings").select("event_id", "platform", "keywords").collect()}
    assert len(words) == len(pd.read_parquet(f"{SF}/orders.parquet"))
    ks, ps = ([(i, w) for i, (v, w) in words.items() if v == venue] for venue in "KP")
    want = {(k, p): "|".join(sorted(a & b)) for k, a in ks for p, b in ps if a & b}
    got = catalogue.queries()["j1_blocked_pairs"](spark, SF).collect()
    assert want and {(r.k_id, r.p_id): r.common_keywords for r in got} == want and len(got) == len(want)
    kept = catalogue.queries()["j1_candidate_pairs"](spark, SF).collect()
    assert kept and all(r.common_keywords == want[r.k_id, r.p_id] for r in kept)


def test_edges_come_from_every_line(spark):
    lines = pd.read_parquet(f"{SF}/lineitem.parquet")
    want = set(lines[["l_suppkey", "l_partkey", "l_quantity"]].itertuples(index=False, name=None))
    got = [(r.k_id, r.p_id, r.quality) for r in view(spark, SF, "v_edges").collect()]
    assert len(got) == len(want) and set(got) == want
    used_k, used_p, scanned = set(), set(), set()
    for k, p, q in sorted(want, key=lambda e: (-e[2], e[0], e[1])):
        if k not in used_k and p not in used_p:
            used_k.add(k), used_p.add(p), scanned.add((k, p, q))
    assert {(r.k_id, r.p_id, r.quality) for r in catalogue.queries()["s8_greedy_exclusive"](spark, SF).collect()} == scanned


def test_matches_come_from_every_line(spark):
    lines = pd.read_parquet(f"{SF}/lineitem.parquet")
    want = set(lines[["l_orderkey", "l_partkey", "l_suppkey"]].itertuples(index=False, name=None))
    got = [(r.k_id, r.p_id, r.quality) for r in view(spark, SF, "v_matches").collect()]
    assert len(got) == len(want) and set(got) == want


def test_contract_pairs_equal_a_scan_of_every_line(spark):
    lines = pd.read_parquet(f"{SF}/lineitem.parquet")
    kept = lines[lines.l_returnflag != "R"]
    rows = set(zip(kept.l_suppkey, kept.l_linestatus, kept.l_partkey, kept.l_shipdate.dt.date, kept.l_quantity, strict=True))
    used, want = set(), set()
    for k, p, k_bet, p_bet, n in sorted(rows, key=lambda r: (-r[4], r[2], r[3], r[0], r[1])):
        ends = {("k", k, p, k_bet), ("p", k, p, p_bet)}
        if not ends & used:
            used |= ends
            want.add((k, p, k_bet, p_bet, n))
    got = catalogue.queries()["r26_contract_pairs"](spark, SF).collect()
    assert 0 < len(want) < len(rows) < len(lines) and len(got) == len(want)
    assert {(r.k_id, r.p_id, r.k_bet_id, r.p_bet_id, r.l_quantity) for r in got} == want


def test_pairs_of_an_account_are_ranked_and_pruned(spark):
    orders = pd.read_parquet(f"{SF}/orders.parquet")
    k, p = orders[orders.o_orderkey % 2 == 0], orders[orders.o_orderkey % 2 == 1]
    want = {(a, b) for a, b in k.merge(p, on="o_custkey")[["o_orderkey_x", "o_orderkey_y"]].itertuples(index=False, name=None)}
    scored = q_pairs._scored(spark, SF)
    rows = [r.asDict() for r in candidates.prune(scored).collect()]
    assert {(r["k_id"], r["p_id"]) for r in rows} == want and len(rows) == len(want)
    for side in "kp":
        per = {}
        for r in sorted(rows, key=lambda r: (-r["semantic_score"], -r["quality_score"], r["k_id"], r["p_id"])):
            per.setdefault(r[f"{side}_id"], []).append(r)
        assert max(map(len, per.values())) > 5
        assert all(r[f"{side}_rank"] == i + 1 and r[f"{side}_fanout"] == len(rs) for rs in per.values() for i, r in enumerate(rs))
    for r in rows:
        anchors, ov = r["primary_anchors"], r["ov"]
        identity = set(r["explicit_conflicts"]) & {"groups", "districts", "locations", "participants", "periods", "scopes"}
        kept = min(r["k_rank"], r["p_rank"]) <= 2 or ov >= 0.8 or "fixture" in anchors or "district" in anchors or ("entity" in anchors and ov >= 0.6)
        reason = (
            "explicit_identity_conflict" if identity
            else "weak_without_primary_anchor" if r["quality_tier"] == "weak" and not anchors and ov < 0.75
            else "high_frequency_only" if r["rarest_df"] and r["rarest_df"] > 100 and not anchors and ov < 0.75 and r["jac"] < 0.55
            else "" if kept else "outside_candidate_budget"
        )
        assert r["prune_reason"] == reason
    assert "outside_candidate_budget" in {r["prune_reason"] for r in rows}
