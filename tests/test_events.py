"""Titles, profiles and rules: restated cases."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from xmarket.functions import category, contracts, events, text, udf
from xmarket.functions.lexicon import Lexicon
from xmarket.operators import rules

LEX = Lexicon()


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def one(spark, fn, title):
    return value(spark, fn(F.lit(title)))


@pytest.mark.parametrize(("word", "canonical"), [("BTC", "bitcoin"), ("PSG", "paris saint-germain"), ("U.S.", "united states")])
def test_aliases(spark, word, canonical):
    assert value(spark, text.canonical_keyword(F.lit(word), LEX)) == canonical


@pytest.mark.parametrize("word", ["named", "win", "$", "ab"])
def test_noise(spark, word):
    assert value(spark, text.is_noise_keyword(F.lit(word), LEX))


def test_missing_labels(spark):
    for raw in (None, "NaN", "nan", "<NA>", ""):
        assert value(spark, text.label(F.lit(raw).cast("string"))) == "N/A"
    assert value(spark, category.k_key(F.lit("Politics"), F.lit("NaN"))) == "politics / n/a"
    assert {"sports", "basketball", "ncaa"} <= set(value(spark, category.terms(F.lit("Sports"), F.lit("Basketball, NCAA"))))


def test_groups_conflict_only_when_both_say(spark):
    assert one(spark, events.groups, "Winner of Group A") == ["a"]
    assert one(spark, events.groups, "Winner of the group stage") == []


def test_times(spark):
    assert one(spark, events.dates, "on March 3rd, 2026 or Apr 5") == ["2026-03-03", "????-04-05"]
    assert one(spark, events.periods, "Q2 2026 or May 2027") == ["2026-Q2", "2027-05"]
    assert one(spark, events.seasons, "2025-26 and 2024/2025") == ["2024-2025", "2025-2026"]


def test_districts_and_thresholds(spark):
    assert one(spark, events.districts, "wy-al and CA-12") == ["CA-12", "WY-AL"]
    assert one(spark, events.thresholds, "above 3.50% in 2026") == ["3.5:%"]


def test_fixture_in_either_order(spark):
    a, b = one(spark, events.participants, "Manchester City at Real Madrid"), one(spark, events.participants, "Real Madrid vs Manchester City - More Markets")
    assert a == b == ["manchester city", "real madrid"]


def test_fixture_profiles_share_the_occurrence_only(spark):
    rows = [("1", "K", "Manchester City at Real Madrid", "sports", "soccer", [], []), ("2", "P", "Real Madrid vs Manchester City - Exact Score", "sports", "soccer", [], [])]
    df = spark.createDataFrame(rows, "event_id string, platform string, title string, category string, sub_category string, keywords array<string>, bet_titles array<string>")
    a, b = sorted(events.profiles(df, LEX).collect(), key=lambda r: r.event_id)
    assert a.occurrence_key == b.occurrence_key and a.proposition_key != b.proposition_key


REJECTS = [
    ("How high will approval go?", "How low will approval go?", "direction_conflict"),
    ("Ethereum price on Mar 6", "Ethereum price on Mar 3", "date_scope_conflict"),
    ("Earthquake of magnitude 8.0 or above", "Earthquake of magnitude 9.0 or above", "numeric_threshold_conflict"),
    ("Israel and Syria normalize relations", "Israel and Saudi Arabia normalize relations", "location_conflict"),
    ("WV-02 house primary", "WV-01 house primary", "location_conflict"),
    ("Valorant map 3 winner", "Valorant season winner", "scope_granularity_conflict"),
]


@pytest.mark.parametrize(("k", "p", "reason"), REJECTS)
def test_hard_rejects(spark, k, p, reason):
    schema = "event_id string, platform string, title string, category string, sub_category string, keywords array<string>"
    feats = rules.pair_features(spark.createDataFrame([("1", "K", k, "x", "y", ["a"]), ("2", "P", p, "x", "y", ["a"])], schema))
    pair = rules.side(feats.where("platform = 'K'"), "k").crossJoin(rules.side(feats.where("platform = 'P'"), "p"))
    pair = rules.with_evidence(pair.withColumn("common_keywords", F.array(F.lit("alpha"), F.lit("beta"))))
    assert pair.select(rules.hard_reject_reason().alias("r")).first().r == reason


def profile_pair(spark, k, p):
    rows = [("1", "K", k, "economics", "fed", [], []), ("2", "P", p, "economics", "fed", [], [])]
    df = events.profiles(spark.createDataFrame(rows, "event_id string, platform string, title string, category string, sub_category string, keywords array<string>, bet_titles array<string>"), LEX)
    pair = rules.side(df.where("platform = 'K'"), "k").crossJoin(rules.side(df.where("platform = 'P'"), "p"))
    return pair.select(rules.explicit_conflicts().alias("c"), rules.one_sided_fields().alias("o")).first()


def test_december_meeting_is_year_end(spark):
    assert "scopes" in profile_pair(spark, "Fed decision in April meeting", "Fed rate at the end of 2026").c
    assert "scopes" not in profile_pair(spark, "Fed decision in December meeting", "Fed rate at the end of 2026").c


def test_group_conflict_and_one_sided(spark):
    assert "groups" in profile_pair(spark, "Group A winner", "Group B winner").c
    r = profile_pair(spark, "Group A winner", "Overall winner")
    assert "groups" not in r.c and "groups" in r.o


CASES = [
    ("Basketball / NBA", {"Basketball / NBA": ["basketball", "nba"]}, ["basketball", "nba", "sports"], "exact_specific", ["basketball", "nba"]),
    ("Crypto / N/A", {"Crypto / N/A": ["crypto", "crypto prices"]}, ["crypto", "crypto prices"], "exact_broad", ["crypto", "crypto prices"]),
    ("Sports / Cricket", {"Sports / N/A": ["sports"]}, ["sports"], "broad_fallback", ["sports"]),
    ("Sports / Rugby", {}, ["rugby", "sports"], "inferred_specific", ["rugby"]),
    ("Nothing / None", {}, ["sports"], "unmapped", []),
]


@pytest.mark.parametrize(("key", "mapping", "available", "mode", "keys"), CASES)
def test_category_modes(spark, key, mapping, available, mode, keys):
    r = category.resolve(spark.createDataFrame([(key,)], "k_key string"), mapping, available).first()
    assert r.mode == mode and r["keys"] == keys


def test_contract_texts(spark):
    assert one(spark, contracts.parse_month_day_year, "Sept. 5th, 2026") == "2026-09-05"
    assert one(spark, contracts.parse_month_day_year, "soon") is None
    assert value(spark, contracts.is_numeric_bucket(F.lit("3.5% - 4%"))) and not value(spark, contracts.is_numeric_bucket(F.lit("Anna")))
    got = value(spark, contracts.relevant_sentences(F.lit("Sunny day. It resolves by May 3. Other words here."), F.array(F.lit("resolves")), 30))
    assert got == "It resolves by May 3."
    assert [(x.number, x.yes) for x in value(spark, contracts.parsed_answers(F.lit("1. yes\n2) No\nx")))] == [(1, True), (2, False)]


def test_python_functions(spark):
    df = spark.createDataFrame([("Bodø vs Qarabağ", ["The ceremony is held on March 15, 2026.", "If not known by June 30, 2026 resolves to Other."])], "t string, x array<string>")
    r = df.select(udf.ascii_fold(F.col("t")).alias("f"), udf.ro_similarity(F.col("t"), F.col("t")).alias("s"), udf.extract_deadline(F.col("x")).alias("d")).first()
    assert r.f == "Bod vs Qarabag" and r.s == 1.0 and r.d == "2026-03-15"


def test_title_case(spark):
    assert value(spark, text.title_case(F.lit("u.s. politics-now o'hare"))) == "U.S. Politics-Now O'Hare"
