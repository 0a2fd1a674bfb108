"""Rules on pairs (R1 to R18): each is a Column over a row that holds both events' precomputed features.

Features of the K event have the prefix k_, those of the P event p_ (see pair_features()).  No extractor runs on
pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from xmarket.functions import category, events
from xmarket.functions import lexicon as lx
from xmarket.functions.text import disjoint, evidence_key, has_term, is_distinctive, jaccard, overlap, overlaps, strings, title_tokens

col = F.col


def pair_features(df: DataFrame) -> DataFrame:
    """Per event, once: what the rules look at."""
    title = F.coalesce(col("title"), F.lit(""))
    is_match, is_event = events.granularity(col("event_id").cast("string"), title, col("category"), col("sub_category"))
    df = df.withColumn("terms", category.terms(col("category"), col("sub_category")))
    return df.select(
        "*", title_tokens(title).alias("tokens"), events.title_scopes(title).alias("title_scopes"), events.quarter_years(title).alias("quarters"),
        events.month_days(title).alias("month_days"), events.title_directions(title).alias("title_directions"), events.significant_numbers(title).alias("numbers"),
        events.speaks_of_threshold(title).alias("has_threshold"), events.us_districts(title).alias("us_districts"), events.us_states(title).alias("us_states"),
        events.countries(title).alias("countries"), has_term(title, lx.RELATION_TERMS).alias("has_relation"), is_match.alias("is_match"), is_event.alias("is_event"),
        events.sports_families(col("terms"), title).alias("sports"), events.is_broad_question(title).alias("is_broad"),
        F.lower(F.concat_ws(" ", "category", "sub_category")).alias("category_text"),
    )


def side(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*(col(c).alias(f"{prefix}_{c}") for c in df.columns))


def _within(c: Column, values) -> Column:
    return F.array_intersect(c, strings(values))


def title_scope_conflict() -> Column:
    """R4."""
    k, p = col("k_title_scopes"), col("p_title_scopes")
    has = F.array_contains
    out = disjoint(_within(k, lx.OFFICES), _within(p, lx.OFFICES)) | (has(k, "winner") & has(p, "qualifier")) | (has(k, "qualifier") & has(p, "winner"))
    for group in lx.EXCLUSIVE_TITLE_SCOPES:
        out = out | disjoint(_within(k, group), _within(p, group))
    for term in ("margin", "outright", "place"):
        one_sided = has(k, term) != has(p, term)
        out = out | (one_sided & ((has(k, "winner") & has(p, term)) | (has(p, "winner") & has(k, term))))
    return out


def same_marker(a: Column, b: Column) -> Column:
    """Month and day equal, years equal or one unsaid."""
    return (F.substring(a, 1, 5) == F.substring(b, 1, 5)) & ((F.length(a) == 6) | (F.length(b) == 6) | (a == b))


def date_scope_conflict() -> Column:
    """R5."""
    k, p = col("k_month_days"), col("p_month_days")
    met = F.exists(k, lambda a: F.exists(p, lambda b: same_marker(a, b)))
    return disjoint(col("k_quarters"), col("p_quarters")) | ((F.size(k) > 0) & (F.size(p) > 0) & ~met)


def direction_conflict() -> Column:
    """Purely up against purely down."""
    k, p = F.array_join(col("k_title_directions"), ""), F.array_join(col("p_title_directions"), "")
    return ((k == "up") & (p == "down")) | ((k == "down") & (p == "up"))


def numeric_conflict() -> Column:
    """R7."""
    return col("k_has_threshold") & col("p_has_threshold") & disjoint(col("k_numbers"), col("p_numbers"))


def location_conflict() -> Column:
    """R8."""
    ks, ps, kc, pc = col("k_us_states"), col("p_us_states"), col("k_countries"), col("p_countries")
    shared = overlaps(ks, ps)
    abroad = lambda c: F.size(F.array_except(c, strings(["united states"]))) > 0
    relation = (F.size(kc) >= 2) & (F.size(pc) >= 2) & (kc != pc) & col("k_has_relation") & col("p_has_relation")
    return (
        disjoint(col("k_us_districts"), col("p_us_districts")) | disjoint(ks, ps) | ((F.size(ks) > 0) & ~shared & abroad(pc)) | ((F.size(ps) > 0) & ~shared & abroad(kc)) | disjoint(kc, pc) | relation
    )


def granularity_conflict() -> Column:
    """R9."""
    return (col("k_is_match") & col("p_is_event") & ~col("k_is_event")) | (col("p_is_match") & col("k_is_event") & ~col("p_is_event"))


def sports_conflict() -> Column:
    """R10."""
    return disjoint(col("k_sports"), col("p_sports"))


def broad_specific() -> Column:
    """One plain keyword in common, and just one of the titles is a broad question."""
    keys = col("scope_keys")
    return (F.size(keys) == 1) & ~is_distinctive(F.try_element_at(keys, F.lit(1))) & (col("k_is_broad") != col("p_is_broad"))


def signature_conflict(k_years: Column, p_years: Column, k_persons: Column, p_persons: Column) -> Column:
    """R2: all years more than one apart, or persons without a common name token."""
    near = F.exists(k_years, lambda a: F.exists(p_years, lambda b: F.abs(a.cast("int") - b.cast("int")) <= 1))
    tokens = lambda c: F.flatten(F.transform(c, lambda v: F.filter(F.split(F.lower(v), "[^a-z0-9]+"), lambda t: F.length(t) > 1)))
    return ((F.size(k_years) > 0) & (F.size(p_years) > 0) & ~near) | disjoint(tokens(k_persons), tokens(p_persons))


def hard_conflict(k_years: Column, p_years: Column, k_places: Column, p_places: Column) -> Column:
    """R3."""
    return disjoint(k_years, p_years) | disjoint(k_places, p_places)


def hard_reject_reason() -> Column:
    """The first rule that rejects, empty if none."""
    order = (
        ("broad_specific_scope", broad_specific()), ("scope_granularity_conflict", granularity_conflict()), ("sports_domain_conflict", sports_conflict()),
        ("date_scope_conflict", date_scope_conflict()), ("title_scope_conflict", title_scope_conflict()), ("direction_conflict", direction_conflict()),
        ("numeric_threshold_conflict", numeric_conflict()), ("location_conflict", location_conflict()),
    )
    return F.coalesce(*(F.when(test, F.lit(name)) for name, test in order), F.lit(""))


def preverify_reject_reason() -> Column:
    """The same family in the order that runs before verification, with its own labels."""
    order = (
        ("date_scope_conflict", date_scope_conflict()), ("title_scope_conflict", title_scope_conflict()), ("direction_conflict", direction_conflict()),
        ("numeric_threshold_conflict", numeric_conflict()), ("location_conflict", location_conflict()), ("scope_granularity_conflict", granularity_conflict()),
        ("sports_domain_conflict", sports_conflict()), ("broad_specific_scope", broad_specific()),
    )
    return F.coalesce(*(F.when(test, F.lit(f"rejected:{name}")) for name, test in order), F.lit(""))


def with_evidence(pairs: DataFrame) -> DataFrame:
    """Evidence keys, counts and title overlaps of pairs with common_keywords and both sides' features."""
    common = col("common_keywords")
    plain = F.filter(common, lambda k: ~F.lower(F.trim(k)).startswith("year:"))
    evidence = F.filter(plain, lambda k: is_distinctive(k) | ~F.lower(F.trim(k)).isin(*lx.GENERIC_SINGLE_KEYWORDS))
    out = pairs.withColumn("scope_keys", F.array_distinct(F.transform(plain, evidence_key))).withColumn("evidence", F.array_sort(F.array_distinct(F.transform(evidence, evidence_key))))
    out = out.withColumn("n", F.size("evidence")).withColumn("n_distinct", F.size(F.filter("evidence", is_distinctive)))
    out = out.withColumn("ov", overlap(col("k_tokens"), col("p_tokens"))).withColumn("jac", jaccard(col("k_tokens"), col("p_tokens")))
    out = out.withColumn("same_tokens", (F.size("k_tokens") > 0) & (col("k_tokens") == col("p_tokens")))
    least = F.least(F.size("k_keywords"), F.size("p_keywords"))
    one = F.try_element_at("evidence", F.lit(1))
    text = F.concat_ws(" ", "k_category_text", "p_category_text")
    support = F.array_contains("k_terms", one) | F.array_contains("p_terms", one) | text.contains(one)
    return out.withColumn("ratio", F.when(least > 0, col("n") / least).otherwise(F.lit(0.0))).withColumn("has_support", (col("n") == 1) & F.coalesce(support, F.lit(False)))


def keeps_by_keywords() -> Column:
    """R12."""
    n, d, ov, jac, ratio = (col(c) for c in ("n", "n_distinct", "ov", "jac", "ratio"))
    some = (F.size("k_keywords") > 0) & (F.size("p_keywords") > 0)
    three = F.when(d > 0, (ov >= 0.35) | (jac >= 0.22) | (ratio >= 0.45)).otherwise((ov >= 0.60) | (jac >= 0.30) | (ratio >= 0.55))
    two = (ratio >= 0.45) | (d > 0) | ((ov >= 0.55) & (jac >= 0.30))
    one = ((d > 0) & (ov >= 0.50) & (jac >= 0.25)) | ((ov >= 0.65) & (jac >= 0.30)) | ((ov >= 0.50) & (jac >= 0.25) & col("has_support"))
    return some & F.when(n >= 3, three).when(n == 2, two).when(n == 1, one).otherwise(F.lit(False))


def keeps_by_title() -> Column:
    """R13."""
    n, d, ov, jac = (col(c) for c in ("n", "n_distinct", "ov", "jac"))
    able = (F.size("common_keywords") > 0) & ~sports_conflict() & (F.size("k_tokens") > 0) & (F.size("p_tokens") > 0)
    ladder = ((n >= 4) & (ov >= 0.45)) | ((n >= 3) & (ov >= 0.55)) | ((n >= 2) & (ov >= 0.70)) | ((n >= 2) & (d > 0) & (ov >= 0.55)) | ((n == 1) & (d > 0) & (ov >= 0.75) & (jac >= 0.50))
    return able & (col("same_tokens") | ((ov >= 0.85) & (jac >= 0.75)) | (~broad_specific() & ladder))


def keeps_in_broad_mode() -> Column:
    """R14."""
    n, d, ov, jac = (col(c) for c in ("n", "n_distinct", "ov", "jac"))
    return (n >= 2) & F.when(n >= 3, (ov >= 0.35) | (jac >= 0.22)).when(d > 0, (ov >= 0.45) | (jac >= 0.25)).otherwise((ov >= 0.60) | (jac >= 0.30))


def with_quality(pairs: DataFrame) -> DataFrame:
    """Score, tier and path; needs by_category, by_keywords, by_title and mode."""
    n, d, ov, jac = (col(c) for c in ("n", "n_distinct", "ov", "jac"))
    points = lambda test, value: F.when(test, F.lit(value)).otherwise(F.lit(0))
    broad = col("mode") == "broad_fallback"
    score = (
        n * 70 + d * 35 + (ov * 100).cast("int") + (jac * 160).cast("int") + F.when(col("by_category"), F.when(broad, 15).otherwise(45)).otherwise(0)
        + points(col("by_keywords"), 35) + points(col("by_title"), 55) + points(col("same_tokens"), 140)
        - points((n <= 1) & (d == 0), 80) - points((jac < 0.22) & (ov < 0.50), 60)
    )
    out = pairs.withColumn("_score", score)
    tier = F.when(col("same_tokens") | ((jac >= 0.75) & (ov >= 0.85)), "exact").when(col("_score") >= 430, "strong").when(col("_score") >= 270, "medium").otherwise("weak")
    lifted = (tier == "weak") & (n == 1) & col("by_category") & ~broad & (ov >= 0.50) & (jac >= 0.25) & (col("has_support") | ((ov >= 0.65) & (jac >= 0.33)))
    path = F.when(col("by_category") & col("by_keywords"), F.when(broad, "broad_category_keywords").otherwise("category_keywords")).when(col("by_title"), "strong_textual_fallback").otherwise("not_kept")
    out = out.withColumn("quality_tier", F.when(lifted, "medium").otherwise(tier)).withColumn("quality_score", F.when(lifted, F.greatest(col("_score"), F.lit(270))).otherwise(col("_score")))
    return out.withColumn("path", path).drop("_score")


def _wild(a: Column, b: Column) -> Column:
    """Dates or periods with equal parts, ???? fitting any year."""
    x, y = F.split(a, "-"), F.split(b, "-")
    return (F.size(x) == F.size(y)) & F.forall(F.arrays_zip(x.alias("x"), y.alias("y")), lambda p: (p["x"] == p["y"]) | (p["x"] == "????") | (p["y"] == "????"))


def _no_time_in_common(k: Column, p: Column) -> Column:
    return (F.size(k) > 0) & (F.size(p) > 0) & ~F.exists(k, lambda a: F.exists(p, lambda b: _wild(a, b)))


def explicit_conflicts() -> Column:
    """Sorted names of the profile fields in which the two events can't be one."""
    tests = {name: disjoint(col(f"k_{name}"), col(f"p_{name}")) for name in ("groups", "districts", "locations", "seasons", "directions", "thresholds")}
    k, p = col("k_participants"), col("p_participants")
    tests["participants"] = (F.size(k) > 0) & (F.size(p) > 0) & ~events.same_participants(k, p)
    for name in ("dates", "periods"):
        tests[name] = _no_time_in_common(col(f"k_{name}"), col(f"p_{name}"))
    scopes = F.lit(False)
    for group in lx.EXCLUSIVE_SCOPES:
        k, p = _within(col("k_scopes"), group), _within(col("p_scopes"), group)
        clash = disjoint(k, p)
        if group == ("meeting", "annual_end"):
            december = F.when(F.array_contains(k, "meeting"), F.exists("k_periods", lambda v: v.endswith("-12"))).otherwise(F.exists("p_periods", lambda v: v.endswith("-12")))
            clash = clash & ~(december & ~disjoint(col("k_years"), col("p_years")))
        scopes = scopes | clash
    tests["scopes"] = scopes
    return F.array_compact(F.array(*(F.when(tests[name], F.lit(name)) for name in sorted(tests))))


def one_sided_fields() -> Column:
    """Fields that only one of the events states."""
    return F.array_compact(F.array(*(F.when((F.size(f"k_{f}") > 0) != (F.size(f"p_{f}") > 0), F.lit(f)) for f in sorted(events.FIELDS))))
