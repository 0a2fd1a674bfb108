"""Outcome candidates: keys, subjects, deadlines, scopes, compatibility, ranking and bundles."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from xmarket.functions import category
from xmarket.functions import outcome_lexicon as ox
from xmarket.functions.text import disjoint, label, literal_map, named, overlaps, safe_text, squeeze, strings
from xmarket.functions.udf import ascii_fold, extract_deadline
from xmarket.session import written

col = F.col
# Aliases of whole subjects.
SUBJECT_ALIASES = {
    "u s": "united states", "u s a": "united states", "usa": "united states", "us": "united states", "united states of america": "united states",
    "korea republic": "south korea", "republic of korea": "south korea", "czech republic": "czechia", "cote d ivoire": "ivory coast",
    "cote divoire": "ivory coast", "dr congo": "democratic republic of congo", "drc": "democratic republic of congo",
    "uae": "united arab emirates", "uk": "united kingdom", "england": "england", "great britain": "england",
}
NONE = "array<string>"


def phrase(c: Column) -> Column:
    """A phrase in the spelling of outcomes, an alias for it as a whole applied."""
    return _spelled(ascii_fold(safe_text(c)))


def _spelled(c: Column) -> Column:
    """phrase() of text that is ASCII already."""
    text = F.replace(F.lower(safe_text(c)), F.lit("&"), F.lit(" and "))
    text = F.regexp_replace(F.translate(text, "’`", "''"), r"\b(men|women)'s\b", "$1s")
    text = squeeze(F.regexp_replace(F.regexp_replace(F.regexp_replace(text, r"\bu\.s\.a\.\b", "usa"), r"\bu\.s\.\b", "us"), r"[^a-z0-9.#%$]+", " "))
    return F.coalesce(F.element_at(literal_map(SUBJECT_ALIASES), text), text)


def subject_key(c: Column) -> Column:
    """X10."""
    return phrase(c)


def tokens(text: Column) -> Column:
    """X11: tokens of a phrase(): words over one letter that are no stop words, known phrases, groups; sorted."""
    words = F.filter(F.split(text, " "), lambda w: (F.length(w) > 1) & ~w.isin(*ox.STOP_WORDS))
    plain = F.transform(words, lambda w: F.when(w == "ipos", F.lit("ipo")).otherwise(w))
    group = F.transform(F.regexp_extract_all(text, F.lit(r"\bgroup\s+([a-z])\b"), F.lit(1)), lambda g: F.concat(F.lit("group "), g))
    return F.array_sort(F.array_distinct(F.concat(plain, named(text, ox.PHRASES), group)))


def meaningful(keywords: Column) -> Column:
    """X11: keywords that are neither generic nor numbers."""
    return F.filter(keywords, lambda w: ~w.isin(*ox.GENERIC_TOKENS) & ~w.rlike("^[0-9]+$"))


def strip_outcome_suffix(title: Column) -> tuple[Column, Column]:
    """A title without its [Yes] or (No) at the end, and the side."""
    pattern = r"(?i)\s*[\[\(]\s*(yes|no)\s*[\]\)]\s*$"
    return F.trim(F.regexp_replace(safe_text(title), pattern, "")), F.lower(F.regexp_extract(safe_text(title), pattern, 1))


def drops_no_side(outcome: Column, title: Column) -> Column:
    """the row is the No side of a yes/no market."""
    return (F.lower(F.trim(F.coalesce(outcome, F.lit("")))) == "no") | (strip_outcome_suffix(title)[1] == "no")


def is_generic_subject(c: Column) -> Column:
    """a generic word, a bare date, year or quarter, or scope words alone."""
    return _is_generic(phrase(c))


def _is_generic(text: Column) -> Column:
    """is_generic_subject() of a phrase()."""
    bare = text.rlike(rf"^(?:{ox.MONTHS})\s+\d{{1,2}}(?:\s+20\d{{2}})?$|^(?:q[1-4]\s+)?20\d{{2}}$")
    return text.isin("", *ox.GENERIC_SUBJECTS) | bare | (F.size(F.array_except(tokens(text), strings(ox.SCOPE_WORDS))) == 0)


def _subject(title: Column, pattern: str) -> Column:
    return squeeze(F.regexp_replace(F.regexp_extract(safe_text(title), pattern, 1), r"(?i)\b(any|a|an|the)\b", " "))


def with_subject_from_title(df: DataFrame, title_col: str, out: str = "subject") -> DataFrame:
    """Who or what a question is about; empty if nobody.  Steps of columns, so that no phrase is spelled twice."""
    raw = [f"_s{i}" for i in range(len(ox.SUBJECT_PATTERNS))]
    df = df.withColumns({n: _subject(col(title_col), p) for n, p in zip(raw, ox.SUBJECT_PATTERNS, strict=True)})
    df = df.withColumns({f"{n}p": _spelled(col(n)) for n in raw})
    found = F.coalesce(*(F.when((col(n) != "") & ~_is_generic(col(f"{n}p")), col(n)) for n in raw), F.lit(""))
    return df.withColumn(out, found).drop(*raw, *(f"{n}p" for n in raw))


def intent_without_subject(intent: Column, subject: Column) -> Column:
    """The market's phrase without the subject's and without question words."""
    quoted = F.concat(F.lit(r"\b\Q"), subject, F.lit(r"\E\b"))
    rest = F.when(subject == "", intent).otherwise(F.regexp_replace(intent, quoted, F.lit(" ")))
    return squeeze(F.regexp_replace(rest, r"\b(will|who|which|what|when|where|does|is|are)\b", " "))


def actor_key(text: Column) -> Column:
    """Who acts, where the question, a phrase(), is what they do."""
    found = []
    for p in ox.ACTOR_PATTERNS:
        a = F.regexp_extract(text, p, 1)
        found.append(F.when(~a.isin("", "who", "someone", "anyone"), F.coalesce(F.element_at(literal_map(SUBJECT_ALIASES), a), a)))
    return F.coalesce(*found, F.lit(""))


def event_years(c: Column) -> Column:
    """Years that are no deadline: none of before, by, until, through, deadline within 25 characters before them."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit(r"(?<!\b(?:before|by|until|through|deadline)\b.{0,25})\b(20[2-3][0-9])\b"), F.lit(1))))


def rank_terms(text: Column) -> Column:
    """Rank:N by the first way in which the text names a rank."""
    number = F.regexp_extract(text, r"#\s*(\d+)\b", 1)
    ordinal = F.regexp_extract(text, r"\b(\d+)(?:st|nd|rd|th)\s+(?:overall\s+pick|place)\b", 1)
    word = F.regexp_extract(text, r"\b(first|second|third)\s+(?:overall\s+pick|place)\b", 1)
    implied = text.rlike(r"\b(?:top|most)\b") & text.rlike(r"\b(?:artist|album|song|listeners|scorer)\w*\b")
    value = (
        F.when(number != "", number.cast("long").cast("string")).when(text.rlike(r"\blast\s+place\b"), "last").when(ordinal != "", ordinal.cast("long").cast("string"))
        .when(word != "", F.element_at(literal_map({"first": "1", "second": "2", "third": "3"}), word)).when(text.rlike(r"\b(?:runner[ -]?up|second place)\b"), "2").when(implied, "1")
    )
    return F.array_compact(F.array(F.concat(F.lit("rank:"), value)))


def with_scope_terms(df: DataFrame, phrase_col: str, out: str = "scope_terms", dimensions: dict[str, str] | None = None) -> DataFrame:
    """What a market's phrase() asks for, as sorted terms; dimensions may be replaced.

    Works in steps of columns, so that some two hundred patterns run once a row whatever the rules that read them.
    """
    df = df.withColumn("_own", tokens(col(phrase_col)))
    text, own = col(phrase_col), col("_own")
    tag = lambda prefix, table: F.transform(named(text, table), lambda n: F.concat(F.lit(prefix), n))
    found = F.concat(
        F.array_intersect(own, strings(ox.SCOPE_WORDS)), F.filter(own, lambda t: t.startswith("group ")), named(text, ox.SIMPLE_SCOPES), named(text, dimensions or ox.DIMENSIONS),
        tag("competition:", ox.COMPETITIONS), tag("award_category:", ox.AWARD_CATEGORIES), rank_terms(text),
    )
    deadline = r"\b(before|by|until|through)\s+(?:the\s+end\s+of\s+)?(20[2-3]\d)\b"
    ends = F.arrays_zip(F.regexp_extract_all(text, F.lit(deadline), F.lit(1)).alias("r"), F.regexp_extract_all(text, F.lit(deadline), F.lit(2)).alias("y"))
    found = F.concat(found, F.transform(ends, lambda e: F.concat(F.lit("deadline_year:"), F.when(e["r"] == "before", e["y"].cast("int") - 1).otherwise(e["y"].cast("int")).cast("string"))))
    df = df.withColumn("_found", found)
    has = lambda t: F.array_contains("_found", t)
    weight = F.regexp_extract(text, r"\b(light\s+heavyweight|flyweight|bantamweight|featherweight|lightweight|welterweight|middleweight|heavyweight)\b", 1)
    manager = F.coalesce(F.nullif(F.regexp_extract(text, r"\bnext\s+manager\s+of\s+(.+)$", 1), F.lit("")), F.regexp_extract(text, r"\bnext\s+(.+?)\s+manager\b", 1))
    manager = squeeze(F.regexp_replace(manager, r"\b20[2-3]\d\b", " "))
    state = text.rlike(r"\bstate\s+(?:house|senate)\b")
    said = text.rlike(r"\b(?:say|said)\b")
    live = text.rlike(r"\bnext\s+live\s+announcement\b")
    wbc = has("competition:wbc")
    pool = text.rlike(r"\bpool\s+[a-z0-9]+\b")
    men = ~has("gender:women") & (text.rlike(r"\bmens?\b") | (has("competition:ucl") & ~has("competition:womens_ucl")))
    add = (
        ((weight != "") & F.array_contains(own, "ufc"), F.concat(F.lit("weight_class:"), F.replace(weight, F.lit(" "), F.lit("_")))), (manager != "", F.concat(F.lit("manager_target:"), manager)),
        (state, F.lit("legislative_level:state")), (~state & has("district_race") & has("house"), F.lit("legislative_level:federal")),
        (wbc & pool, F.lit("competition_stage:pool")), (wbc & ~pool & has("winner"), F.lit("competition_stage:overall")), (men, F.lit("gender:men")),
        (said & live, F.lit("speech_context:live_announcement")), (said & ~live & has("period:weekly"), F.lit("speech_context:weekly")), (said & ~live & ~has("period:weekly") & has("period:monthly"), F.lit("speech_context:monthly")),
        (has("winner"), F.lit("rank:1")), (has("election_winner") & ~has("first_round_winner") & ~has("runoff_advancement"), F.lit("overall_election_winner")),
    )
    gone = (
        (has("bond_role_q"), "bond_role_bond"), (has("presidential_run"), "presidential_nomination"), (has("individual_legislative_race"), "national_chamber_control"),
        (has("award_conference_finals_mvp") | has("award_finals_mvp"), "award_mvp"), (has("ufc_weight_title"), "ufc_any_title"),
    )
    more = F.array_compact(F.array(*(F.when(test, value) for test, value in add)))
    less = F.array_compact(F.array(*(F.when(test, F.lit(value)) for test, value in gone)))
    return df.withColumn(out, F.array_sort(F.array_except(F.array_union(col("_found"), more), less))).drop("_own", "_found")


def context_scope_terms(event_id: Column, category_: Column, sub_category: Column) -> Column:
    """Competitions, level and gender by the event's id and category (plain text, read as it is)."""
    text = squeeze(F.regexp_replace(F.lower(F.concat_ws(" ", category_, sub_category)), r"[^a-z0-9.#%$]+", " "))
    key = F.regexp_replace(F.upper(safe_text(event_id)), "[^A-Z0-9]", "")
    marks = F.flatten(F.array(*(F.when(key.contains(m), strings(list(v))).otherwise(F.array().cast(NONE)) for m, v in ox.EVENT_MARKERS.items())))
    women = text.rlike(r"\bwomens?\b")
    rest = (
        (text.rlike(r"\b(?:nba|nfl|nhl|mlb|professional)\b"), "sport_level:professional"), (text.rlike(r"\b(?:ncaa[bf]?|ncaab|college)\b"), "sport_level:college"),
        (women, "gender:women"), (~women & text.rlike(r"\bmens?\b"), "gender:men"),
    )
    competitions = F.transform(named(text, ox.COMPETITIONS), lambda n: F.concat(F.lit("competition:"), n))
    return F.array_sort(F.array_distinct(F.concat(competitions, marks, F.array_compact(F.array(*(F.when(t, F.lit(v)) for t, v in rest))))))


def _once(df: DataFrame, keys: list[str], make, table: str) -> DataFrame:
    """df with the columns that make() adds to keys, which hold no nulls: made once for each of their values, however many rows have it."""
    return df.join(written(make(df.select(*keys).distinct().repartition(_tasks(df))), table), keys)


def outcome_profiles(rows: DataFrame, venue: str) -> DataFrame:
    """Outcome profiles of market rows of a venue (columns as in operators.sync): subject, key, intent, scopes, deadline.

    Rows of the No side and rows without a subject are left out.  The hundreds of patterns run on distinct texts, which are far fewer than rows:
    bet titles, market titles, intents and texts with dates each for themselves.  Last is a count of subjects per event.
    """
    c = lambda name: F.col(f"`{name}`") if name in rows.columns else F.lit("")
    base = rows.where(~drops_no_side(c("Outcome_Name"), c("Bet Title"))) if venue == "P" else rows
    texts = F.array(*(safe_text(c(n)) for n in ("Bet_Rules", "Event_Description", "Description", "Bet Title", "Market Title")))
    base = base.select(
        F.lit(venue).alias("platform"), safe_text(c("Event ID")).alias("event_id"), safe_text(c("Bet ID")).alias("bet_id"), safe_text(c("Original_Market_ID")).alias("original_market_id"),
        safe_text(c("Market Title")).alias("market_title"), safe_text(c("Bet Title")).alias("bet_title"), label(c("Category")).alias("category"), label(c("Sub-Category")).alias("sub_category"),
        (F.coalesce(F.nullif(safe_text(c("Outcome_Name")), F.lit("")), F.lit("Yes")) if venue == "P" else F.lit("Yes")).alias("outcome_name"),
        F.transform(texts, lambda t: F.when(t.contains("20"), t).otherwise(F.lit(""))).alias("_texts"),  # without a year of this century a text has no deadline
    )
    base = written(base, "rows")

    def of_bets(t: DataFrame) -> DataFrame:
        own = strip_outcome_suffix(col("bet_title"))[0] if venue == "P" else col("bet_title")
        return t.withColumn("_own", own).withColumn("_own_p", phrase(col("_own"))).withColumn("_own_generic", _is_generic(col("_own_p")))

    def of_markets(t: DataFrame) -> DataFrame:
        t = t.withColumns({"_market_p": phrase(col("market_title")), "_title": ascii_fold(col("market_title"))})
        t = with_subject_from_title(t, "_title", "_asked_for").drop("_title")
        t = t.withColumn("_asked_p", _spelled(col("_asked_for"))).withColumn("_asked_generic", _is_generic(col("_asked_p")))
        return t.withColumn("actor", actor_key(col("_market_p"))).withColumn("event_years", event_years(col("market_title")))

    def of_intents(t: DataFrame) -> DataFrame:
        t = t.withColumn("market_intent", intent_without_subject(col("_market_p"), col("_shown"))).withColumn("_phrase", _spelled(col("market_intent")))
        return with_scope_terms(t.withColumn("market_keywords", tokens(col("_phrase"))), "_phrase", "_asked").drop("_phrase")

    def of_classes(t: DataFrame) -> DataFrame:
        t = written(t, "classes")
        t = _once(t, ["_market_p", "_shown"], of_intents, "intents")
        t = _once(t, ["event_id", "category", "sub_category"], lambda x: x.withColumn("_context", context_scope_terms(col("event_id"), col("category"), col("sub_category"))), "contexts")
        t = _once(t, ["_texts"], lambda x: x.withColumn("deadline", extract_deadline(col("_texts"))), "deadlines")
        return t.select("_class", "market_intent", "market_keywords", F.array_sort(F.array_union("_asked", "_context")).alias("scope_terms"), "deadline")

    base = _once(_once(base, ["bet_title"], of_bets, "bet_titles"), ["market_title"], of_markets, "market_titles")
    generic = (col("_own_p") == col("_market_p")) | col("_own_generic")
    base = base.where(~generic | ~col("_asked_generic")).withColumns({
        "outcome_subject": F.when(~generic, col("_own")).otherwise(col("_asked_for")), "subject_source": F.when(~generic, "bet_title").when(col("_asked_for") != "", "market_title").otherwise(""),
        "outcome_key": F.when(~generic, col("_own_p")).otherwise(col("_asked_p")),
    })
    # the intent is the title without the key: that of the title where it doesn't have the key
    base = base.withColumn("_shown", F.when(col("_market_p").contains(col("outcome_key")), col("outcome_key")).otherwise(F.lit("")))
    by = ["event_id", "category", "sub_category", "_market_p", "_shown", "_texts"]
    base = written(base.withColumn("_class", _digest(F.to_json(F.struct(*by)))).drop("_own", "_own_p", "_own_generic", "_asked_for", "_asked_p", "_asked_generic"), "subjects")
    classes = of_classes(base.select("_class", *by).distinct().repartition(_tasks(base)))
    base = base.drop("_market_p", "_shown", "_texts").join(written(classes, "class_terms"), "_class").drop("_class")
    return with_subject_count(written(base, "outcomes"), "event_id")


def deadlines_compatible(a: Column, b: Column) -> Column:
    """At most a day apart, or one unsaid; dates as yyyy-mm-dd text."""
    return (a == "") | (b == "") | (F.abs(F.datediff(F.to_date(F.nullif(a, F.lit(""))), F.to_date(F.nullif(b, F.lit(""))))) <= 1)


def annual_window_conflict(has_window: Column, deadline: Column) -> Column:
    """A whole year against a deadline other than its end or the next year's first day."""
    return has_window & (deadline != "") & ~F.substring(deadline, 6, 5).isin("12-31", "01-01")


def year_deadline_conflict(years: Column, deadline: Column) -> Column:
    """Event years without the deadline's, the first of January of the next year aside."""
    year = F.substring(deadline, 1, 4)
    before = F.when(F.substring(deadline, 6, 5) == "01-01", (year.cast("int") - 1).cast("string")).otherwise(year)
    return (F.size(years) > 0) & (deadline != "") & ~F.array_contains(years, year) & ~F.array_contains(years, before)


def years_compatible(a: Column, b: Column) -> Column:
    """X39."""
    return ~disjoint(a, b)


def actors_compatible(a: Column, b: Column) -> Column:
    """Unsaid on a side, or a token in common."""
    return (a == "") | (b == "") | overlaps(tokens(a), tokens(b))


def namespace_conflict(a: Column, b: Column, prefix: str) -> Column:
    """Terms of one namespace on both sides and none in common."""
    of = lambda c: F.filter(c, lambda t: t.startswith(prefix))
    return disjoint(of(a), of(b))


def scope_conflict(k: str, p: str, exclusive: list[list[str]] | None = None, namespaces: list[str] | None = None) -> Column:
    """Deadlines, windows, years, actors, groups, winner against qualifier, exclusive sets, namespaces, offices and ranks.

    k and p are prefixes of the columns scope_terms, deadline, event_years, actor.
    """
    c = lambda side, name: col(f"{side}_{name}")
    ks, ps = c(k, "scope_terms"), c(p, "scope_terms")
    has = F.array_contains
    within = lambda s, names: F.array_intersect(s, strings(names))
    group = lambda s: F.array_sort(F.filter(s, lambda t: t.startswith("group ")))
    out = ~F.coalesce(deadlines_compatible(c(k, "deadline"), c(p, "deadline")), F.lit(True))
    for a, b in ((k, p), (p, k)):
        out = out | annual_window_conflict(has(c(a, "scope_terms"), "period:annual"), c(b, "deadline")) | year_deadline_conflict(c(a, "event_years"), c(b, "deadline"))
        out = out | (has(c(a, "scope_terms"), "winner") & has(c(b, "scope_terms"), "qualifier"))
    out = out | ~years_compatible(c(k, "event_years"), c(p, "event_years")) | ~actors_compatible(c(k, "actor"), c(p, "actor")) | (group(ks) != group(ps))
    out = out | (has(ks, "golden boot") != has(ps, "golden boot"))
    for names in ox.EXCLUSIVE if exclusive is None else exclusive:
        out = out | disjoint(within(ks, names), within(ps, names))
    for prefix in ox.NAMESPACES if namespaces is None else namespaces:
        out = out | namespace_conflict(ks, ps, prefix)
    ranked = lambda s: F.exists(s, lambda t: t.startswith("rank:"))
    periods = ranked(ks) & ranked(ps) & namespace_conflict(ks, ps, "period:")
    return out | namespace_conflict(ks, ps, "rank:") | periods | disjoint(within(ks, ox.OFFICES), within(ps, ox.OFFICES)) | disjoint(within(ks, ["seat_count", "city_count"]), within(ps, ["seat_count", "city_count"]))


def intent_compatible(shared: Column, shared_scopes: Column, conflicts: Column) -> Column:
    """No conflict, a shared meaningful keyword, and a second shared one or a shared scope."""
    return ~conflicts & (F.size(meaningful(shared)) >= 1) & ((F.size(shared) >= 2) | (F.size(shared_scopes) > 0))


def pair_score(shared_market: Column, shared_outcome: Column, equal_subject: Column, shared_scopes: Column, any_multi: Column) -> Column:
    """R22."""
    point = lambda test, value: F.when(test, F.lit(value)).otherwise(F.lit(0))
    return F.size(shared_market) + 3 * F.size(shared_outcome) + point(equal_subject, 12) + point(F.size(shared_scopes) > 0, 3) + point(any_multi, 2)


def candidate_type(k_multi: Column, p_multi: Column) -> Column:
    """R22."""
    return F.when(k_multi & p_multi, "outcome_outcome").otherwise("event_outcome")


#: What a pair is judged by besides its keywords and event sizes, by side, in parts that are judged apart.
PARTS = {
    "of_events": ("is_match", "is_event", "us_districts", "us_states", "countries", "has_relation", "sports"),
    "of_terms": ("terms",),
    "of_scopes": ("scope_terms", "deadline", "event_years", "actor"),
}
JUDGED = (*(c for names in PARTS.values() for c in names), "multi")


def _judged(k: DataFrame, p: DataFrame, k_kinds: DataFrame, p_kinds: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Pairs of kinds that don't conflict (k_kind, p_kind, multi flags, scopes: one entry if a scope is shared), and (kind, merged) of both sides.

    Kinds are compared all with all, or only those that meet under an outcome key, whichever is less, by tables of the values of each part that fit:
    many kinds have one value of a part.  Then kinds of a side that
    are judged alike with each kind of the other are merged, and the pairs are those of merged kinds.
    """
    from xmarket.operators import rules

    at_k, at_p = (written(df.select("outcome_key", col("kind").alias(f"{s}_kind")).distinct(), "kinds_at") for s, df in (("k", k), ("p", p)))
    marked = [_digest(F.to_json(F.struct(*names), {"ignoreNullFields": "false"})).alias(part) for part, names in PARTS.items()]
    k_kinds, p_kinds = (written(rules.side(df.select("kind", *marked, *JUDGED).distinct(), s), "kinds") for s, df in (("k", k_kinds), ("p", p_kinds)))
    met = at_k.groupBy("outcome_key").agg(F.count(F.lit(1)).alias("a")).join(at_p.groupBy("outcome_key").agg(F.count(F.lit(1)).alias("b")), "outcome_key")
    meetings = met.agg(F.coalesce(F.sum(col("a") * col("b")), F.lit(0))).first()[0]
    k_ids, p_ids = (df.select(f"{s}_kind", f"{s}_multi", *(f"{s}_{part}" for part in PARTS)) for s, df in (("k", k_kinds), ("p", p_kinds)))
    all_with_all = k_kinds.count() * p_kinds.count() <= meetings
    if all_with_all:
        pairs = k_ids.repartition(_tasks(k)).crossJoin(p_ids)
    else:
        pairs = written(at_k.join(at_p, "outcome_key").select("k_kind", "p_kind").distinct().join(k_ids, "k_kind").join(p_ids, "p_kind"), "pairs")
    pairs = pairs.where(col("k_multi") | col("p_multi"))
    scopes = F.slice(F.transform(F.array_intersect("k_scope_terms", "p_scope_terms"), lambda _: F.lit("shared")), 1, 1)
    conflicts = {
        "of_events": rules.granularity_conflict() | rules.location_conflict() | rules.sports_conflict(),
        "of_terms": ~category.categories_overlap(col("k_terms"), col("p_terms")),
        "of_scopes": scope_conflict("k", "p"),
    }
    for part, names in PARTS.items():
        at = [f"k_{part}", f"p_{part}"]
        k_values, p_values = (df.select(f"{s}_{part}", *(f"{s}_{n}" for n in names)).dropDuplicates([f"{s}_{part}"]) for s, df in (("k", k_kinds), ("p", p_kinds)))
        both = k_values.repartition(_tasks(k)).crossJoin(p_values) if all_with_all else pairs.select(*at).distinct().join(k_values, at[0]).join(p_values, at[1])
        fit = both.where(~conflicts[part]).select(*at, *([scopes.alias("scopes")] if part == "of_scopes" else []))
        pairs = pairs.join(written(fit, "fit"), at)
    verdict = ("k_multi", "p_multi", "scopes")
    judged = written(pairs.select("k_kind", "p_kind", *verdict), "judged")
    merged = {}
    for s, other in (("k", "p"), ("p", "k")):
        row = F.to_json(F.sort_array(F.collect_list(F.struct(f"{other}_kind", *verdict))))
        merged[s] = written(judged.groupBy(f"{s}_kind").agg(_digest(row).alias("merged")).withColumnRenamed(f"{s}_kind", "kind"), "merged")
    side = lambda s: merged[s].select(col("kind").alias(f"{s}_kind"), col("merged").alias(f"{s}_merged"))
    both = judged.join(side("k"), "k_kind").join(side("p"), "p_kind").select(col("k_merged").alias("k_kind"), col("p_merged").alias("p_kind"), *verdict).distinct()
    return written(both, "judged"), merged["k"], merged["p"]


def _digest(text: Column) -> Column:
    return F.substring(F.sha2(text, 256), 1, 32)


def _tasks(df: DataFrame) -> int:
    spark = df.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


PAIRS_A_TASK = 1 << 24  # of groups that one call of Python scores, about


def outcome_candidates(k_profiles: DataFrame, p_profiles: DataFrame, per_bet: int = 5) -> DataFrame:
    """Profiles of both venues joined on the outcome key, compatible ones scored, the best per K bet kept.

    An outcome needs an event with several subjects on a side; ties keep the order of P bet ids.  Profiles that differ in nothing
    that a pair is judged by, or are judged alike, are one group: pairs of groups are scored, of a P group only its first bets can be chosen, and
    conflicts are looked up by pairs of kinds, which are far fewer than pairs of bets.  Shared keywords are counted in Arrow, through
    lists of the P groups that have a keyword; only the chosen pairs become rows.
    """
    from xmarket.operators import rules

    def prepared(df: DataFrame) -> tuple[DataFrame, DataFrame]:
        seen = ("market_title", "event_id", "category", "sub_category", "scope_terms", "deadline", "event_years", "actor", "multi")
        df = df.withColumn("multi", col("event_subject_count") > 1).withColumn("_case", _digest(F.to_json(F.struct(*seen), {"ignoreNullFields": "false"})))
        df = written(df.select("_case", *seen, "outcome_key", "market_keywords", "bet_id"), "cases_of")
        cases = written(df.select("_case", *seen).distinct(), "cases").repartition(_tasks(df))
        feats = rules.pair_features(cases.withColumn("title", col("market_title")))
        kind = _digest(F.to_json(F.struct(*JUDGED), {"ignoreNullFields": "false"}))
        feats = written(written(feats.select("_case", *JUDGED), "features").withColumn("kind", kind), "kinds_of")
        return written(df.join(feats.select("_case", "kind"), "_case").select("kind", "outcome_key", "market_keywords", "bet_id", "event_id"), "members"), feats

    (k, k_feats), (p, p_feats) = prepared(k_profiles), prepared(p_profiles)
    judged, k_merged, p_merged = _judged(k, p, k_feats, p_feats)
    alike = ["outcome_key", "kind", "market_keywords"]
    k, p = (df.join(m, "kind").select("outcome_key", col("merged").alias("kind"), "market_keywords", "bet_id", "event_id") for df, m in ((k, k_merged), (p, p_merged)))
    k = written(k.withColumn("k_group", _digest(F.to_json(F.struct(*alike)))), "members")
    p = written(p, "members")
    first = top_candidates(p, alike, [F.asc("bet_id"), F.asc("event_id")], per_bet)
    p_groups = first.groupBy(*alike).agg(F.collect_list(F.struct(col("bet_id").alias("p_bet"), col("event_id").alias("p_event"))).alias("bets"))
    spelled = written(k.select("outcome_key").distinct().withColumn("key_tokens", tokens(col("outcome_key"))), "keys")
    k_groups = written(k.select("k_group", *alike).distinct(), "groups")

    # a kind of K with the kinds of P that it goes with: their number, whether a scope is shared, whether both sides have several subjects
    numbers = written(judged.select("p_kind").distinct().withColumn("p_no", F.monotonically_increasing_id()), "numbers")
    code = col("p_no") * 4 + F.when(F.size("scopes") > 0, 2).otherwise(0) + F.when(candidate_type(col("k_multi"), col("p_multi")) == "outcome_outcome", 1).otherwise(0)
    fits = judged.join(numbers, "p_kind").groupBy(col("k_kind").alias("kind")).agg(F.collect_list(code).alias("fits"))
    p_groups = written(p_groups.join(numbers, p_groups.kind == numbers.p_kind).select("outcome_key", "p_no", col("market_keywords").alias("p_words"), "bets"), "groups")
    sizes = k_groups.groupBy("outcome_key").agg(F.count(F.lit(1)).alias("a")).join(p_groups.groupBy("outcome_key").agg(F.count(F.lit(1)).alias("b")), "outcome_key")
    sizes = written(sizes.select("outcome_key", F.ceil(col("a") * col("b") / PAIRS_A_TASK).cast("int").alias("parts")), "sizes")
    none, some = F.array().cast(NONE), F.array(F.lit(""))
    points = [pair_score(none, col("key_tokens"), F.lit(True), scopes, F.lit(True)).alias(name) for scopes, name in ((none, "points"), (some, "points_scope"))]
    meant = meaningful(col("market_keywords"))
    member = F.struct("k_group", F.size(meant).alias("meant"), F.concat(meant, F.array_except("market_keywords", meant)).alias("words"))
    wide = k_groups.join(sizes, "outcome_key").withColumn("part", F.pmod(F.xxhash64("k_group"), col("parts")).cast("int"))
    wide = wide.groupBy("outcome_key", "part", "kind").agg(F.collect_list(member).alias("groups")).join(fits, "kind")
    wide = wide.join(spelled, "outcome_key").select("outcome_key", "part", "fits", "groups", *points)
    each = p_groups.join(sizes, "outcome_key").withColumn("part", F.explode(F.sequence(F.lit(0), col("parts") - 1))).drop("parts")
    tasks, key = 4 * _tasks(k), ["outcome_key", "part"]
    met = wide.repartition(tasks, *key).groupBy(*key).cogroup(each.repartition(tasks, *key).groupBy(*key))
    best = met.applyInArrow(lambda ks, ps: best_of_groups(ks, ps, per_bet), "k_group string, candidate_type string, match_score int, p_bet string, p_event string, p_words array<string>")
    members = k.select("k_group", "outcome_key", "market_keywords", col("bet_id").alias("k_bet"), col("event_id").alias("k_event")).join(spelled, "outcome_key")
    top = top_candidates(members.join(written(best, "best"), "k_group"), ["k_bet"], [F.desc("match_score"), F.asc("p_bet"), F.asc("p_event")], per_bet)
    shared = F.array_sort(F.array_intersect("market_keywords", "p_words"))
    return top.select("candidate_type", "match_score", shared.alias("shared_market_keywords"), col("key_tokens").alias("shared_outcome_keywords"), "k_event", "p_event", "k_bet", "p_bet", "outcome_key")


def best_of_groups(ks: pa.Table, ps: pa.Table, per_bet: int) -> pa.Table:
    """The best P bets of each K group of a key by (score, P bet, P event); rows as outcome_candidates() makes them."""
    group, bet, score, both = [], [], [], []
    ps = ps.combine_chunks().sort_by("p_no")
    lists = lambda t, name: pa.concat_arrays(t[name].chunks) if t[name].num_chunks else pa.array([], t.schema.field(name).type)
    p_words, p_bets, k_groups, k_fits = lists(ps, "p_words"), lists(ps, "bets"), lists(ks, "groups"), lists(ks, "fits")
    members, bets = k_groups.flatten(), p_bets.flatten()
    k_words = pc.struct_field(members, "words")
    n = len(ps)
    # per keyword the P groups that have it
    coded = p_words.flatten().dictionary_encode()
    of = coded.indices.to_numpy()
    order = np.argsort(of, kind="stable")
    owners = np.repeat(np.arange(n), pc.list_value_length(p_words).to_numpy())[order]
    at = np.searchsorted(of[order], np.arange(len(coded.dictionary) + 1))
    known = pc.fill_null(pc.index_in(k_words.flatten(), value_set=coded.dictionary), -1).to_numpy()
    word_ends = np.concatenate([[0], np.cumsum(pc.list_value_length(k_words).to_numpy())])
    meant = pc.struct_field(members, "meant").to_numpy()
    # per P group the places of its bets in the order of bets
    rank = np.empty(len(bets), np.int64)
    rank[pc.sort_indices(pa.table({"b": pc.struct_field(bets, "p_bet"), "e": pc.struct_field(bets, "p_event")}), sort_keys=[("b", "ascending"), ("e", "ascending")]).to_numpy()] = np.arange(len(bets))
    by_rank, count = np.argsort(rank), pc.list_value_length(p_bets).to_numpy()
    places = np.full((n, max(1, int(count.max(initial=0)))), -1, np.int64)
    owner_of_bet = np.repeat(np.arange(n), count)
    places[owner_of_bet, np.arange(len(bets)) - np.repeat(np.cumsum(count) - count, count)] = rank
    p_no, first = np.unique(ps["p_no"].to_numpy(), return_index=True)
    last = np.append(first[1:], n)
    fit_ends = np.concatenate([[0], np.cumsum(pc.list_value_length(k_fits).to_numpy())])
    codes, group_ends = k_fits.flatten().to_numpy(), np.concatenate([[0], np.cumsum(pc.list_value_length(k_groups).to_numpy())])
    plain, with_scope = ks["points"].to_numpy(), ks["points_scope"].to_numpy()
    for row in range(len(ks)):
        fit = codes[fit_ends[row] : fit_ends[row + 1]]
        where = np.minimum(np.searchsorted(p_no, fit >> 2), len(p_no) - 1)
        there = p_no[where] == fit >> 2 if n else np.zeros(len(fit), bool)
        fit, where = fit[there], where[there]
        if not len(fit):
            continue
        size = last[where] - first[where]
        mine = np.repeat(first[where] - np.cumsum(size) + size, size) + np.arange(size.sum())
        scope, several = np.repeat(fit >> 1 & 1, size) > 0, np.repeat(fit & 1, size)
        points = np.where(scope, with_scope[row], plain[row])
        for g in range(group_ends[row], group_ends[row + 1]):
            words = known[word_ends[g] : word_ends[g + 1]]
            runs = [owners[at[w] : at[w + 1]] for w in words.tolist() if w >= 0]
            important = sum(w >= 0 for w in words[: meant[g]].tolist())
            if not important:
                continue
            counts = np.bincount(np.concatenate(runs[:important]), minlength=n)
            shared = counts if important == len(runs) else counts + np.bincount(np.concatenate(runs[important:]), minlength=n)
            shared = shared[mine]
            good = np.flatnonzero((counts[mine] > 0) & ((shared >= 2) | scope))
            if not len(good):
                continue
            total = shared[good] + points[good]
            if len(good) > per_bet:  # each group has a bet
                enough = total >= np.partition(total, -per_bet)[-per_bet]
                good, total = good[enough], total[enough]
            place = places[mine[good]]
            keys = (total.max() - total)[:, None] * len(bets) + place
            real = np.flatnonzero(place.ravel() >= 0)
            keys = keys.ravel()[real]
            if len(keys) > per_bet:
                real = real[np.argpartition(keys, per_bet - 1)[:per_bet]]
            which = real // places.shape[1]
            group.append(np.full(len(which), g))
            bet.append(by_rank[place.ravel()[real]])
            score.append(total[which])
            both.append(several[good[which]])
    joined = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
    bet = joined(bet)
    return pa.table({
        "k_group": pc.struct_field(members, "k_group").take(pa.array(joined(group))), "candidate_type": pc.if_else(pa.array(joined(both) > 0), "outcome_outcome", "event_outcome"), "match_score": pa.array(joined(score), pa.int32()),
        "p_bet": pc.struct_field(bets, "p_bet").take(pa.array(bet)), "p_event": pc.struct_field(bets, "p_event").take(pa.array(bet)), "p_words": p_words.take(pa.array(owner_of_bet[bet])),
    })


def with_subject_count(df: DataFrame, event_col: str = "event_id", *more: str, key: str = "outcome_key") -> DataFrame:
    """Distinct outcome keys of each row's event; counted once per event, then joined back."""
    counts = df.groupBy(event_col, *more).agg(F.count_distinct(key).alias("event_subject_count"))
    return df.join(counts, [event_col, *more])


def top_candidates(df: DataFrame, keys: list[str], order: list[Column], n: int = 5) -> DataFrame:
    """The first n per key; the bound reaches the sort as a group limit."""
    return df.withColumn("rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(col("rn") <= n)


def nearest_outcomes(k: DataFrame, p: DataFrame, bound: int, n: int = 5) -> DataFrame:
    """Per K bet the first n P bets of its outcome key by (gap, P bet), gaps of whole sizes up to bound: (k_bet, p_bet, gap, rn).

    k has k_bet, outcome_key, ks; p has p_bet, outcome_key, ps.  P bets of one key and size have one gap to any K bet, so only their
    first n can be chosen, and K bets of one key and size choose alike: the join is between sizes, not between bets.
    """
    first = top_candidates(p.where("ps is not null"), ["outcome_key", "ps"], [F.asc("p_bet")], n).withColumn("_at", col("ps").cast("long")).drop("rn")
    sizes = k.where("ks is not null").select("outcome_key", "ks").distinct()
    size = col("ks").cast("long")
    near = sizes.withColumn("_at", F.explode(F.sequence(size - F.lit(bound), size + F.lit(bound)))).join(first, ["outcome_key", "_at"]).withColumn("gap", F.abs(col("ks") - col("ps")))
    best = top_candidates(near, ["outcome_key", "ks"], [F.asc("gap"), F.asc("p_bet")], n).select("outcome_key", "ks", "gap", "p_bet")
    return top_candidates(k.join(best, ["outcome_key", "ks"]), ["k_bet"], [F.asc("gap"), F.asc("p_bet")], n).select("k_bet", "p_bet", "gap", "rn")


BUNDLE_BYTES = 32 << 20  # of text that a task makes, about


def joined_bundles(k: DataFrame, p: DataFrame, on: list[str], kind: str) -> DataFrame:
    """G7 of the pairs that join on columns: (bundle_id, k_event, p_event, n, first_k, members: the P bets by K bet and P bet).

    k has k_event, k_bet and the columns, p has p_event, p_bet and the columns.  The P bets that a K bet has in an event are one
    text, made once for all K bets that join them, so what is shuffled is groups of bets, not pairs.
    """
    once = Window.partitionBy("k_event", "k_bet")
    k = k.withColumn("_n", F.count(F.lit(1)).over(once))
    texts = p.groupBy("p_event", *on).agg(F.sort_array(F.collect_list("p_bet")).alias("_ps"))
    texts = texts.select("p_event", *on, F.size("_ps").alias("_size"), F.array_join(F.transform("_ps", lambda b: b.cast("string")), ",").alias("_text"))
    groups = k.where("_n = 1").groupBy("k_event", *on).agg(F.collect_list("k_bet").alias("_ks")).join(texts, on)
    groups = groups.select("k_event", "p_event", "_ks", (F.size("_ks") * col("_size")).cast("long").alias("_pairs"), F.lit(None).cast(p.schema["p_bet"].dataType).alias("_p"), "_text")
    # K bets that an event has more than once: their P bets stand in one order over all of their rows
    again = k.where("_n > 1").join(p, on).select("k_event", "p_event", F.array("k_bet").alias("_ks"), F.lit(1).cast("long").alias("_pairs"), col("p_bet").alias("_p"), col("p_bet").cast("string").alias("_text"))
    parts = written(groups.unionByName(again), "bundle_parts")
    out_bytes = parts.agg(F.coalesce(F.sum(F.size("_ks") * (F.length("_text") + 1).cast("long")), F.lit(0))).first()[0]
    # a bundle's text can have megabytes, and Parquet holds a hundred rows before it looks at their size: few bundles a task
    parts = parts.repartition(max(_tasks(k), -(-out_bytes // BUNDLE_BYTES)), "k_event", "p_event")
    found = parts.groupBy("k_event", "p_event").agg(F.sum("_pairs").alias("n"), F.collect_list(F.struct("_ks", "_p", "_text")).alias("_members"))
    entries = F.flatten(F.transform("_members", lambda m: F.transform(m["_ks"], lambda b: F.struct(b.alias("k"), m["_p"].alias("p"), m["_text"].alias("text")))))
    found = found.select("k_event", "p_event", "n", F.sort_array(entries).alias("_members"))
    key = F.concat_ws("|", F.lit(kind), "k_event", "p_event")
    return found.select(
        F.substring(F.sha2(key, 256), 1, 20).alias("bundle_id"), "k_event", "p_event", "n", col("_members")[0]["k"].alias("first_k"), F.array_join(F.transform("_members", lambda m: m["text"]), ",").alias("members")
    )


def bundles(pairs: DataFrame, member_order: list[str], type_col: str = "candidate_type") -> DataFrame:
    """One row per (type, K event, P event) with its sorted members and a stable id."""
    others = [c for c in pairs.columns if c not in {type_col, "k_event", "p_event", *member_order}]
    member = F.struct(*member_order, *others)
    grouped = pairs.groupBy(type_col, "k_event", "p_event").agg(F.array_sort(F.collect_list(member)).alias("members"))
    key = F.concat_ws("|", type_col, "k_event", "p_event")
    return grouped.withColumn("bundle_id", F.substring(F.sha2(key, 256), 1, 20)).withColumn("size", F.size("members").cast("long"))
