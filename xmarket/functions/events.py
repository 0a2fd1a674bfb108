"""What a title says: extractors of the event profile (X23 to X29) and of the rejecting rules.

All are Column expressions over one title; they run once per event, before any join of pairs.  Sets are sorted
arrays without repeats.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from xmarket.functions import lexicon as lx
from xmarket.functions.text import (
    canonical_keyword, canonical_phrase, has_term, let, literal_map, mentions, named, overlaps, profile_text, stable_key, strings,
)

_MONTH = "(?:jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)"
_DATE = rf"(?i)\b({_MONTH})\.?\s+(\d{{1,2}})(?:st|nd|rd|th)?(?:,?\s*(20[2-3][0-9]))?\b"
_PLACE = r"([A-Z][A-Za-z.'-]*(?:\s+[A-Z][A-Za-z.'-]*){0,3})\b"


def _set(a: Column) -> Column:
    return F.array_sort(F.array_distinct(a))


def _all(c: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(c, F.lit(pattern), F.lit(group))


def _month_number(name: Column) -> Column:
    return F.element_at(literal_map({m[:3]: f"{i:02d}" for i, m in enumerate(lx.MONTHS, 1)}), F.substring(F.lower(name), 1, 3))


def years(c: Column) -> Column:
    """X23."""
    return _set(_all(c, r"\b(20[2-3][0-9])\b"))


def seasons(c: Column) -> Column:
    """2025-26 and 2025/2026 alike, as 2025-2026."""
    pattern = r"\b(20\d{2})\s*[-/]\s*(\d{2,4})\b"
    whole = F.arrays_zip(_all(c, pattern, 1).alias("a"), _all(c, pattern, 2).alias("b"))
    return _set(F.transform(whole, lambda p: F.concat(p["a"], F.lit("-"), F.when(F.length(p["b"]) == 2, F.concat(F.substring(p["a"], 1, 2), p["b"])).otherwise(p["b"]))))


def dates(c: Column) -> Column:
    """Yyyy-mm-dd with ???? for an unsaid year."""
    z = F.arrays_zip(_all(c, _DATE, 1).alias("m"), _all(c, _DATE, 2).alias("d"), _all(c, _DATE, 3).alias("y"))
    return _set(F.transform(z, lambda p: F.concat_ws("-", F.when(p["y"] == "", F.lit("????")).otherwise(p["y"]), _month_number(p["m"]), F.lpad(p["d"], 2, "0"))))


def periods(c: Column) -> Column:
    """Months and quarters, yyyy-mm and yyyy-Qn."""
    month, quarter = rf"(?i)\b({_MONTH})\b\.?\s*(20[2-3][0-9])?", r"(?i)\b(Q[1-4])\b\s*(20[2-3][0-9])?"
    year = lambda y: F.when(y == "", F.lit("????")).otherwise(y)
    m = F.arrays_zip(_all(c, month, 1).alias("m"), _all(c, month, 2).alias("y"))
    q = F.arrays_zip(_all(c, quarter, 1).alias("q"), _all(c, quarter, 2).alias("y"))
    return _set(F.concat(F.transform(m, lambda p: F.concat_ws("-", year(p["y"]), _month_number(p["m"]))), F.transform(q, lambda p: F.concat_ws("-", year(p["y"]), F.upper(p["q"])))))


def groups(c: Column) -> Column:
    """A single letter or a number after the word group."""
    found = F.transform(_all(c, r"(?i)\bgroup\s+([a-z0-9]+)\b"), lambda v: F.lower(v))
    return _set(F.filter(found, lambda v: (F.length(v) == 1) | v.rlike("^[0-9]+$")))


def districts(c: Column) -> Column:
    """State and number, upper case."""
    return _set(F.transform(_all(c, r"(?i)\b([a-z]{2}-(?:\d{1,2}|al))\b"), lambda v: F.upper(v)))


def locations(c: Column) -> Column:
    """Capitalised places after the phrases that announce one."""
    found = F.concat(*(_all(c, rf"\b{lead} {_PLACE}") for lead in ("temperature in", "mayor of", "(?:election|race) in", "governor of")))
    plain = F.transform(found, lambda v: F.trim(F.regexp_replace(canonical_phrase(v), r"\b(?:on|by|before|after|during)\b.*$", "")))
    return _set(F.filter(plain, lambda v: ~v.isin("", "the", "united states")))


def thresholds(c: Column) -> Column:
    """Number:unit, where the text speaks of a direction or a measure; years are left out."""
    pattern = r"\b(\d+(?:\.\d+)?)\s*(%|percent|bps|points?|degrees?|usd|dollars?)?"
    number = lambda n: F.regexp_replace(F.when(n.contains("."), F.regexp_replace(n, "0+$", "")).otherwise(n), r"\.$", "")
    bare = lambda n: F.regexp_replace(number(n), "^0+(?=[0-9])", "")

    def of(text: Column) -> Column:
        z = F.filter(F.arrays_zip(_all(text, pattern, 1).alias("n"), _all(text, pattern, 2).alias("u")), lambda p: ~p["n"].rlike("^20[2-3][0-9]$"))
        found = F.transform(z, lambda p: F.concat_ws(":", bare(p["n"]), F.when(p["u"] == "", F.lit("number")).otherwise(p["u"])))
        speaks = (F.size(named(text, lx.DIRECTIONS)) > 0) | text.rlike("%|price|rate|score|temperature")
        return F.when(speaks, _set(found)).otherwise(F.array().cast("array<string>"))

    return let(profile_text(c), of)


_VERSUS = r"(?i)^(.*?)\s+(?:vs\.?|v\.?|at|@)\s+(.*?)$"


def fixture_text(c: Column) -> Column:
    """The part of a title that names a fixture, without a lead and without the market layer after it."""
    text = F.trim(F.coalesce(c, F.lit("")))
    tail = F.regexp_extract(text, r"^[^:]*:(.*)$", 1)
    text = F.when(tail.rlike(r"(?i)\b(?:vs\.?|v\.?|at|@)\b"), tail).otherwise(text)
    return F.trim(F.regexp_replace(text, r"(?i)\s+-\s+(?:more markets|half[ -]?time|exact score|first half|1st half|team props?|spread|total).*$", ""))


def participants(c: Column) -> Column:
    """The two sides of a fixture, or nothing."""

    def of(text: Column) -> Column:
        sides = F.array(canonical_phrase(F.regexp_extract(text, _VERSUS, 1)), canonical_phrase(F.regexp_extract(text, _VERSUS, 2)))
        kept = lambda k: F.when(F.size(k) == 2, k).otherwise(F.array().cast("array<string>"))
        return F.when(text.rlike(_VERSUS), let(_set(F.filter(sides, lambda x: x != "")), kept)).otherwise(F.array().cast("array<string>"))

    return let(fixture_text(c), of)


def _name_tokens(c: Column) -> Column:
    words = F.filter(F.split(c, " "), lambda w: ~w.isin("", *lx.PARTICIPANT_NOISE))
    return F.array_distinct(F.transform(words, lambda w: F.when(w == "st", F.lit("state")).otherwise(w)))


def same_participant(a: Column, b: Column) -> Column:
    """Equal, one's tokens within the other's, two or more shared at .66 of the smaller, or a common beginning."""

    def of(pair: Column) -> Column:
        left, right = pair["l"], pair["r"]
        shared, least = F.size(F.array_intersect(left, right)), F.least(F.size(left), F.size(right))
        begins = F.exists(left, lambda x: F.exists(right, lambda y: (F.length(x) >= 3) & (F.length(y) >= 3) & (x.startswith(y) | y.startswith(x))))
        return (least > 0) & F.when(shared == 0, begins).otherwise((shared == least) | ((shared >= 2) & (shared / least >= 0.66)))

    return (a == b) | let(F.struct(_name_tokens(a).alias("l"), _name_tokens(b).alias("r")), of)


def same_participants(a: Column, b: Column) -> Column:
    """Two fixtures with the same sides, in either order."""
    at = F.try_element_at
    x1, x2, y1, y2 = at(a, F.lit(1)), at(a, F.lit(2)), at(b, F.lit(1)), at(b, F.lit(2))
    two = (same_participant(x1, y1) & same_participant(x2, y2)) | (same_participant(x1, y2) & same_participant(x2, y1))
    return F.coalesce((F.size(a) == 2) & (F.size(b) == 2) & two, F.lit(False))


def entities(title: Column, keywords: Column, lexicon: lx.Lexicon) -> Column:
    """Domain entities named in the title, and keywords of several words or with digits."""
    tokens = F.transform(mentions(title, lexicon.domain_tokens()), canonical_phrase)
    phrases = F.transform(F.coalesce(keywords, F.array().cast("array<string>")), canonical_phrase)
    generic = strings(lx.GENERIC_ENTITY_TERMS)
    kept = F.filter(phrases, lambda p: (p != "") & ~p.startswith("year ") & (F.size(F.array_except(F.split(p, " "), generic)) > 0) & p.rlike("[ 0-9]"))
    return _set(F.filter(F.array_union(tokens, kept), lambda p: p != ""))


def _prefixed(name: str, c: Column) -> Column:
    return F.transform(c, lambda v: F.concat(F.lit(f"{name}:"), v))


def profiles(df: DataFrame, lexicon: lx.Lexicon) -> DataFrame:
    """The event profile beside the columns event_id, platform, title, category, sub_category, keywords, bet_titles."""
    context = F.when(F.size("bet_titles") == 1, F.element_at("bet_titles", 1)).otherwise(F.lit(""))
    out = df.withColumn("context_title", F.coalesce(context, F.lit(""))).withColumn("_text", F.trim(F.concat_ws(" ", F.coalesce("title", F.lit("")), "context_title")))
    text = F.col("_text")
    out = out.withColumn("_plain", profile_text(text)).withColumn("_cat", canonical_keyword(F.col("category"), lexicon)).withColumn("_sub", canonical_keyword(F.col("sub_category"), lexicon))
    for name, fn in (("years", years), ("seasons", seasons), ("dates", dates), ("periods", periods), ("groups", groups), ("districts", districts), ("locations", locations), ("thresholds", thresholds)):
        out = out.withColumn(name, fn(text))
    for name, table in (("stages", lx.STAGES), ("market_layers", lx.LAYERS), ("actions", lx.ACTIONS), ("directions", lx.DIRECTIONS), ("_scopes", lx.SCOPES)):
        out = out.withColumn(name, named(F.col("_plain"), table))
    sports = (F.col("_cat") == "sports") | F.col("_sub").rlike("baseball|basketball|football|hockey|soccer|tennis")
    sides = let(participants(F.col("title")), lambda p: F.when(F.size(p) > 0, p).otherwise(participants(F.col("context_title"))))
    out = out.withColumn("participants", F.when(sports, sides).otherwise(F.array().cast("array<string>"))).withColumn("entities", entities(text, F.col("keywords"), lexicon))
    has = lambda c: F.size(c) > 0
    drop = F.array_compact(F.array(F.when(has("districts") | F.array_contains("_scopes", "seat"), F.lit("aggregate")), F.when(has("periods"), F.lit("annual_window"))))
    overall = F.array_contains("actions", "win") & F.array_contains("_scopes", "tournament") & ~has("groups") & ~has("participants") & ~F.array_contains("_scopes", "award")
    add = F.array_compact(F.array(F.when(has("participants"), F.lit("match")), F.when(has("groups"), F.lit("group")), F.when(overall, F.lit("overall"))))
    out = out.withColumn("scopes", _set(F.array_union(F.array_except("_scopes", drop), add))).withColumn("domain", canonical_phrase(F.concat_ws(" ", "_cat", "_sub")))
    occurrence = F.concat(
        F.array(F.concat(F.lit("domain:"), "domain")),
        *(_prefixed(n, F.col(c)) for n, c in (("participant", "participants"), ("entity", "entities"), ("district", "districts"), ("year", "years"), ("season", "seasons"), ("date", "dates"), ("period", "periods"), ("group", "groups"), ("stage", "stages"), ("location", "locations"))),
    )
    out = out.withColumn("occurrence_key", stable_key(occurrence))
    proposition = F.concat(
        F.array(F.concat(F.lit("occurrence:"), "occurrence_key")),
        *(_prefixed(n, F.col(c)) for n, c in (("scope", "scopes"), ("layer", "market_layers"), ("action", "actions"), ("direction", "directions"), ("threshold", "thresholds"))),
    )
    return out.withColumn("proposition_key", stable_key(proposition)).drop("_text", "_plain", "_cat", "_sub", "_scopes")


FIELDS = ("years", "seasons", "dates", "periods", "groups", "stages", "districts", "locations", "participants", "scopes", "market_layers", "actions", "directions", "thresholds")


# --- X31: what the rejecting rules look at ---


def quarter_years(c: Column) -> Column:
    return _set(F.transform(_all(F.lower(c), r"\b(q[1-4]\s+20[2-3][0-9])\b"), lambda v: F.regexp_replace(v, r"\s+", " ")))


def title_scopes(c: Column) -> Column:
    text = F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9 ]+", " ")
    patterns = {name: r"\b(?:" + "|".join(words) + r")\b" for name, words in lx.TITLE_SCOPES.items()}
    return named(text, patterns | {"top_finish": r"\btop\s+(?:\d+|four|five|ten)\b"})


def month_days(c: Column) -> Column:
    """mm-dd-yyyy, the year empty where unsaid."""
    z = F.arrays_zip(_all(c, _DATE, 1).alias("m"), _all(c, _DATE, 2).alias("d"), _all(c, _DATE, 3).alias("y"))
    return _set(F.transform(z, lambda p: F.concat_ws("-", _month_number(p["m"]), F.lpad(p["d"], 2, "0"), p["y"])))


def title_directions(c: Column) -> Column:
    return F.array_compact(F.array(F.when(has_term(c, lx.DOWN_TERMS), F.lit("down")), F.when(has_term(c, lx.UP_TERMS), F.lit("up"))))


def significant_numbers(c: Column) -> Column:
    """Numbers that are no years and no days of dates, in one spelling."""
    days = F.transform(month_days(c), lambda v: F.regexp_replace(F.substring(v, 4, 2), "^0", ""))
    plain = F.transform(_all(c, r"\b(\d+(?:\.\d+)?)\b"), lambda n: F.regexp_replace(F.when(n.contains("."), F.regexp_replace(F.regexp_replace(n, "0+$", ""), r"\.$", "")).otherwise(n), "^0+(?=[0-9])", ""))
    return _set(F.array_except(F.filter(plain, lambda n: ~n.rlike("^20[2-3][0-9]$")), days))


def speaks_of_threshold(c: Column) -> Column:
    return has_term(c, lx.THRESHOLD_TERMS) | F.coalesce(c, F.lit("")).contains("%")


def us_districts(c: Column) -> Column:
    return _set(F.filter(_all(F.lower(c), r"\b([a-z]{2}-(?:\d{1,2}|al))\b"), lambda v: F.substring(v, 1, 2).isin(*lx.STATES)))


def us_states(c: Column) -> Column:
    text = F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9 ]+", " ")
    by_name = named(text, {n: rf"\b{n}\b" for n in [*lx.STATES.values(), "district of columbia"]})
    by_code = F.transform(us_districts(c), lambda v: F.element_at(literal_map(lx.STATES), F.substring(v, 1, 2)))
    return _set(F.array_union(by_name, by_code))


def countries(c: Column) -> Column:
    text = F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9 ]+", " ")
    by_country: dict[str, list[str]] = {}
    for alias, name in lx.COUNTRIES.items():
        by_country.setdefault(name, []).append(alias)
    by_country["united states"].append(r"u\s*s")
    return named(text, {name: r"\b(?:" + "|".join(words) + r")\b" for name, words in by_country.items()})


def granularity(*columns: Column) -> tuple[Column, Column]:
    """(speaks of a match, speaks of a whole event) over all texts of an event."""
    joined = F.lower(F.concat_ws(" ", *columns))
    text = F.concat(F.lit(" "), F.trim(F.regexp_replace(joined, "[^a-z0-9 ]+", " ")), F.lit(" "))
    is_match = text.rlike(r" (?:match|game|maps?|bo1|bo3|bo5|vs) ") | F.regexp_replace(joined, "[^a-z0-9]+", "").contains("map")
    return is_match, text.rlike(r" (?:tournament|championship|champion|major|cup|open|season winner|season) ")


def sports_families(terms: Column, title: Column) -> Column:
    """Sports that the category terms or the title name."""
    text = F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(F.coalesce(title, F.lit(""))), "[^a-z0-9 ]+", " ")), F.lit(" "))
    by = lambda words: overlaps(terms, strings(words.split(","))) | text.rlike(r"\b(?:" + words.replace(",", "|") + r")\b")
    return F.array_compact(F.array(*(F.when(by(words), F.lit(name)) for name, words in sorted(lx.SPORTS.items()))))


def is_broad_question(c: Column) -> Column:
    text = F.trim(F.lower(F.coalesce(c, F.lit(""))))
    return text.startswith("who will") | text.rlike(r"^which\s+(?:people|persons?|candidates?|countries|companies|artists?|teams?|parties|states)\b")
