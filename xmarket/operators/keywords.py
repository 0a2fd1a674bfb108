"""Keywords and signatures of events, and consolidation of keyword dictionaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from xmarket.functions import lexicon as lx
from xmarket.functions.text import canonical_keyword, is_noise_keyword, literal_map, mentions, strings
from xmarket.operators.graph import connected_components

col = F.col
# Club names that are common words elsewhere count as clubs in sports titles only, and sports words.
CLUBS = {"city": "manchester city", "united": "manchester united", "arsenal": "arsenal fc", "chelsea": "chelsea fc", "real": "real madrid", "inter": "inter milan"}
SPORT_WORDS = ("sports", "soccer", "football", "basketball", "baseball", "hockey", "tennis", "cricket", "rugby", "golf", "mma", "boxing", "esports")


def is_sports_context(title: Column, category: Column, sub_category: Column) -> Column:
    """The title has a versus, or the category names a sport."""
    versus = F.coalesce(title, F.lit("")).rlike(r"(?i)\bvs?\.?\b")
    return versus | F.lower(F.concat_ws(" ", category, sub_category)).rlike(r"\b(?:" + "|".join(SPORT_WORDS) + r")\b")


def tokens(title: Column) -> Column:
    """Words and hyphenated words of a title, lower case."""
    return F.filter(F.split(F.regexp_replace(F.lower(F.coalesce(title, F.lit(""))), r"[^a-z0-9$%&'.-]+", " "), " "), lambda w: w != "")


def structured(title: Column) -> Column:
    """Year:, district: and group: keywords."""
    t = F.coalesce(title, F.lit(""))
    tag = lambda name, pattern, change: F.transform(F.regexp_extract_all(t, F.lit(pattern), F.lit(1)), lambda v: F.concat(F.lit(f"{name}:"), change(v)))
    groups = F.filter(F.regexp_extract_all(t, F.lit(r"(?i)\bgroup\s+([a-z0-9]+)\b"), F.lit(1)), lambda v: (F.length(v) == 1) | v.rlike("^[0-9]+$"))
    return F.array_distinct(F.concat(tag("year", r"\b(20[2-3][0-9])\b", lambda v: v), tag("district", r"(?i)\b([a-z]{2}-(?:\d{1,2}|al))\b", F.upper), F.transform(groups, lambda v: F.concat(F.lit("group:"), F.upper(v)))))


def with_singular(words: Column) -> Column:
    """Words and their singulars: ies to y, plain s off words of over four letters, -ss -us -is -as kept."""
    one = lambda w: F.when(w.rlike("(ss|us|is|as)$"), w).when(w.endswith("ies") & (F.length(w) > 5), F.concat(F.substring(w, F.lit(1), F.length(w) - 3), F.lit("y"))).when(w.endswith("s") & (F.length(w) > 4), F.substring(w, F.lit(1), F.length(w) - 1)).otherwise(w)
    plain = F.filter(words, lambda w: ~w.contains(":"))
    places = strings(["texas", "kansas", "arkansas", "united states", "paris"])
    return F.array_distinct(F.concat(words, F.transform(F.filter(plain, lambda w: ~F.array_contains(places, w)), one)))


def extract_keywords(title: Column, category: Column, sub_category: Column, lexicon: lx.Lexicon) -> Column:
    """Sorted canonical keywords of a title: surviving tokens, named entities, structured ones, singulars.

    Club nicknames become clubs in sports contexts alone; entity recognisers may add an array before this.
    """
    sports = is_sports_context(title, category, sub_category)
    clubs = literal_map(CLUBS)
    words = F.transform(tokens(title), lambda w: F.regexp_replace(F.regexp_replace(w, r"'s$", ""), r"^[.'-]+|[.'-]+$", ""))
    canonical = F.transform(words, lambda w: F.coalesce(F.when(sports, F.element_at(clubs, w)), canonical_keyword(w, lexicon)))
    kept = F.filter(canonical, lambda w: ~is_noise_keyword(w, lexicon))
    named = mentions(title, lexicon.alias_map())
    return F.array_sort(F.array_distinct(F.concat(with_singular(F.array_union(kept, F.filter(named, lambda w: ~is_noise_keyword(w, lexicon)))), structured(title))))


def signature(title: Column, category: Column, lexicon: lx.Lexicon) -> Column:
    """Typed tokens of an event: YEAR, CAT, QUOTE, PCT, entity labels and remaining words as HPW."""
    t = F.coalesce(title, F.lit(""))
    tag = lambda name, values: F.transform(values, lambda v: F.concat(F.lit(f"{name}:"), v))
    years = F.regexp_extract_all(t, F.lit(r"\b(20[2-3][0-9])\b"), F.lit(1))
    quotes = F.transform(F.regexp_extract_all(t, F.lit(r"[\"“]([^\"”]+)[\"”]"), F.lit(1)), lambda q: F.lower(F.trim(q)))
    percents = F.regexp_extract_all(t, F.lit(r"(\d+(?:\.\d+)?)\s*%"), F.lit(1))
    words = F.filter(F.transform(tokens(t), lambda w: canonical_keyword(w, lexicon)), lambda w: ~is_noise_keyword(w, lexicon) & ~w.rlike("^[0-9.%$]+$"))
    cat = F.when(F.trim(F.coalesce(category, F.lit(""))) != "", F.array(F.concat(F.lit("CAT:"), F.lower(F.trim(category))))).otherwise(F.array().cast("array<string>"))
    return F.array_sort(F.array_distinct(F.concat(cat, tag("YEAR", years), tag("QUOTE", quotes), tag("PCT", percents), mentions(t, lexicon.domain_tokens()), tag("HPW", words))))


def signature_values(sig: Column, label: str) -> Column:
    """The values of one label."""
    return F.transform(F.filter(sig, lambda s: s.startswith(f"{label}:")), lambda s: F.substring(s, F.lit(len(label) + 2), F.length(s)))


def refresh_signatures(events: DataFrame, cached: DataFrame, lexicon: lx.Lexicon) -> DataFrame:
    """X15, IO10: cached signatures plus those of events that the cache lacks."""
    todo = events.join(cached.select("event_id"), "event_id", "left_anti")
    fresh = todo.select("event_id", signature(col("title"), col("category"), lexicon).alias("signature"))
    return cached.select("event_id", "signature").unionByName(fresh)


def outcome_tokens(c: Column, lexicon: lx.Lexicon, multiword: list[str] | None = None) -> Column:
    """X11: tokens of an outcome phrase: no stop words, over one letter, aliases, and phrases kept whole."""
    text = F.concat(F.lit(" "), c, F.lit(" "))
    words = F.filter(F.split(c, " "), lambda w: (F.length(w) > 1) & ~w.isin(*lexicon.stop_words))
    plain = F.transform(words, lambda w: F.coalesce(F.element_at(literal_map({"ipos": "ipo"}), w), w))
    whole = F.array_compact(F.array(*(F.when(text.contains(f" {m} "), F.lit(m)) for m in multiword))) if multiword else F.array().cast("array<string>")
    groups = F.transform(F.regexp_extract_all(c, F.lit(r"\bgroup ([a-z0-9])\b"), F.lit(1)), lambda v: F.concat(F.lit("group "), v))
    return F.array_sort(F.array_distinct(F.concat(plain, whole, groups)))


def cleanup_title_tokens(title: Column) -> Column:
    """Title words without stop words and digits."""
    words = F.split(F.trim(F.regexp_replace(F.lower(F.coalesce(title, F.lit(""))), "[^a-z]+", " ")), " ")
    return F.array_sort(F.array_distinct(F.filter(words, lambda w: (F.length(w) > 1) & ~w.isin(*lx.TITLE_STOP_WORDS))))


def name_variants(name: Column) -> Column:
    """A name, its last word if it has several, and its initials from three words on; lower case."""
    plain = F.trim(F.regexp_replace(F.lower(name), r"[^a-z0-9 ]+", " "))
    words = F.filter(F.split(plain, " +"), lambda w: w != "")
    last = F.when((F.size(words) > 1) & (F.length(F.element_at(words, -1)) > 3), F.element_at(words, -1))
    initials = F.when(F.size(words) >= 3, F.array_join(F.transform(words, lambda w: F.substring(w, 1, 1)), ""))
    return F.array_distinct(F.array_compact(F.array(F.array_join(words, " "), last, initials)))


def consolidate(entries: DataFrame, name_col: str = "name", kind_col: str = "kind", source_col: str = "source") -> DataFrame:
    """One row per entity: the longest form, all variants, kinds and sources.

    Entries of one kind that share a variant are one entity, however long the chain; a single word that belongs to
    full names of different last parts would chain them, so single words that stand in several full names are
    left out of the joining.  Files merge in any order with the same result.
    """
    rows = entries.select(col(name_col).alias("name"), col(kind_col).alias("kind"), col(source_col).alias("source"), F.explode(name_variants(col(name_col))).alias("variant"))
    full = F.count_distinct(F.when(F.instr(F.trim("name"), " ") > 0, F.lower(F.trim("name"))))
    ambiguous = rows.where(F.instr("variant", " ") == 0).groupBy("kind", "variant").agg(full.alias("n")).where("n > 1").select("kind", "variant")
    joining = rows.join(ambiguous, ["kind", "variant"], "left_anti")
    node, hub = F.concat_ws("|", F.lit("n"), "kind", F.lower("name")), F.concat_ws("|", F.lit("v"), "kind", "variant")
    parts = connected_components(joining.select(node.alias("src"), hub.alias("dst")))
    labelled = rows.withColumn("_node", node).join(parts, col("_node") == col("node"), "left").withColumn("_c", F.coalesce("component", "_node"))
    longest = F.max_by("name", F.struct(F.length("name"), F.lower("name")))
    return labelled.groupBy("_c", "kind").agg(longest.alias("canonical"), F.array_sort(F.collect_set("variant")).alias("variants"), F.array_sort(F.collect_set("source")).alias("sources")).drop("_c")
