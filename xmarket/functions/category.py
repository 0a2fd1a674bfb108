"""Category algebra (X42 to X44) as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from xmarket.functions import lexicon as lx
from xmarket.functions.text import is_missing, label_key, literal_map, overlaps, strings



def expand_term(c: Column) -> Column:
    """A term with its aliases, one hop; nothing for a missing term."""
    term = label_key(c)
    aliases = F.split(F.coalesce(F.element_at(literal_map(lx.CATEGORY_ALIASES), term), F.lit("")), r"\|")
    extra = F.array_compact(
        F.array(
            *(F.when(term.endswith(" primary"), F.lit(x)) for x in ("primaries", "primary elections")),
            *(F.when(term.contains("governor") & term.contains("primary"), F.lit(x)) for x in ("governor", "primaries")),
            *(F.when(term.contains("senate") & term.contains("primary"), F.lit(x)) for x in ("senate", "primaries")),
            *(F.when(term.isin("house primary", "congressional primary"), F.lit(x)) for x in ("house", "congress", "primaries")),
        )
    )
    every = F.array_distinct(F.concat(F.array(term), aliases, extra))
    return F.when(term == "n/a", F.array().cast("array<string>")).otherwise(F.filter(every, lambda t: ~t.isin("", "n/a")))


def split_tags(c: Column) -> Column:
    """Every comma-separated tag, expanded."""
    tags = F.split(F.coalesce(c, F.lit("")), ",")
    return F.when(is_missing(c), F.array().cast("array<string>")).otherwise(F.array_distinct(F.flatten(F.transform(tags, expand_term))))


def terms(category: Column, sub_category: Column) -> Column:
    """All terms of a category and its tags, sorted; for either venue."""
    return F.array_sort(F.array_union(expand_term(category), split_tags(sub_category)))


def k_key(category: Column, sub_category: Column) -> Column:
    """The key of a K category."""
    return F.concat(label_key(category), F.lit(" / "), label_key(sub_category))


def split_key(key: Column) -> tuple[Column, Column]:
    """The two parts of a K key."""
    text = label_key(key)
    at = F.instr(text, " / ")
    second = F.when(at > 0, label_key(F.substring(text, at + 3, F.length(text)))).otherwise(F.lit("n/a"))
    return F.when(at > 0, label_key(F.substring(text, F.lit(1), at - 1))).otherwise(text), second


def normalized_mapping(mapping: dict[str, list[str]]) -> dict[str, list[str]]:
    """The mapping with normal keys and expanded values; a small table on the driver."""

    def key(text: str) -> str:
        text = " ".join(text.split()).lower()
        return "n/a" if text in lx.MISSING_LITERALS else text

    def expand(text: str) -> set[str]:
        term = key(text)
        if term == "n/a":
            return set()
        out = {term, *filter(None, lx.CATEGORY_ALIASES.get(term, "").split("|"))}
        out |= {"primaries", "primary elections"} if term.endswith(" primary") else set()
        out |= {"governor", "primaries"} if "governor" in term and "primary" in term else set()
        out |= {"senate", "primaries"} if "senate" in term and "primary" in term else set()
        return out | ({"house", "congress", "primaries"} if term in ("house primary", "congressional primary") else set())

    out: dict[str, list[str]] = {}
    for raw, values in mapping.items():
        first, _, second = raw.partition(" / ")
        out[f"{key(first)} / {key(second)}"] = sorted(set().union(*map(expand, values)) if values else set())
    return out


def resolve(keys: DataFrame, mapping: dict[str, list[str]], available: list[str] | None = None, key_col: str = "k_key") -> DataFrame:
    """For each distinct K key the P keys to block on, and how they were found.

    Runs on distinct categories, not on events.  Modes, in order: exact_broad, exact_specific or
    inferred_specific, exact_broad, broad_fallback, unmapped.
    """
    table = normalized_mapping(mapping)
    lookup = F.create_map(*(x for k, v in table.items() for x in (F.lit(k), strings(v)))) if table else F.create_map().cast("map<string,array<string>>")
    category, sub = split_key(F.col(key_col))
    there = (lambda a: F.array_intersect(a, strings(available))) if available is not None else (lambda a: a)
    broad = lambda a: F.filter(a, lambda t: t.isin(*lx.BROAD_CATEGORIES))
    specific = lambda a: F.filter(a, lambda t: ~t.isin(*lx.BROAD_CATEGORIES))
    empty = F.array().cast("array<string>")
    df = keys.withColumn("_c", category).withColumn("_s", sub).withColumn("_full", F.concat("_c", F.lit(" / "), "_s"))
    df = df.withColumn("_exact", F.element_at(lookup, F.col("_full"))).withColumn("has_exact", F.col("_exact").isNotNull()).withColumn("_exact", F.coalesce("_exact", empty))
    df = df.withColumn("_asked", specific(F.array_union("_exact", F.when(F.col("_s") == "n/a", empty).otherwise(split_tags(F.col("_s"))))))
    df = df.withColumn("_broad", broad(F.col("_exact"))).withColumn("_found", there(F.col("_asked")))
    parents = F.array_union(F.array_union(F.coalesce(F.element_at(lookup, F.concat("_c", F.lit(" / n/a"))), empty), F.col("_broad")), expand_term(F.col("_c")))
    df = df.withColumn("_first", there(F.col("_broad"))).withColumn("_fallback", there(broad(parents)))
    df = df.withColumn("_third", there(F.when(F.size("_broad") > 0, F.col("_broad")).otherwise(F.col("_exact"))))
    head = F.col("has_exact") & (F.col("_s") == "n/a") & (F.size("_broad") > 0)
    some = lambda c: F.size(c) > 0
    third = F.col("has_exact") & (F.size("_asked") == 0) & some("_third")
    mode = (
        F.when(head, F.when(some("_first"), "exact_broad").otherwise("unmapped"))
        .when(some("_found"), F.when(F.col("has_exact"), "exact_specific").otherwise("inferred_specific"))
        .when(third, "exact_broad")
        .when(some("_fallback"), "broad_fallback")
        .otherwise("unmapped")
    )
    chosen = F.when(head, F.col("_first")).when(some("_found"), F.col("_found")).when(third, F.col("_third")).otherwise(F.col("_fallback"))
    asked = F.when(head | (~some("_found") & third), empty).otherwise(F.col("_asked"))
    return df.withColumn("mode", mode).withColumn("keys", F.array_sort(chosen)).withColumn("requested", F.array_sort(asked)).drop(*(c for c in df.columns if c.startswith("_")))


def categories_overlap(k_terms: Column, p_terms: Column) -> Column:
    """Shared terms, or both in one group of compatible categories."""
    out = overlaps(k_terms, p_terms)
    for group in lx.COMPATIBLE_CATEGORIES:
        out = out | (overlaps(k_terms, strings(group)) & overlaps(p_terms, strings(group)))
    return out
