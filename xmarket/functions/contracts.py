"""What a contract's text says (X30, X32, X40, X41) and when two contracts can't be one."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from xmarket.functions.text import compact_text, safe_text, strings

_MONTH = "(?:jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)"


def parse_month_day_year(c: Column) -> Column:
    """`Mar 5, 2026`, `March 5 2026` and the like as yyyy-MM-dd; null if unreadable."""
    text = F.initcap(F.regexp_replace(F.regexp_replace(F.trim(c), r"(?<=\d)(?:st|nd|rd|th)", ""), r"[.,]", ""))
    text = F.regexp_replace(text, r"^Sept ", "Sep ")
    return F.date_format(F.coalesce(F.try_to_date(text, "MMM d yyyy"), F.try_to_date(text, "MMMM d yyyy")), "yyyy-MM-dd")


def deadline(*texts: Column) -> Column:
    """The first text that names a date, a date after by, before or on first; empty if none."""
    date = rf"({_MONTH}\.?\s+\d{{1,2}}(?:st|nd|rd|th)?,?\s+20\d\d)"
    found = []
    for lead in (r"\b(?:by|before|on|until)\s+", r"\b"):
        found += [parse_month_day_year(F.nullif(F.regexp_extract(F.coalesce(t, F.lit("")), f"(?i){lead}{date}", 1), F.lit(""))) for t in texts]
    return F.coalesce(*found, F.lit(""))


def day_threshold(c: Column) -> Column:
    """The number of days, empty if none."""
    return F.regexp_extract(F.coalesce(c, F.lit("")), r"(?i)\b(\d+)\+?\s+days?\b", 1)


def percent_threshold(c: Column) -> Column:
    """X41."""
    return F.regexp_extract(F.coalesce(c, F.lit("")), r"(?i)\b(\d+(?:\.\d+)?)\s*(?:%|percent\b)", 1)


def is_numeric_bucket(c: Column) -> Column:
    """Titles that are a number or a range of numbers."""
    return F.trim(F.coalesce(c, F.lit(""))).rlike(r"(?i)^(?:[<>≤≥]|at least|at most|under|over|above|below)?\s*\$?\d[\d,.]*\s*(?:%|k|m|bn?)?(?:\s*(?:-|–|to)\s*\$?\d[\d,.]*\s*(?:%|k|m|bn?)?|\+|\s+or (?:more|less|above|below))?$")


def bet_text(*columns: Column) -> Column:
    """All texts of a contract, one space between."""
    return F.trim(F.regexp_replace(F.concat_ws(" ", *(safe_text(c) for c in columns)), r"\s+", " "))


def detail(title: Column, description: Column, limit: int = 300) -> Column:
    """A contract's line for a prompt."""
    return F.concat_ws(" | ", safe_text(title), F.nullif(compact_text(description, limit), F.lit("")))


def first_year(c: Column) -> Column:
    """X32."""
    return F.regexp_extract(F.coalesce(c, F.lit("")), r"\b(20\d{2})\b", 1)


def numbers(c: Column) -> Column:
    """X32."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"(\d+(?:\.\d+)?)"), F.lit(1))))


def hard_conflict(k: dict[str, Column], p: dict[str, Column]) -> Column:
    """Different days or percents where both say one, or deadlines more than a day apart."""
    differ = lambda a, b: (a != "") & (b != "") & (a != b)
    gap = F.abs(F.datediff(F.to_date(F.nullif(k["deadline"], F.lit(""))), F.to_date(F.nullif(p["deadline"], F.lit("")))))
    return differ(k["days"], p["days"]) | differ(k["percent"], p["percent"]) | F.coalesce(gap > 1, F.lit(False))


def needs_second_check(k_title: Column, p_title: Column, similarity: Column, k_deadline: Column, p_deadline: Column) -> Column:
    """Titles that differ much, numbers that differ, one-sided deadlines; equal titles and buckets are fine."""
    same = F.lower(F.trim(k_title)) == F.lower(F.trim(p_title))
    one_sided = (k_deadline == "") != (p_deadline == "")
    return ~same & (one_sided | (numbers(k_title) != numbers(p_title)) | (similarity < 0.72) | (is_numeric_bucket(k_title) != is_numeric_bucket(p_title)))


CRITICAL = (r"\b(?:resolves?|resolution)\b", r"\b(?:by|before|deadline|no later than)\b", r"\b(?:except|unless|excluding|not include)\b", r"\d")


def relevant_sentences(text: Column, terms: Column, max_chars: int) -> Column:
    """The sentences with most term hits and critical words, at most max_chars, in their own order.

    Sentences are ranked by score, then shorter, then earlier; filling stops at four fifths of the room.
    """
    parts = F.filter(F.split(F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " ")), r"(?<=[.!?;])\s+"), lambda s: s != "")
    hits = lambda s: F.size(F.filter(terms, lambda t: F.lower(s).contains(F.lower(t))))
    critical = lambda s: sum((F.when(s.rlike("(?i)" + p), F.lit(1)).otherwise(F.lit(0)) for p in CRITICAL), F.lit(0))
    ranked = F.array_sort(F.transform(parts, lambda s, i: F.struct((-(5 * hits(s) + critical(s))).alias("k"), F.length(s).alias("n"), i.alias("i"), s.alias("s"))))
    empty = F.struct(F.lit(0).alias("used"), F.array().cast("array<struct<i:int,s:string>>").alias("kept"))
    fits = lambda acc, x: (acc["used"] < max_chars * 0.8) & (acc["used"] + x["n"] <= max_chars)
    step = lambda acc, x: F.when(fits(acc, x), F.struct((acc["used"] + x["n"] + 1).alias("used"), F.concat(acc["kept"], F.array(F.struct(x["i"].alias("i"), x["s"].alias("s")))).alias("kept"))).otherwise(acc)
    chosen = F.aggregate(ranked, empty, step)
    return F.array_join(F.transform(F.array_sort(chosen["kept"]), lambda x: x["s"]), " ")


def rank_contracts(contracts: Column, own_id: Column, terms: Column, most: int = 4) -> Column:
    """Contracts (bet_id, title) with the own bet first, then those that share terms, most shared first."""
    shared = lambda c: F.size(F.array_intersect(F.split(F.lower(c["title"]), r"[^a-z0-9]+"), terms))
    kept = F.filter(contracts, lambda c: (c["bet_id"] == own_id) | (shared(c) > 0))
    order = F.transform(kept, lambda c: F.struct(F.when(c["bet_id"] == own_id, 0).otherwise(1).alias("a"), (-shared(c)).alias("b"), c["bet_id"].alias("bet_id"), c["title"].alias("title")))
    return F.slice(F.transform(F.array_sort(order), lambda c: F.struct(c["bet_id"].alias("bet_id"), c["title"].alias("title"))), 1, most)


def parsed_answers(c: Column) -> Column:
    """Numbered lines `N. yes` or `N. no` of an answer as (number, yes) structs."""
    pattern = r"(?im)^\s*(\d+)[.):]\s*(yes|no)\b"
    zipped = F.arrays_zip(F.regexp_extract_all(c, F.lit(pattern), F.lit(1)).alias("n"), F.regexp_extract_all(c, F.lit(pattern), F.lit(2)).alias("a"))
    return F.transform(zipped, lambda z: F.struct(z["n"].cast("int").alias("number"), (F.lower(z["a"]) == "yes").alias("yes")))


__all__ = ["bet_text", "day_threshold", "deadline", "detail", "first_year", "hard_conflict", "is_numeric_bucket", "needs_second_check", "numbers", "parse_month_day_year", "parsed_answers", "percent_threshold", "rank_contracts", "relevant_sentences", "strings"]
