"""Text normalisation as Column expressions; everything runs inside whole-stage codegen unless it says otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from xmarket.functions import lexicon as lx


def literal_map(entries: dict[str, str]) -> Column:
    """A constant map column."""
    if not entries:
        return F.create_map().cast("map<string,string>")
    return F.create_map(*(F.lit(x) for pair in entries.items() for x in pair))


def strings(values) -> Column:
    return F.array(*(F.lit(v) for v in values)) if values else F.array().cast("array<string>")


def let(c: Column, fn) -> Column:
    """fn of a value that is worked out once, however often fn reads it (a lambda variable is bound, not written out)."""
    return F.element_at(F.transform(F.array(c), fn), 1)


def safe_text(c: Column) -> Column:
    """P10: null to empty, else trimmed."""
    return F.trim(F.coalesce(c.cast("string"), F.lit("")))


def squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def compact_text(c: Column, n: int) -> Column:
    """White space collapsed, and at most n characters, the last three dots if cut."""
    text = squeeze(safe_text(c))
    return F.when(F.length(text) > n, F.concat(F.rtrim(F.substring(text, 1, n - 3)), F.lit("..."))).otherwise(text)


def clean_id(c: Column) -> Column:
    """Without asterisks and a trailing .0."""
    return F.regexp_replace(F.trim(F.translate(safe_text(c), "*", "")), r"\.0$", "")


def is_missing(c: Column) -> Column:
    """Null or one of the literals that mean missing."""
    return c.isNull() | F.lower(F.trim(c)).isin(*lx.MISSING_LITERALS)


def label(c: Column, missing: str = "N/A") -> Column:
    """Squeezed text, or the missing label.  Input is taken as normalised to NFKC; see udf.nfkc."""
    return F.when(is_missing(c), F.lit(missing)).otherwise(squeeze(c))


def label_key(c: Column) -> Column:
    return F.lower(label(c))


def keyword_phrase(c: Column) -> Column:
    """The spelling under which keywords are looked up."""
    text = F.trim(F.lower(F.coalesce(c, F.lit(""))))
    text = F.translate(text, "’`", "''")
    text = F.regexp_replace(text, r"'s\b", "")
    text = F.replace(F.translate(text, "_", " "), F.lit("&"), F.lit(" and "))
    text = F.regexp_replace(text, r"\s+", " ")
    return F.regexp_replace(text, r"^[ .,!?;:\"()\[\]{}]+|[ .,!?;:\"()\[\]{}]+$", "")


def compact_key(c: Column) -> Column:
    """X3."""
    return F.regexp_replace(keyword_phrase(c), r"[^a-z0-9:%$+-]+", "")


def canonical_keyword(c: Column, lexicon: lx.Lexicon) -> Column:
    """The canonical phrase by exact spelling, then compact spelling, then itself."""
    table = literal_map(lexicon.alias_map())
    return let(keyword_phrase(c), lambda t: F.coalesce(F.element_at(table, t), F.element_at(table, F.regexp_replace(t, r"[^a-z0-9:%$+-]+", "")), t))


def is_noise_keyword(c: Column, lexicon: lx.Lexicon) -> Column:
    """F6."""
    noise = lexicon.noise()

    def test(text: Column) -> Column:
        bare = F.regexp_replace(text, r"[^a-z0-9]", "")
        listed = text.isin(*noise) | F.regexp_replace(text, r"[^a-z0-9:%$+-]+", "").isin(*noise)
        return (text == "") | listed | text.rlike("^[$€£¥]+$") | ((F.length(bare) < 3) & ~text.rlike("^[0-9]+$"))

    return let(canonical_keyword(c, lexicon), test)


def _quoted(word: str) -> str:
    return "".join("\\" + ch if ch in r".^$|?*+()[]{}\-&" else ch for ch in word)


def mentions(c: Column, entries: dict[str, str]) -> Column:
    """Sorted distinct values of the phrases that stand in the text with no letter or digit beside them."""
    if not entries:
        return F.array().cast("array<string>")
    hits = lambda text: F.array(*(F.when(text.rlike(f"(?<![a-z0-9]){_quoted(k)}(?![a-z0-9])"), F.lit(v)) for k, v in entries.items()))
    return F.array_sort(F.array_distinct(F.array_compact(let(F.concat(F.lit(" "), keyword_phrase(c), F.lit(" ")), hits))))


def alias_mentions(c: Column, lexicon: lx.Lexicon) -> Column:
    table = {k: v for k, v in lexicon.alias_map().items() if len(k) >= 2}
    noise = set(lexicon.noise())
    return mentions(c, {k: v for k, v in table.items() if v not in noise and len("".join(ch for ch in v if ch.isalnum())) >= 3})


def profile_text(c: Column) -> Column:
    """X8 on text folded to ASCII: lower case, only letters, digits and %+.-."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"[^a-z0-9%+.-]+", " "))


def canonical_phrase(c: Column) -> Column:
    """X9 without abbreviations: X8, hyphens to spaces, no articles and club suffixes."""
    text = F.regexp_replace(F.translate(profile_text(c), "-", " "), r"\b(?:the|fc|cf|sc|afc|club)\b", " ")
    return F.regexp_replace(squeeze(text), r"^[ .-]+|[ .-]+$", "")


def expand_abbreviations(c: Column, table: dict[str, str]) -> Column:
    """The whole text by the table, else word by word."""
    if not table:
        return c
    entries = literal_map({k.lower(): v for k, v in table.items()})
    words = F.split(F.trim(F.lower(c)), r"\s+")
    each = F.transform(words, lambda w: F.coalesce(F.element_at(entries, F.regexp_replace(w, r"^[^a-z0-9]+|[^a-z0-9]+$", "")), w))
    return F.coalesce(F.element_at(entries, F.trim(F.lower(c))), F.array_join(each, " "))


def outcome_phrase(c: Column) -> Column:
    """X10 on text folded to ASCII."""
    text = F.lower(F.coalesce(c, F.lit("")))
    text = F.regexp_replace(F.regexp_replace(text, r"\b(men|women)['’]s\b", "$1s"), r"\bu\.s\.a?\.?", "us")
    return squeeze(F.regexp_replace(text, r"[^a-z0-9.#%$]+", " "))


def title_tokens(c: Column) -> Column:
    """Sorted distinct words of a title, ordinals as numbers, no stop words and single letters."""
    words = F.split(F.trim(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"[^a-z0-9-]+", " ")), " ")
    kept = F.filter(words, lambda w: ~w.isin("", *lx.TITLE_STOP_WORDS))
    plain = F.transform(kept, lambda w: F.regexp_replace(w, r"^(\d+)(?:st|nd|rd|th)$", "$1"))
    return F.array_sort(F.array_distinct(F.filter(plain, lambda w: (F.length(w) > 1) | w.rlike("^[0-9]+$"))))


def overlap(a: Column, b: Column) -> Column:
    """Shared tokens over the smaller set; 0 where a set is empty."""
    least = F.least(F.size(a), F.size(b))
    return F.when(least > 0, F.size(F.array_intersect(a, b)) / least).otherwise(F.lit(0.0))


def jaccard(a: Column, b: Column) -> Column:
    least = F.least(F.size(a), F.size(b))
    return F.when(least > 0, F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))).otherwise(F.lit(0.0))


def singular(c: Column) -> Column:
    """A naive singular."""
    return (
        F.when(c.rlike("(ss|us|is|as)$"), c)
        .when(c.endswith("ies") & (F.length(c) > 5), F.concat(F.substring(c, F.lit(1), F.length(c) - 3), F.lit("y")))
        .when(c.endswith("s") & (F.length(c) > 4), F.substring(c, F.lit(1), F.length(c) - 1))
        .otherwise(c)
    )


def evidence_key(c: Column) -> Column:
    """X18, the variant that also treats year: keywords."""
    return singular(F.lower(F.trim(c)))


def statistics_key(c: Column) -> Column:
    """X18, the variant that leaves year: keywords alone."""
    text = F.lower(F.trim(c))
    return F.when(text.startswith("year:"), text).otherwise(singular(text))


def is_distinctive(c: Column) -> Column:
    """F5."""
    text = F.lower(F.trim(c))
    return ~text.startswith("year:") & ~text.isin(*lx.GENERIC_SINGLE_KEYWORDS) & (text.rlike("[ 0-9-]") | (F.length(text) >= 9))


def has_term(c: Column, terms) -> Column:
    """Any of the terms as whole words, in lower case text without punctuation; the text may hold %."""
    text = F.concat(F.lit(" "), F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9% ]+", " "), F.lit(" "))
    return text.rlike(r"\b(?:" + "|".join(_quoted(t) for t in terms) + r")\b")


def named(c: Column, patterns: dict[str, str]) -> Column:
    """Sorted names of the patterns that the text matches, case ignored."""
    return F.array_sort(F.array_compact(let(c, lambda t: F.array(*(F.when(t.rlike("(?i)" + p), F.lit(n)) for n, p in patterns.items())))))


def overlaps(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b)) > 0


def disjoint(a: Column, b: Column) -> Column:
    """Both non-empty and nothing shared."""
    return (F.size(a) > 0) & (F.size(b) > 0) & (F.size(F.array_intersect(a, b)) == 0)


def stable_key(parts: Column) -> Column:
    """20 hex digits over the sorted distinct non-empty parts; empty without parts."""
    kept = F.array_sort(F.array_distinct(F.filter(parts, lambda p: p != "")))
    return F.when(F.size(kept) == 0, F.lit("")).otherwise(F.substring(F.sha2(F.array_join(kept, "|"), 256), 1, 20))


def title_case(c: Column) -> Column:
    """Capital after any character that is no letter, as str.title() does for ASCII text."""
    pieces = F.regexp_extract_all(c, F.lit(r"([A-Za-z]+|[^A-Za-z]+)"), F.lit(1))
    return F.array_join(F.transform(pieces, lambda p: F.initcap(p)), "")
