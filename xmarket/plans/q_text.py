"""Queries of the text, category and title extractors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from xmarket.functions import category, events, text, udf
from xmarket.functions import lexicon as lx
from xmarket.plans.registry import query
from xmarket.plans.views import base, view

LEXICON = lx.Lexicon()


def _join(**columns) -> list:
    """Arrays as text, so that results compare by value."""
    return [F.array_join(c, "|").alias(n) for n, c in columns.items()]


def sql_list(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


def sql_map(entries: dict[str, str]) -> str:
    return "MAP {" + ", ".join("'" + k.replace("'", "''") + "': '" + v.replace("'", "''") + "'" for k, v in entries.items()) + "}"


def sql_named(expr: str, patterns: dict[str, str]) -> str:
    """Names of matching patterns, sorted."""
    cases = ", ".join(f"CASE WHEN regexp_matches({expr}, '{p.replace(chr(39), chr(39) * 2)}', 'i') THEN '{n}' END" for n, p in patterns.items())
    return f"array_to_string(list_sort(list_filter([{cases}], lambda x: x IS NOT NULL)), '|')"


PLAIN = r"trim(regexp_replace(lower(coalesce(title, '')), '[^a-z0-9%+.-]+', ' ', 'g'))"
WORDS = r"trim(regexp_replace(lower(coalesce(title, '')), '[^a-z0-9-]+', ' ', 'g'))"
TOKENS = rf"list_sort(list_distinct(list_filter(list_transform(list_filter(string_split({WORDS}, ' '), lambda w: w <> '' AND NOT list_contains({sql_list(lx.TITLE_STOP_WORDS)}, w)), lambda w: regexp_replace(w, '^(\d+)(?:st|nd|rd|th)$', '\1')), lambda w: length(w) > 1 OR regexp_matches(w, '^[0-9]+$'))))"
MONTH = events._MONTH.replace("'", "''")
MONTH_NO = "CAST(list_position(['jan','feb','mar','apr','may','jun','jul','aug','sep','oct','nov','dec'], substr(lower({0}), 1, 3)) AS VARCHAR)"


@query(r"""SELECT doc_id, trim(coalesce(text, '')) AS safe, CASE WHEN length(t) > 60 THEN rtrim(substr(t, 1, 57)) || '...' ELSE t END AS short,
 regexp_replace(trim(replace(source || '*.0', '*', '')), '\.0$', '') AS id FROM (SELECT *, trim(regexp_replace(trim(coalesce(text, '')), '\s+', ' ', 'g')) AS t FROM documents) d""")
def p10_safe_and_compact_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = base(spark, sf_dir, "documents")
    return d.select("doc_id", text.safe_text(F.col("text")).alias("safe"), text.compact_text(F.col("text"), 60).alias("short"), text.clean_id(F.concat("source", F.lit("*.0"))).alias("id"))


@query(r"""SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 'N/A' ELSE trim(regexp_replace(c_name || '  x', '\s+', ' ', 'g')) END AS label,
 CASE WHEN c_custkey % 5 = 0 THEN 'n/a' ELSE lower(trim(regexp_replace(c_name || '  x', '\s+', ' ', 'g'))) END AS key FROM customer""")
def x1_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = base(spark, sf_dir, "customer")
    missing = F.element_at(F.array(*(F.lit(x) for x in ("nan", "NA", "<NA>", " ", "None"))), (F.col("c_custkey") % 5 + 1).cast("int"))
    raw = F.when(F.col("c_custkey") % 5 == 0, missing).otherwise(F.concat("c_name", F.lit("  x")))
    return c.select("c_custkey", text.label(raw).alias("label"), text.label_key(raw).alias("key"))


@query(r"""WITH p AS (SELECT p_partkey, regexp_replace(regexp_replace(replace(replace(regexp_replace(trim(lower(p_name || '''s_' || p_type || ' & Co.')), '''s\b', '', 'g'), '_', ' '), '&', ' and '), '\s+', ' ', 'g'), '^[ .,!?;:"()\[\]{}]+|[ .,!?;:"()\[\]{}]+$', '', 'g') AS phrase FROM part)
SELECT p_partkey, phrase, regexp_replace(phrase, '[^a-z0-9:%$+-]+', '', 'g') AS compact FROM p""")
def x2_keyword_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.concat("p_name", F.lit("'s_"), "p_type", F.lit(" & Co."))
    return base(spark, sf_dir, "part").select("p_partkey", text.keyword_phrase(raw).alias("phrase"), text.compact_key(raw).alias("compact"))


_WORD_ROWS = "SELECT event_id, unnest(string_split(" + WORDS + ", ' ')) AS word FROM v_titles"


def _title_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.split(F.trim(F.regexp_replace(F.lower("title"), "[^a-z0-9-]+", " ")), " ")
    return view(spark, sf_dir, "v_titles").select("event_id", F.explode(words).alias("word"))


_ALIASES = LEXICON.alias_map()
_CANON = f"coalesce(element_at({sql_map(_ALIASES)}, word)[1], element_at({sql_map(_ALIASES)}, regexp_replace(word, '[^a-z0-9:%$+-]+', '', 'g'))[1], word)"


@query(f"""WITH w AS (SELECT DISTINCT word FROM ({_WORD_ROWS}) x), c AS (SELECT word, {_CANON} AS canonical FROM w)
SELECT word, canonical, (canonical = '' OR list_contains({sql_list(LEXICON.noise())}, canonical) OR list_contains({sql_list(LEXICON.noise())}, regexp_replace(canonical, '[^a-z0-9:%$+-]+', '', 'g'))
 OR regexp_matches(canonical, '^[$€£¥]+$') OR (length(regexp_replace(canonical, '[^a-z0-9]', '', 'g')) < 3 AND NOT regexp_matches(canonical, '^[0-9]+$'))) AS noise FROM c""")
def x4_canonical_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X4 and F6 over the distinct words of all titles."""
    words = _title_words(spark, sf_dir).select("word").distinct()
    return words.select("word", text.canonical_keyword(F.col("word"), LEXICON).alias("canonical"), text.is_noise_keyword(F.col("word"), LEXICON).alias("noise"))


@query("SELECT event_id, " + "array_to_string(list_sort(list_distinct(list_filter([" + ", ".join(f"CASE WHEN regexp_matches(' ' || lower(title) || ' ', '(^|[^a-z0-9]){k.replace(chr(39), chr(39) * 2).replace('&', '[&]')}($|[^a-z0-9])') THEN '{v}' END" for k, v in LEXICON.domain_tokens().items()) + "], lambda x: x IS NOT NULL))), '|') AS tokens FROM v_titles")
def x5_domain_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "v_titles").select("event_id", *_join(tokens=text.mentions(F.col("title"), LEXICON.domain_tokens())))


@query(f"SELECT event_id, {PLAIN} AS plain, trim(regexp_replace(regexp_replace(regexp_replace(replace({PLAIN}, '-', ' '), '\\b(?:the|fc|cf|sc|afc|club)\\b', ' ', 'g'), '\\s+', ' ', 'g'), '^[ .-]+|[ .-]+$', '', 'g')) AS canonical FROM v_titles")
def x8_profile_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "v_titles").select("event_id", text.profile_text(F.col("title")).alias("plain"), text.canonical_phrase(F.col("title")).alias("canonical"))


@query(f"SELECT event_id, array_to_string({TOKENS}, '|') AS tokens FROM v_titles")
def x16_title_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "v_titles").select("event_id", *_join(tokens=text.title_tokens(F.col("title"))))


@query(f"""WITH t AS (SELECT event_id, sub_category, platform, {TOKENS} AS tokens FROM v_titles), k AS (SELECT * FROM t WHERE platform = 'K'), p AS (SELECT * FROM t WHERE platform = 'P'),
j AS (SELECT k.event_id AS k_id, p.event_id AS p_id, len(list_intersect(k.tokens, p.tokens)) AS s, len(k.tokens) AS a, len(p.tokens) AS b FROM k JOIN p ON k.event_id + 1 = p.event_id)
SELECT k_id, p_id, round(CASE WHEN least(a, b) > 0 THEN s / least(a, b) ELSE 0 END, 6) AS ov, round(CASE WHEN least(a, b) > 0 THEN s / (a + b - s) ELSE 0 END, 6) AS jac FROM j""")
def x16_title_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbouring K and P titles."""
    t = view(spark, sf_dir, "v_titles").select("event_id", "platform", text.title_tokens(F.col("title")).alias("tokens"))
    k = t.where("platform = 'K'").select(F.col("event_id").alias("k_id"), F.col("tokens").alias("kt"))
    p = t.where("platform = 'P'").select(F.col("event_id").alias("p_id"), F.col("tokens").alias("pt"))
    j = k.join(p, F.col("k_id") + 1 == F.col("p_id"))
    return j.select("k_id", "p_id", F.round(text.overlap(F.col("kt"), F.col("pt")), 6).alias("ov"), F.round(text.jaccard(F.col("kt"), F.col("pt")), 6).alias("jac"))


_SING = "CASE WHEN regexp_matches(word, '(ss|us|is|as)$') THEN word WHEN word LIKE '%ies' AND length(word) > 5 THEN left(word, length(word) - 3) || 'y' WHEN word LIKE '%s' AND length(word) > 4 THEN left(word, length(word) - 1) ELSE word END"


@query(f"""SELECT DISTINCT word, {_SING} AS singular, (NOT word LIKE 'year:%' AND NOT list_contains({sql_list(lx.GENERIC_SINGLE_KEYWORDS)}, word) AND (regexp_matches(word, '[ 0-9-]') OR length(word) >= 9)) AS distinctive FROM ({_WORD_ROWS}) w""")
def x18_singular_and_f5_distinctive(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = _title_words(spark, sf_dir).select("word").distinct()
    return words.select("word", text.evidence_key(F.col("word")).alias("singular"), text.is_distinctive(F.col("word")).alias("distinctive"))


@query()
def x19_title_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratcliff-Obershelp ratio of neighbouring K and P titles; SQL has no equal."""
    t = view(spark, sf_dir, "v_titles")
    k = t.where("platform = 'K'").select(F.col("event_id").alias("k_id"), F.col("title").alias("kt"))
    p = t.where("platform = 'P'").select(F.col("event_id").alias("p_id"), F.col("title").alias("pt"))
    return k.join(p, F.col("k_id") + 1 == F.col("p_id")).select("k_id", "p_id", udf.ro_similarity(F.col("kt"), F.col("pt")).alias("similarity"))


_SEASON = r"'\b(20\d{2})\s*[-/]\s*(\d{2,4})\b'"
_DATE_SQL = events._DATE.replace("'", "''")
_SHORT = "lpad({0}, 2, '0')"
_DATES = (
    f"array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all(title, '{_DATE_SQL}', ['m', 'd', 'y']), lambda p: (CASE WHEN coalesce(p.y, '') = '' THEN '????' ELSE p.y END) || '-' || "
    + _SHORT.format(MONTH_NO.format("p.m")) + " || '-' || lpad(p.d, 2, '0')))), '|')"
)
_PERIODS = (
    f"array_to_string(list_sort(list_distinct(list_concat(list_transform(regexp_extract_all(title, '(?i)\\b({MONTH})\\b\\.?\\s*(20[2-3][0-9])?', ['m', 'y']), lambda p: (CASE WHEN coalesce(p.y, '') = '' THEN '????' ELSE p.y END) || '-' || "
    + _SHORT.format(MONTH_NO.format("p.m"))
    + "), list_transform(regexp_extract_all(title, '(?i)\\b(Q[1-4])\\b\\s*(20[2-3][0-9])?', ['q', 'y']), lambda p: (CASE WHEN coalesce(p.y, '') = '' THEN '????' ELSE p.y END) || '-' || upper(p.q))))), '|')"
)


@query(rf"""SELECT event_id, array_to_string(list_sort(list_distinct(regexp_extract_all(title, '\b(20[2-3][0-9])\b', 1))), '|') AS years,
 array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all(title, {_SEASON}, ['a', 'b']), lambda p: p.a || '-' || CASE WHEN length(p.b) = 2 THEN left(p.a, 2) || p.b ELSE p.b END))), '|') AS seasons,
 {_DATES} AS dates, {_PERIODS} AS periods FROM v_titles""")
def x23_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("title")
    return view(spark, sf_dir, "v_titles").select("event_id", *_join(years=events.years(t), seasons=events.seasons(t), dates=events.dates(t), periods=events.periods(t)))


_PLACES = "list_concat(" + ", ".join(f"regexp_extract_all(title, '\\b{lead} {events._PLACE.replace(chr(39), chr(39) * 2)}', 1)" for lead in ("temperature in", "mayor of", "(?:election|race) in", "governor of")) + ")"
_CANON_V = r"trim(regexp_replace(regexp_replace(trim(regexp_replace(regexp_replace(replace(trim(regexp_replace(lower(v), '[^a-z0-9%+.-]+', ' ', 'g')), '-', ' '), '\b(?:the|fc|cf|sc|afc|club)\b', ' ', 'g'), '\s+', ' ', 'g')), '^[ .-]+|[ .-]+$', '', 'g'), '\b(?:on|by|before|after|during)\b.*$', ''))"


@query(rf"""SELECT event_id, array_to_string(list_sort(list_distinct(list_filter(list_transform(regexp_extract_all(title, '(?i)\bgroup\s+([a-z0-9]+)\b', 1), lambda v: lower(v)), lambda v: length(v) = 1 OR regexp_matches(v, '^[0-9]+$')))), '|') AS groups,
 array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all(title, '(?i)\b([a-z]{{2}}-(?:\d{{1,2}}|al))\b', 1), lambda v: upper(v)))), '|') AS districts,
 array_to_string(list_sort(list_distinct(list_filter(list_transform({_PLACES}, lambda v: {_CANON_V}), lambda v: v NOT IN ('', 'the', 'united states')))), '|') AS locations FROM v_titles""")
def x24_groups_districts_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("title")
    return view(spark, sf_dir, "v_titles").select("event_id", *_join(groups=events.groups(t), districts=events.districts(t), locations=events.locations(t)))


_NUM = "regexp_replace(regexp_replace(CASE WHEN contains(p.n, '.') THEN regexp_replace(p.n, '0+$', '') ELSE p.n END, '\\.$', ''), '^0+([0-9])', '\\1')"


@query(rf"""WITH t AS (SELECT event_id, {PLAIN} AS plain FROM v_titles)
SELECT event_id, CASE WHEN {sql_named('plain', lx.DIRECTIONS)} <> '' OR regexp_matches(plain, '%|price|rate|score|temperature') THEN
 array_to_string(list_sort(list_distinct(list_transform(list_filter(regexp_extract_all(plain, '\b(\d+(?:\.\d+)?)\s*(%|percent|bps|points?|degrees?|usd|dollars?)?', ['n', 'u']), lambda p: NOT regexp_matches(p.n, '^20[2-3][0-9]$')),
  lambda p: {_NUM} || ':' || CASE WHEN coalesce(p.u, '') = '' THEN 'number' ELSE p.u END))), '|') ELSE '' END AS thresholds FROM t""")
def x25_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "v_titles").select("event_id", *_join(thresholds=events.thresholds(F.col("title"))))


@query(rf"""WITH t AS (SELECT event_id, trim(title) AS v FROM v_titles), s AS (SELECT event_id, v, {_CANON_V.replace('lower(v)', r"lower(regexp_extract(v, '(?i)^(.*?)\s+(?:vs\.?|v\.?|at|@)\s+(.*?)$', 1))").replace("'\\b(?:on|by|before|after|during)\\b.*$'", "'^$'")} AS a,
 {_CANON_V.replace('lower(v)', r"lower(regexp_extract(v, '(?i)^(.*?)\s+(?:vs\.?|v\.?|at|@)\s+(.*?)$', 2))").replace("'\\b(?:on|by|before|after|during)\\b.*$'", "'^$'")} AS b FROM t)
SELECT event_id, CASE WHEN a <> '' AND b <> '' AND a <> b THEN least(a, b) || '|' || greatest(a, b) ELSE '' END AS participants FROM s""")
def x26_participants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "v_titles").select("event_id", *_join(participants=events.participants(F.col("title"))))


@query(f"SELECT event_id, {', '.join(f'{sql_named(PLAIN, table)} AS {name}' for name, table in (('scopes', lx.SCOPES), ('layers', lx.LAYERS), ('actions', lx.ACTIONS), ('stages', lx.STAGES), ('directions', lx.DIRECTIONS)))} FROM v_titles")
def x27_named_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    plain = text.profile_text(F.col("title"))
    tables = {"scopes": lx.SCOPES, "layers": lx.LAYERS, "actions": lx.ACTIONS, "stages": lx.STAGES, "directions": lx.DIRECTIONS}
    return view(spark, sf_dir, "v_titles").select("event_id", *_join(**{n: text.named(plain, t) for n, t in tables.items()}))


_LOW = "regexp_replace(lower(coalesce(title, '')), '[^a-z0-9 ]+', ' ', 'g')"
_LOWPCT = "(' ' || regexp_replace(lower(coalesce(title, '')), '[^a-z0-9% ]+', ' ', 'g') || ' ')"
_TITLE_SCOPES = {n: r"\b(?:" + "|".join(w) + r")\b" for n, w in lx.TITLE_SCOPES.items()} | {"top_finish": r"\btop\s+(?:\d+|four|five|ten)\b"}
_TERM = lambda words: f"regexp_matches({_LOWPCT}, '\\b(?:{'|'.join(words)})\\b')"
_BY_COUNTRY: dict[str, list[str]] = {}
for _a, _n in lx.COUNTRIES.items():
    _BY_COUNTRY.setdefault(_n, []).append(_a)
_BY_COUNTRY["united states"].append(r"u\s*s")


@query(rf"""SELECT event_id, {sql_named(_LOW, _TITLE_SCOPES)} AS title_scopes, array_to_string(list_filter([CASE WHEN {_TERM(lx.DOWN_TERMS)} THEN 'down' END, CASE WHEN {_TERM(lx.UP_TERMS)} THEN 'up' END], lambda x: x IS NOT NULL), '|') AS directions,
 array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all(lower(title), '\b(q[1-4]\s+20[2-3][0-9])\b', 1), lambda v: regexp_replace(v, '\s+', ' ', 'g')))), '|') AS quarters,
 ({_TERM(lx.THRESHOLD_TERMS)} OR contains(title, '%')) AS has_threshold, {_TERM(lx.RELATION_TERMS)} AS has_relation,
 {sql_named(_LOW, {n: '\\b(?:' + '|'.join(w) + ')\\b' for n, w in _BY_COUNTRY.items()})} AS countries FROM v_titles""")
def x31_rule_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("title")
    return view(spark, sf_dir, "v_titles").select(
        "event_id", *_join(title_scopes=events.title_scopes(t), directions=events.title_directions(t), quarters=events.quarter_years(t), countries=events.countries(t)),
        events.speaks_of_threshold(t).alias("has_threshold"), text.has_term(t, lx.RELATION_TERMS).alias("has_relation"),
    )


@query(rf"""WITH d AS (SELECT event_id, list_sort(list_distinct(list_filter(regexp_extract_all(lower(title), '\b([a-z]{{2}}-(?:\d{{1,2}}|al))\b', 1), lambda v: list_contains({sql_list(lx.STATES)}, left(v, 2))))) AS ds, {_LOW} AS low FROM v_titles)
SELECT event_id, array_to_string(ds, '|') AS districts, array_to_string(list_sort(list_distinct(list_concat(list_transform(ds, lambda v: element_at({sql_map(lx.STATES)}, left(v, 2))[1]),
 list_filter({sql_list([*lx.STATES.values(), 'district of columbia'])}, lambda s: regexp_matches(low, '\b' || s || '\b'))))), '|') AS states FROM d""")
def x31_states_and_districts(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("title")
    return view(spark, sf_dir, "v_titles").select("event_id", *_join(districts=events.us_districts(t), states=events.us_states(t)))


_TERMS = {"expand": f"list_distinct(list_concat([x], string_split(coalesce(element_at({sql_map(lx.CATEGORY_ALIASES)}, x)[1], x), '|')))"}


@query(f"""WITH c AS (SELECT DISTINCT lower(c_mktsegment) AS a FROM customer UNION SELECT unnest({sql_list(lx.CATEGORY_ALIASES)})), e AS (SELECT a AS x FROM c)
SELECT x AS category, array_to_string(list_sort(list_distinct(list_concat({_TERMS['expand']},
  CASE WHEN x LIKE '% primary' THEN ['primaries', 'primary elections'] ELSE [] END, CASE WHEN contains(x, 'governor') AND contains(x, 'primary') THEN ['governor', 'primaries'] ELSE [] END,
  CASE WHEN contains(x, 'senate') AND contains(x, 'primary') THEN ['senate', 'primaries'] ELSE [] END))), '|') AS terms FROM e""")
def x42_expand_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = spark.range(1).select(F.explode(text.strings(list(lx.CATEGORY_ALIASES))).alias("category"))
    names = base(spark, sf_dir, "customer").select(F.lower("c_mktsegment").alias("category")).union(known).distinct()
    return names.select("category", *_join(terms=F.array_sort(category.expand_term(F.col("category")))))


_TAGS = "'crypto, ' || lower(n_name) || ',nba'"


@query(f"""WITH n AS (SELECT n_nationkey, lower(n_name) AS nation FROM nation)
SELECT n_nationkey, array_to_string(list_sort(list_distinct(['politics', 'crypto', nation, 'nba', 'basketball'])), '|') AS terms, 'politics / crypto, ' || nation || ',nba' AS k_key,
 true AS overlaps_sports, n_nationkey % 2 = 0 AS overlaps_world FROM n""")
def x44_category_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    tags = F.concat(F.lit("crypto, "), F.lower("n_name"), F.lit(",nba"))
    mine = category.terms(F.lit("Politics"), tags)
    other = F.when(F.col("n_nationkey") % 2 == 0, text.strings(["world affairs"])).otherwise(text.strings(["hockey"]))
    return base(spark, sf_dir, "nation").select(
        "n_nationkey", *_join(terms=mine), category.k_key(F.lit("Politics"), tags).alias("k_key"),
        category.categories_overlap(mine, text.strings(["basketball"])).alias("overlaps_sports"), category.categories_overlap(mine, other).alias("overlaps_world"),
    )


@query()
def x43_resolve_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Resolution of every distinct category of the titles; cases are compared in the tests."""
    keys = view(spark, sf_dir, "v_titles").select(category.k_key(F.col("category"), F.col("sub_category")).alias("k_key")).distinct()
    mapping = {"AUTOMOBILE / N/A": ["Sports"], "BUILDING / FRANCE": ["NBA"], "MACHINERY / N/A": ["tech"]}
    out = category.resolve(keys, mapping, ["sports", "nba", "basketball", "france", "germany", "tech", "business"])
    return out.select("k_key", "mode", "has_exact", *_join(keys=F.col("keys"), requested=F.col("requested")))


@query(r"""SELECT page_id, lower(regexp_extract(html, '(?is)<title>(.*?)</title>', 1)) AS title, regexp_replace(lower(url), '^https?://(www\.)?|/+$', '', 'g') AS site FROM pages""")
def x1_page_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = base(spark, sf_dir, "pages")
    return p.select("page_id", F.lower(F.regexp_extract("html", r"(?is)<title>(.*?)</title>", 1)).alias("title"), F.regexp_replace(F.lower("url"), r"^https?://(www\.)?|/+$", "").alias("site"))
