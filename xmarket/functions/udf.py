"""The Python functions of the engine: Arrow-batched, for what Spark has no expression for."""

from __future__ import annotations

import difflib
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType


@F.pandas_udf(StringType())
def _fold(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode())


@F.pandas_udf(StringType())
def _nfkc(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))


_NOT_ASCII = "[^\\x00-\\x7F]"


def ascii_fold(c: Column) -> Column:
    """Letters without their marks.  Rows of plain ASCII keep their value."""
    return F.when(c.rlike(_NOT_ASCII), _fold(c)).otherwise(c)


def nfkc(c: Column) -> Column:
    return F.when(c.rlike(_NOT_ASCII), _nfkc(c)).otherwise(c)


def _clean(text: str | None) -> str:
    return re.sub(r"\s+", " ", re.sub(r"[^a-z0-9 ]+", " ", (text or "").lower())).strip()


@F.pandas_udf(DoubleType())
def ro_similarity(left: pd.Series, right: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp ratio of cleaned titles; 0 where one is empty.  The order of the arguments matters."""
    out = []
    for a, b in zip(map(_clean, left), map(_clean, right), strict=True):
        out.append(difflib.SequenceMatcher(None, a, b).ratio() if a and b else 0.0)
    return pd.Series(out)


_DATE = re.compile(
    r"\b(january|february|march|april|may|june|july|august|september|october|november|december|jan|feb|mar|apr|jun|jul|aug|sept|sep|oct|nov|dec)"
    r"\.?\s+(\d{1,2})(?:st|nd|rd|th)?,?\s+(20\d{2})\b",
    re.I,
)
_MONTHS = {m: i for i, m in enumerate(("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"), 1)}
_OTHER = re.compile(r"\bresolve\w*\s+to\s+[\"']?other\b", re.I)
_IF = re.compile(r"\bif\b", re.I)
_NO_WINNER = re.compile(r"\bif\b.{0,80}\b(?:no winner|no result|nothing|none)\b.{0,35}\bby\s*$", re.I)
_LEFT_SCORES = (
    (5, re.compile(r"\b(?:ceremony|event|game|match)\b.{0,30}\b(?:held|take place|scheduled)?\s*on\s*$", re.I)),
    (4, re.compile(r"\b(?:by|before|until|through)\s*$", re.I)),
    (3, re.compile(r"\b(?:held|take place|scheduled)\s+(?:for|on)\s*$", re.I)),
    (2, re.compile(r"\bon\s*$", re.I)),
)


def deadline_of(texts: list[str | None]) -> str:
    """The date that the texts give most weight: by what stands left of it, then the earlier text, then the later place.

    Dates of fallback clauses don't count; in texts of up to 60 characters any date does.
    """
    best: tuple[int, int, int, str] | None = None
    for order, text in enumerate(t or "" for t in texts):
        for m in _DATE.finditer(text):
            try:
                day = f"{pd.Timestamp(int(m[3]), _MONTHS[m[1][:3].lower()], int(m[2])):%Y-%m-%d}"
            except ValueError:
                continue
            start = max(text.rfind(c, 0, m.start()) for c in ".\n") + 1
            stop = text.find(".", m.end())
            sentence = text[start : stop if stop >= 0 else len(text)]
            if (_IF.search(sentence) and _OTHER.search(sentence)) or _NO_WINNER.search(text[start : m.start()]):
                continue
            left = text[max(0, m.start() - 70) : m.start()]
            score = 6 if len(text) <= 60 else next((s for s, p in _LEFT_SCORES if p.search(left)), 0)
            if score:
                key = (score, -order, m.start(), day)
                best = key if best is None or key > best else best
    return best[3] if best else ""


@F.pandas_udf(StringType())
def extract_deadline(texts: pd.Series) -> pd.Series:
    """X34 over a column of arrays of texts."""
    return texts.map(lambda t: deadline_of(list(t) if t is not None else []))
