"""Language identification by word-first backoff.

A word that the model knows adds its log frequency in each language.  A word it doesn't know backs off to
its character n-grams (word ends marked by ``^`` and ``$``): the longest order with any known n-gram
gives the mean log frequency of its n-grams.  The language with the highest sum wins; the score is its
posterior probability at even priors.  A letter is what Unicode calls one (str.isalpha), so powers, fractions
and Roman numeral signs are none.

The model is fitted on labelled rows.  All of them are used up to ``max_train_rows``; beyond that a hash-sampled share
of each language is, in which every language may have the same number of rows (a documented bound: only the fit is
bounded, every row is predicted).  Words and n-grams are counted by Spark with partial sums.  The model keeps every word
of the sample that occurs ``min_count`` times (a word seen once says no more than its n-grams do) and every n-gram of these, so
``max_train_rows`` bounds what is sent to executors: about 220,000 words and 113,000 n-grams for 20,000 documents of 500 words.

Defined results: null, empty and letterless texts give ``und`` with score 0; so does any text if no row
is labelled; equal sums go to the first language by name; null labels are not learned from; a null id
counts as not held out and is not learned from; repeated rows count each; extra columns are ignored.
Whole texts are read, whatever their length.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from xmarket.llm.words import map_arrow, slices
from xmarket.session import written

UNDECIDED = "und"
_WORD = re.compile(r"[^\W\d_]+")
MAX_ORDER = 5
CACHE_ENTRIES = 60_000


def letter_words(text: str | None) -> list[str]:
    """Maximal runs of letters, lower case."""
    words = _WORD.findall(text.lower()) if text else []
    if words and not "".join(words).isalpha():
        words = "".join(c if c.isalpha() else " " for c in " ".join(words)).split()
    return words


class Model:
    """Languages, and a row of log frequencies (one a language) for each word and n-gram."""

    def __init__(self, languages: list[str], words: list[str] = (), word_table: np.ndarray | None = None, grams: list[str] = (), gram_table: np.ndarray | None = None, floor: tuple[float, ...] = ()):
        width = len(languages)
        self.languages, self.n_words = languages, len(words)
        self.words = {w: i for i, w in enumerate(words)}
        self.grams = {g: i for i, g in enumerate(grams)}
        self.word_table = np.zeros((0, width)) if word_table is None else np.asarray(word_table, np.float64).reshape(-1, width)
        self.gram_table = np.zeros((0, width)) if gram_table is None else np.asarray(gram_table, np.float64).reshape(-1, width)
        self.floor = np.array(floor or [0.0] * width)
        self._reset()

    def _reset(self) -> None:
        self._rows, self._table = dict(self.words), self.word_table  # what was worked out for unknown words goes

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("_rows", "_table")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__ |= state
        self._reset()

    def _learn(self, fresh: list[str]) -> None:
        """Rows of words that the model doesn't know, by backoff."""
        get, hits, sizes = self.grams.get, [], []
        for word in fresh:
            marked, found = f"^{word}$", []
            for order in range(MAX_ORDER, 0, -1):
                found = [r for i in range(len(marked) - order + 1) if (r := get(marked[i : i + order])) is not None]
                if found:
                    break
            hits += found
            sizes.append(len(found))
        n = np.array(sizes)
        rows = np.tile(self.floor, (len(fresh), 1))
        if hits:
            starts = np.concatenate(([0], np.cumsum(n[n > 0])[:-1]))
            rows[n > 0] = np.add.reduceat(self.gram_table[np.array(hits)], starts) / n[n > 0][:, None]
        first = len(self._table)
        self._rows |= {w: first + i for i, w in enumerate(fresh)}
        self._table = np.concatenate((self._table, rows))

    def word_scores(self, word: str) -> tuple[float, ...]:
        return tuple(self._scores([word])[0].tolist())

    def _scores(self, words: list[str]) -> np.ndarray:
        distinct = set(words)
        fresh = distinct.difference(self._rows)
        if len(self._table) - self.n_words + len(fresh) > CACHE_ENTRIES:
            self._reset()
            fresh = distinct.difference(self._rows)
        if fresh:
            self._learn(sorted(fresh))
        return self._table[np.fromiter(map(self._rows.__getitem__, words), np.int64, len(words))]

    def predict_all(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        words = [letter_words(t) if self.languages else [] for t in texts]
        n = np.array([len(w) for w in words], np.int64)
        labels, scores = [UNDECIDED] * len(texts), [0.0] * len(texts)
        at = np.flatnonzero(n)
        if len(at):
            totals = np.add.reduceat(self._scores(list(chain.from_iterable(words))), np.concatenate(([0], np.cumsum(n[at])[:-1])))
            best = totals.argmax(axis=1)
            odds = np.exp(totals - totals.max(axis=1)[:, None]).sum(axis=1)
            for i, b, o in zip(at.tolist(), best.tolist(), odds.tolist(), strict=True):
                labels[i], scores[i] = self.languages[b], 1.0 / o
        return labels, scores

    def predict(self, text: str | None) -> tuple[str, float]:
        labels, scores = self.predict_all([text])
        return labels[0], scores[0]


def _counts(labelled: DataFrame, text_col: str, label_col: str) -> DataFrame:
    """(lang, word, n) with the counts of a batch combined before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[str, Counter] = {}
            for part in slices(batch):
                for text, lang in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    counts.setdefault(lang, Counter()).update(letter_words(text))
            rows = [(lang, w, n) for lang, own in counts.items() for w, n in own.items()]
            if rows:
                langs, words, ns = map(list, zip(*rows, strict=True))
                yield pa.record_batch([pa.array(langs, pa.string()), pa.array(words, pa.string()), pa.array(ns, pa.int64())], names=["lang", "word", "n"])

    return labelled.select(text_col, label_col).mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _gram_counts(by_word: DataFrame, width: int) -> DataFrame:
    """(gram, n0, n1, ...) over the words (word, n0, n1, ...)."""
    names = [f"n{k}" for k in range(width)]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        grams: dict[str, int] = {}
        of, word = [], []
        for i, w in enumerate(batch.column(0).to_pylist()):
            marked = f"^{w}$"
            for order in range(1, MAX_ORDER + 1):
                for k in range(len(marked) - order + 1):
                    of.append(grams.setdefault(marked[k : k + order], len(grams)))
                    word.append(i)
        sums = [np.bincount(np.array(of), np.asarray(batch.column(c + 1))[np.array(word)], len(grams)).astype(np.int64) for c in range(width)]
        return pa.record_batch([pa.array(list(grams), pa.string()), *map(pa.array, sums)], names=["gram", *names])

    parts = map_arrow(by_word, run, "gram string, " + ", ".join(f"{n} long" for n in names))
    return parts.groupBy("gram").agg(*(F.sum(n).alias(n) for n in names))


def fit(labelled: DataFrame, text_col: str = "text", label_col: str = "lang", id_col: str = "doc_id", max_train_rows: int = 20_000, min_count: int = 2) -> Model:
    """Fit on rows with a label and a text; see the module for the bound."""
    rows = labelled.where(F.col(label_col).isNotNull() & F.col(text_col).isNotNull())
    sizes = {r[label_col]: r["count"] for r in rows.groupBy(label_col).count().collect()}  # a row a language
    if sum(sizes.values()) > max_train_rows:
        each = max_train_rows // len(sizes)
        shares = F.create_map(*(F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, each / n))))
        drawn = F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit("fit")), F.lit(1_000_000)) / F.lit(1_000_000.0)
        rows = rows.where(drawn < F.element_at(shares, F.col(label_col)))
    counts = written(_counts(rows, text_col, label_col), "counts")
    total = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    languages = sorted(total)
    if not languages:
        return Model([])
    names = [f"n{k}" for k in range(len(languages))]
    per_language = (F.sum(F.when(F.col("lang") == lang, F.col("n")).otherwise(0)).alias(n) for lang, n in zip(languages, names, strict=True))
    by_word = counts.groupBy("word").agg(*per_language).where(" + ".join(names) + f" >= {min_count}")
    by_word = written(by_word, "vocabulary")
    words, grams = by_word.toArrow().sort_by("word"), _gram_counts(by_word, len(languages)).toArrow().sort_by("gram")  # bounded by the sample
    spoken, n_words = np.array([total[x] for x in languages], np.float64), words.num_rows
    word_table = np.log((np.stack([words[n].to_numpy() for n in names], axis=1) + 0.1) / (spoken + 0.1 * n_words))
    floor = tuple(math.log(0.1 / (n + 0.1 * n_words + 1)) for n in spoken)
    order = np.array([len(g) for g in grams["gram"].to_pylist()], np.int64)
    seen = np.stack([grams[n].to_numpy() for n in names], axis=1).astype(np.float64)
    totals = np.stack([np.bincount(order, seen[:, k], MAX_ORDER + 1) for k in range(len(languages))], axis=1)
    gram_table = np.log((seen + 0.5) / (totals[order] + 500.0))
    return Model(languages, words["word"].to_pylist(), word_table, grams["gram"].to_pylist(), gram_table, floor)


def predict(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) of every row."""
    kind = df.schema[id_col].dataType.simpleString()
    sent = df.sparkSession.sparkContext.broadcast(model)  # bounded by the rows it was fitted on

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        labels, scores = sent.value.predict_all(batch.column(1).to_pylist())
        return pa.record_batch([batch.column(0), pa.array(labels, pa.string()), pa.array(scores, pa.float64())], names=[id_col, "lang_pred", "score"])

    return map_arrow(df.select(id_col, text_col), run, f"`{id_col}` {kind}, lang_pred string, score double", lambda: (sent.value, sent.value._reset))


def keep_known(df: DataFrame, model: Model, min_score: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of df, unchanged, whose text has a language with at least min_score; repeated rows and extra columns are kept."""
    sent = df.sparkSession.sparkContext.broadcast(model)
    at = df.columns.index(text_col)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        labels, scores = sent.value.predict_all(batch.column(at).to_pylist())
        return batch.filter(pa.array([lang != UNDECIDED and score >= min_score for lang, score in zip(labels, scores, strict=True)], pa.bool_()))

    return map_arrow(df, run, df.schema, lambda: (sent.value, sent.value._reset))


def held_out(id_col: str = "doc_id"):
    """The fold that is never learned from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(4)) == 2, F.lit(False))
