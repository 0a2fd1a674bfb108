"""Quality rules: fixed base rules and gradient-boosted trees over document statistics.

Trees are grown here on histogram bins with second-order gains, under monotonic constraints on chosen
features (a split whose children break a constraint is refused, and bounds pass down to both sides), then
flattened into numpy node arrays so that a batch of rows descends all trees in a few vector steps.

The fit uses labelled rows, at most about ``max_train_rows`` of them (a documented bound on the fit alone;
every row is scored).  Defined results: a null or empty text has zero words and fails the base rules; rows
without a label or with a null one aren't learned from; with no labelled row, or labels of one class, the
base rules decide alone; several labels of one id give one training row each; a null id keeps its row;
repeated rows are scored each; extra columns are ignored.  Statistics cover whole texts.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from xmarket.llm.words import map_arrow

SYMBOLS = b"#*$%&|<>"
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = (
    "log_words", "mean_word_chars", "symbol_ratio", "dup_line_ratio", "repeat_ratio", "upper_ratio", "digit_ratio", "distinct_ratio",
    "words_per_line", "marked_word_ratio", "stop_end_ratio",
)
#: -1: more of it may only lower the score, 1: only raise it.
MONOTONE = {"symbol_ratio": -1, "dup_line_ratio": -1, "repeat_ratio": -1, "marked_word_ratio": -1}
_SPACE = b" \t\n\v\f\r"
_UPPER, _DIGIT = bytes(range(65, 91)), bytes(range(48, 58))
_CONT = bytes(range(0x80, 0xC0))


def statistics(text: str | None) -> tuple[tuple[int, ...], tuple[float, ...]]:
    """BASE counts and FEATURES of a whole text."""
    data = text.encode("utf-8", "surrogatepass") if text else b""
    words = data.split()
    n = len(words)
    squeezed = data.translate(None, _SPACE)
    chars = len(squeezed.translate(None, _CONT))
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    lines = [x for x in data.split(b"\n") if x.strip(_SPACE)]
    dup_lines = len(lines) - len(set(lines))
    repeated = 0
    if n >= 3:
        windows = list(zip(words, words[1:], words[2:], strict=False))
        counts = Counter(windows)
        if len(counts) < len(windows):
            last = -1  # the last word index that is counted
            for i, w in enumerate(windows):
                if counts[w] > 1:
                    repeated += i + 2 - max(last, i - 1)
                    last = i + 2
    some, size = max(n, 1), max(len(squeezed), 1)
    features = (
        float(np.log1p(n)),
        chars / some,
        symbols / size,
        dup_lines / max(len(lines), 1),
        repeated / some,
        (size - len(squeezed.translate(None, _UPPER))) / size if squeezed else 0.0,
        (size - len(squeezed.translate(None, _DIGIT))) / size if squeezed else 0.0,
        len(set(words)) / some,
        min(200.0, n / max(len(lines), 1)),
        sum(w[-1] in b"#*$%&|<>!" for w in words) / some,
        sum(w[-1] == 46 for w in words) / some,
    )
    return (n, chars, symbols, dup_lines, repeated), features


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < 50 or 100 * n_repeat_words > 50 * n_words


class Forest:
    """Flat trees: per node a feature (-1: leaf), a threshold, the left child (the right one follows it) and a value."""

    def __init__(self, feature: np.ndarray, threshold: np.ndarray, left: np.ndarray, value: np.ndarray, roots: np.ndarray, bias: float, depth: int):
        self.feature, self.threshold, self.left, self.value, self.roots, self.bias, self.depth = feature, threshold, left, value, roots, bias, depth

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of the good class for rows of features."""
        at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            f = self.feature[at]
            go_right = x[rows, np.maximum(f, 0)] > self.threshold[at]
            at = np.where(f < 0, at, self.left[at] + go_right)
        return 1.0 / (1.0 + np.exp(-(self.bias + self.value[at].sum(axis=1))))


def fit_forest(x: np.ndarray, y: np.ndarray, monotone: dict[int, int], trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64, l2: float = 1.0, min_hess: float = 4.0) -> Forest:
    """Logistic gradient boosting on quantile bins."""
    n, k = x.shape
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(k)]
    codes = np.stack([np.searchsorted(cuts[j], x[:, j], side="left") for j in range(k)], axis=1)  # code c: x <= cuts[c]
    mean = min(max(float(y.mean()), 1e-3), 1 - 1e-3)
    bias = float(np.log(mean / (1 - mean)))
    raw = np.full(n, bias)
    feature, threshold, left, value, roots = [], [], [], [], []

    def new() -> int:
        for column, zero in ((feature, -1), (threshold, 0.0), (left, 0), (value, 0.0)):
            column.append(zero)
        return len(feature) - 1

    def clipped(g: float, h: float, low: float, high: float) -> float:
        return float(min(max(-g / (h + l2), low), high))

    def grow(node: int, rows: np.ndarray, g: np.ndarray, h: np.ndarray, level: int, low: float, high: float) -> None:
        gs, hs = g[rows].sum(), h[rows].sum()
        value[node] = rate * clipped(gs, hs, low, high)
        if level == depth or hs < 2 * min_hess:
            raw[rows] += value[node]
            return
        gain_of = lambda a, b, v: -(a * v + 0.5 * (b + l2) * v * v)  # noqa: E731  how much a leaf of value v lowers the loss
        whole, best = gain_of(gs, hs, clipped(gs, hs, low, high)), (1e-6, -1, 0, 0.0, 0.0)
        for j in range(k):
            if not len(cuts[j]):
                continue
            gj = np.bincount(codes[rows, j], g[rows], len(cuts[j]) + 1).cumsum()[:-1]
            hj = np.bincount(codes[rows, j], h[rows], len(cuts[j]) + 1).cumsum()[:-1]
            va = np.clip(-gj / (hj + l2), low, high)
            vb = np.clip(-(gs - gj) / (hs - hj + l2), low, high)
            gain = gain_of(gj, hj, va) + gain_of(gs - gj, hs - hj, vb) - whole
            gain[(hj < min_hess) | (hs - hj < min_hess) | (monotone.get(j, 0) * (vb - va) < 0)] = -1
            c = int(gain.argmax())
            if gain[c] > best[0]:
                best = (float(gain[c]), j, c, float(va[c]), float(vb[c]))
        _, j, c, va, vb = best
        if j < 0:
            raw[rows] += value[node]
            return
        feature[node], threshold[node] = j, float(cuts[j][c])
        a = left[node] = new()
        b = new()
        right = codes[rows, j] > c
        mid, sign = (va + vb) / 2, monotone.get(j, 0)
        grow(a, rows[~right], g, h, level + 1, mid if sign < 0 else low, mid if sign > 0 else high)
        grow(b, rows[right], g, h, level + 1, mid if sign > 0 else low, mid if sign < 0 else high)

    for _ in range(trees):
        p = 1.0 / (1.0 + np.exp(-raw))
        root = new()
        roots.append(root)
        grow(root, np.arange(n), p - y, p * (1 - p), 0, -np.inf, np.inf)
    return Forest(np.array(feature), np.array(threshold), np.array(left), np.array(value), np.array(roots), bias, depth)


def _table(rows: list[tuple[tuple[int, ...], tuple[float, ...]]]) -> tuple[np.ndarray, np.ndarray]:
    counts = np.array([r[0] for r in rows], np.int64).reshape(-1, len(BASE))
    return counts, np.array([r[1] for r in rows], np.float64).reshape(-1, len(FEATURES))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_train_rows: int = 20_000) -> Forest | None:
    """Fit on documents joined with labels of 0 and 1; None if there is nothing to tell apart."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).select(id_col, F.col(label_col).cast("double").alias("label"))
    total = known.count()
    if total > max_train_rows:
        share = int(max_train_rows / total * 1_000_000)
        known = known.where(F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit("fit")), F.lit(1_000_000)) < share)
    joined = docs.select(id_col, text_col).join(known, id_col).select("label", text_col)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        _, x = _table([statistics(t) for t in batch.column(1).to_pylist()])
        return pa.record_batch([batch.column(0), *(pa.array(c) for c in x.T)], names=["label", *FEATURES])

    got = map_arrow(joined, run, ", ".join(["label double", *(f"{f} double" for f in FEATURES)])).toPandas()  # about max_train_rows rows of numbers
    got = got.sort_values(["label", *FEATURES], kind="stable")
    y = got["label"].to_numpy()
    if len(y) == 0 or y.min() == y.max():
        return None
    return fit_forest(got[list(FEATURES)].to_numpy(), y, {FEATURES.index(f): s for f, s in MONOTONE.items()})


def score(df: DataFrame, forest: Forest | None, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """(id, BASE counts, base_failed, kept, quality) of every row; quality is null without a model."""
    kind = df.schema[id_col].dataType.simpleString()
    sent = df.sparkSession.sparkContext.broadcast(forest)  # trees * 2^(depth + 1) nodes at most

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, x = _table([statistics(t) for t in batch.column(1).to_pylist()])
        failed = (counts[:, 0] < 50) | (100 * counts[:, 4] > 50 * counts[:, 0])
        model = sent.value
        p = model.score(x) if model is not None else None
        kept = ~failed & (p >= threshold) if p is not None else ~failed
        return pa.record_batch(
            [batch.column(0), *(pa.array(c) for c in counts.T), pa.array(failed), pa.array(kept), pa.array(p) if p is not None else pa.nulls(len(failed), pa.float64())],
            names=[id_col, *BASE, "base_failed", "kept", "quality"],
        )

    return map_arrow(df.select(id_col, text_col), run, f"`{id_col}` {kind}, " + ", ".join(f"{b} long" for b in BASE) + ", base_failed boolean, kept boolean, quality double")
