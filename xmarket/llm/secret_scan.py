"""Secret scan by assignment-aware lexing.

Two layers give spans.  Three fixed patterns (assign, access, hex) give the base spans.  On top, a lexer reads the
tokens of every line that holds an assignment (names, strings, operators, whatever else) and keeps the name that an
operator would assign to, so it sees name-literal pairs in source and configuration syntax (``name = "x"``,
``name: x``, ``"name": "x"``, ``table["name"] = "x"``, ``name: str = "x"``, ``a = b = "x"``, ``name := x``, ``name => x``,
concatenations with ``+``).  Values form a graph: a node has its own literals, the nodes of the constants it was made
of, and the shape of the whole (length, characters), which adds up from its parts.  A value is scored by the
target name and its shape; when a score is high enough, every literal that the value was made of becomes a
span of kind ``named`` with the score that reached it first.  A node is visited once, so a text costs its length however its
constants refer to each other.  Base spans always stay.

Defined results: a null or empty text has no spans; a null id keeps its row; repeated rows are scanned
each on their own; extra columns are ignored; an empty table gives an empty result.  Whole texts are
scanned, whatever their length.
"""

from __future__ import annotations

import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from xmarket.llm.words import map_arrow

KINDS = ("assign", "access", "hex", "named")
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")

_OPERATOR = re.compile(r"[:=]")
_QUOTED = r"\"((?:[^\"\\\n]|\\.)*)\"|'((?:[^'\\\n]|\\.)*)'|`([^`\n]*)`"
#: Tokens of a line: strings (not after a letter, where a quote is an apostrophe), names, operators, and what parts a name from an operator.
_TOKEN = re.compile(rf"(?<![A-Za-z0-9_])(?:{_QUOTED})|([A-Za-z_$][A-Za-z0-9_.$-]*)|(:=|=>|[:=])|(\\.|[^\s\"'\])}}A-Za-z_$:=])", re.A)
_NAME = re.compile(r"[A-Za-z_$][A-Za-z0-9_.$-]*", re.A)
_STRING = re.compile(_QUOTED, re.A)
_BARE = re.compile(r"[A-Za-z0-9+/_.$@!%^&*~-]+={0,2}", re.A)
_GAP = re.compile(r"[ \t]*")
_JOIN = re.compile(r"[ \t]*\+[ \t]*")
_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+", re.A)
_PLACEHOLDER = re.compile(r"(?i)change_?me|example|placeholder|your[_-]|dummy|redacted|x{4,}|\*{3,}|^<.*>$|^\$\{?[a-z_]+\}?$|^(none|null|true|false|undefined)$", re.A)

#: Points that a part of a target name gives to the literals assigned to it.
NAME_POINTS = {
    "password": 3.0, "passwd": 3.0, "pwd": 3.0, "passphrase": 3.0, "pass": 1.5, "secret": 3.0, "token": 2.5, "apikey": 3.0,
    "credential": 2.5, "credentials": 2.5, "auth": 1.5, "bearer": 2.0, "private": 1.0, "access": 0.5, "api": 1.0, "key": 1.5,
    "signing": 1.0, "encryption": 1.0, "salt": 1.5, "client": 0.5, "public": -2.0, "count": -3.0, "length": -3.0, "size": -3.0,
    "limit": -3.0, "name": -1.5, "type": -2.0, "url": -2.0, "path": -2.0, "file": -1.5, "hint": -2.0, "field": -1.5, "id": -0.5,
}
MIN_LITERAL, THRESHOLD = 8, 4.0
_MANY = 1 << 50  # counts of characters end here: a constant doubled in every line stays a number


def name_score(name: str) -> float:
    return sum(NAME_POINTS.get(p.lower(), 0.0) for p in _PART.findall(name))


class Value:
    """A literal, or what several values make together: spans of its own literals, its parts, and its shape."""

    __slots__ = ("spans", "parts", "counts", "placeholder", "marked")

    def __init__(self, text: str = "", spans: tuple[tuple[int, int], ...] = ()):
        self.spans, self.parts, self.marked = spans, (), False
        self.counts: dict[str, int] = {}
        for c in text:
            self.counts[c] = self.counts.get(c, 0) + 1
        self.placeholder = bool(_PLACEHOLDER.search(text))

    @staticmethod
    def joined(parts: list[Value]) -> Value:
        if len(parts) == 1:
            return parts[0]
        out = Value()
        out.parts, out.placeholder = tuple(parts), any(p.placeholder for p in parts)
        for p in parts:
            for c, n in p.counts.items():
                out.counts[c] = min(_MANY, out.counts.get(c, 0) + n)
        return out

    def score(self) -> float:
        """Shape: length, kinds of characters and entropy; placeholders score far below zero."""
        total = sum(self.counts.values())
        if total < MIN_LITERAL or self.placeholder:
            return -10.0
        entropy = -sum(n / total * math.log2(n / total) for n in self.counts.values())
        kinds = {"a" if "a" <= c <= "z" else "A" if "A" <= c <= "Z" else "0" if "0" <= c <= "9" else "." for c in self.counts}
        return 0.5 * len(kinds) + min(2.0, entropy / 2) - 1.5 * self.counts.get(" ", 0)


def literal_score(value: str) -> float:
    return Value(value).score()


def _operands(text: str, at: int, end: int) -> list[tuple[str, int, int, bool]]:
    """The operands of the expression at a position: (text, start, end, quoted)."""
    parts: list[tuple[str, int, int, bool]] = []
    at = _GAP.match(text, at, end).end()
    while True:
        if m := _STRING.match(text, at, end):
            k = m.lastindex or 1
            parts.append((m.group(k), m.start(k), m.end(k), True))
        elif m := _BARE.match(text, at, end):
            parts.append((m.group(), m.start(), m.end(), False))
        else:
            break
        at = m.end()
        if not (m := _JOIN.match(text, at, end)):
            break
        at = m.end()
    return parts


def _lex(text: str, at: int, end: int, held: dict[str, Value], found: dict[tuple[int, int], float], inside: bool = False) -> None:
    """Read the tokens from at to end, remember in held what names hold, and put literals of sensitive names into found."""
    target: str | None = None  # the name that an operator here would assign to
    waiting: list[str] = []  # names before it that get the same value: annotated (a: str = x) or chained (a = b = x)
    while m := _TOKEN.search(text, at, end):
        at, kind = m.end(), m.lastindex
        if kind == 4:
            target = m.group(4)
        elif kind == 6:
            target, waiting = None, []
        elif kind != 5:
            value = m.group(kind)
            if not inside and _OPERATOR.search(value):
                _lex(text, m.start(kind), m.end(kind), held, found, True)
            target = value if _NAME.fullmatch(value) else None
        elif target is not None:
            operator, parts = m.group(5), []
            operands = _operands(text, at, end)
            for value, start, stop, quoted in operands:
                if not quoted and value in held:
                    parts.append(held[value])
                elif stop > start and (quoted or any(c.isdigit() for c in value)):
                    parts.append(Value(value, ((start, stop),)))
            names = [target, *(waiting if operator == "=" else ())]
            target = None
            if not parts:
                waiting = names if len(operands) == 1 and not operands[0][3] else []
                continue
            waiting, whole = [], Value.joined(parts)
            for name in names:
                held[name] = whole
                held.setdefault(name.rsplit(".", 1)[-1], whole)
            points = max(map(name_score, names))
            if points >= 1.5 and (score := points + whole.score()) >= THRESHOLD:
                _mark(whole, score, found)


def _mark(value: Value, score: float, found: dict[tuple[int, int], float]) -> None:
    todo = [value]
    while todo:
        value = todo.pop()
        if not value.marked:
            value.marked = True
            for span in value.spans:
                found.setdefault(span, score)
            todo += value.parts


def lexed(text: str) -> list[tuple[int, int, float]]:
    """(start, end, score) of literals that reach a sensitive name, directly or through constants."""
    held: dict[str, Value] = {}
    found: dict[tuple[int, int], float] = {}
    at = 0
    while m := _OPERATOR.search(text, at):
        end = text.find("\n", m.end())
        end = len(text) if end < 0 else end
        _lex(text, text.rfind("\n", 0, m.start()) + 1, end, held, found)
        at = end
    return [(s, e, round(x, 3)) for (s, e), x in found.items()]


def scan_text(text: str | None) -> list[tuple[str, int, int, float]]:
    """All spans of one text by start, then kind as listed in KINDS; positions are code points, ends exclusive."""
    if not text:
        return []
    spans = [("assign", m.start(), m.end(), 5.0) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        spans += [("access", m.start(), m.end(), 5.0) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    spans += [("hex", m.start(), m.end(), 4.0) for m in HEX.finditer(text)]
    if "=" in text or ":" in text:
        spans += [("named", s, e, x) for s, e, x in lexed(text)]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def redact_text(text: str | None, mark: str = "[secret]") -> str | None:
    """The text with every span, overlapping ones joined, replaced by a mark."""
    if not text:
        return text
    out, last = [], 0
    for _, start, end, _ in scan_text(text):
        if end <= last:
            continue
        if start >= last:
            out += [text[last:start], mark]
        last = end
    return "".join([*out, text[last:]]) if out else text


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Spans of every row: (id, spans array<struct<kind,start,end,score>>)."""
    kind = df.schema[id_col].dataType.simpleString()
    spans_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        spans = [[dict(zip(("kind", "start", "end", "score"), s, strict=True)) for s in scan_text(t.as_py())] for t in batch.column(1)]
        return pa.record_batch([batch.column(0), pa.array(spans, spans_type)], names=[id_col, "spans"])

    return map_arrow(df.select(id_col, text_col), run, f"`{id_col}` {kind}, spans array<struct<kind:string,start:bigint,end:bigint,score:double>>")


def redact(df: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """df with every secret in its texts replaced; length_col, where present, follows the new text."""
    length = df.columns.index(length_col) if length_col in df.columns else None
    at = df.columns.index(text_col)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(at).to_pylist()
        clean = [redact_text(t) for t in texts]
        columns = list(batch.columns)
        columns[at] = pa.array(clean, batch.schema.field(at).type)
        if length is not None:
            old = batch.column(length).to_pylist()
            columns[length] = pa.array([n if t is c or t == c else len(c) for n, t, c in zip(old, texts, clean, strict=True)], batch.schema.field(length).type)
        return pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return map_arrow(df, run, df.schema)


def digest(spans: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts and digests of scan()'s spans."""
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    text = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    base = F.filter("spans", lambda s: s["kind"] != "named")
    return spans.select(
        id_col,
        of("assign").alias("n_assign"),
        of("access").alias("n_access"),
        of("hex").alias("n_hex"),
        F.sha2(F.array_join(F.transform(base, text), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", text), ",").alias("spans"),
        of("named").alias("n_named"),
    )
