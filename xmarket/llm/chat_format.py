"""Chat formatting by a template compiler.

A small sandboxed template language is parsed into a syntax tree, constants are folded, and the tree
becomes nested Python closures that render a conversation and record the code points written inside
``{% generation %}`` blocks (the loss mask).  Templates see only the context they are given: no calls,
no imports, no attributes of Python objects, only keys of dicts and the filters listed in FILTERS.

Language: text, ``{{ expr }}``, ``{% for x in expr %}``, ``{% if %}/{% elif %}/{% else %}``,
``{% set x = expr %}``, ``{% generation %}``, ``{# comment #}``; expressions with literals, names,
``.key``, ``[expr]``, ``not and or == != < > in ~ +`` and ``| filter``; ``loop.index0/first/last``.

Defined results: rows are ordered by (turn, role, text), nulls first; a null text or role counts as
empty; rows whose id is null form one conversation; repeated rows are repeated turns; extra columns are
ignored; an empty table gives no conversation.  A conversation is one output row, so its turns meet in
one task, whatever their number; texts are never cut.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from xmarket.llm.words import hexdigest, map_arrow

CONTROL = ("<s>", "</s>", "[INST]", "[/INST]")
_ESCAPE = re.compile("|".join(map(re.escape, ("\\", *CONTROL))))
_UNESCAPE = re.compile(r"\\(\\?)")


def escape(text: str) -> str:
    """Make control strings of a text harmless: a backslash goes behind their first character; backslashes double."""
    return _ESCAPE.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


DEFAULT_TEMPLATE = (
    "{# every turn: <s>[INST]role[/INST]text</s> #}{% for m in messages %}{{ '<s>' ~ '[INST]' }}{{ m.role | escape }}{{ '[/INST]' }}"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}{% else %}{{ m.text | escape }}{% endif %}"
    "{{ '</s>' }}{% endfor %}"
)
FILTERS: dict[str, Callable[[Any], Any]] = {"escape": escape, "trim": str.strip, "upper": str.upper, "lower": str.lower, "length": len, "string": str}


class TemplateError(ValueError):
    pass


_TOKEN = re.compile(r"\s*(?:(?P<str>'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(?P<num>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|<=|>=|[<>~+|.\[\]()]))")
_PIECE = re.compile(r"\{\{(.*?)\}\}|\{%-?(.*?)-?%\}|\{#.*?#\}", re.S)
_ESCAPES = {"n": "\n", "t": "\t", "\\": "\\", "'": "'", '"': '"'}
_BINARY = {
    "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "<": lambda a, b: a < b, ">": lambda a, b: a > b, "<=": lambda a, b: a <= b,
    ">=": lambda a, b: a >= b, "in": lambda a, b: a in b, "~": lambda a, b: f"{_text(a)}{_text(b)}", "+": lambda a, b: a + b,
}


def _text(value: Any) -> str:
    return "" if value is None else str(value)


class _Parser:
    """Expressions and blocks to a syntax tree of tuples: (kind, ...)."""

    def __init__(self, source: str):
        self.pieces: list[tuple[str, str]] = []
        at = 0
        for m in _PIECE.finditer(source):
            if m.start() > at:
                self.pieces.append(("text", source[at : m.start()]))
            if m[1] is not None:
                self.pieces.append(("expr", m[1]))
            elif m[2] is not None:
                self.pieces.append(("tag", m[2].strip()))
            at = m.end()
        if at < len(source):
            self.pieces.append(("text", source[at:]))
        self.i = 0

    def block(self, ends: tuple[str, ...] = ()) -> tuple[list, str]:
        out: list = []
        while self.i < len(self.pieces):
            kind, body = self.pieces[self.i]
            self.i += 1
            if kind == "text":
                out.append(("const", body))
            elif kind == "expr":
                out.append(("print", self.expression(body)))
            else:
                word, _, rest = body.partition(" ")
                if word in ends:
                    return out, body
                out.append(self.tag(word, rest.strip()))
        if ends:
            raise TemplateError(f"missing {' or '.join(ends)}")
        return out, ""

    def tag(self, word: str, rest: str) -> tuple:
        if word == "for":
            m = re.fullmatch(r"([A-Za-z_]\w*)\s+in\s+(.+)", rest, re.S)
            if not m:
                raise TemplateError(f"bad for: {rest}")
            body, _ = self.block(("endfor",))
            return ("for", m[1], self.expression(m[2]), body)
        if word == "if":
            arms, test = [], self.expression(rest)
            while True:
                body, end = self.block(("elif", "else", "endif"))
                arms.append((test, body))
                word, _, rest = end.partition(" ")
                if word == "elif":
                    test = self.expression(rest)
                elif word == "else":
                    test = ("const", True)
                else:
                    return ("if", arms)
        if word == "set":
            m = re.fullmatch(r"([A-Za-z_]\w*)\s*=(.+)", rest, re.S)
            if not m:
                raise TemplateError(f"bad set: {rest}")
            return ("set", m[1], self.expression(m[2]))
        if word == "generation":
            return ("generation", self.block(("endgeneration",))[0])
        raise TemplateError(f"unknown tag {word!r}")

    def expression(self, source: str) -> tuple:
        tokens: list[tuple[str, str]] = []
        at, source = 0, source.strip()
        while at < len(source):
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"bad expression: {source!r}")
            tokens.append((m.lastgroup or "", m[m.lastgroup or ""]))
            at = m.end()
        tree, rest = self._or(tokens)
        if rest:
            raise TemplateError(f"unexpected {rest[0][1]!r} in {source!r}")
        return tree

    def _or(self, t: list) -> tuple[tuple, list]:
        left, t = self._and(t)
        while t and t[0] == ("name", "or"):
            right, t = self._and(t[1:])
            left = ("or", left, right)
        return left, t

    def _and(self, t: list) -> tuple[tuple, list]:
        left, t = self._not(t)
        while t and t[0] == ("name", "and"):
            right, t = self._not(t[1:])
            left = ("and", left, right)
        return left, t

    def _not(self, t: list) -> tuple[tuple, list]:
        if t and t[0] == ("name", "not"):
            inner, t = self._not(t[1:])
            return ("not", inner), t
        left, t = self._sum(t)
        if t and (t[0][1] in ("==", "!=", "<", ">", "<=", ">=") or t[0] == ("name", "in")):
            op = t[0][1]
            right, t = self._sum(t[1:])
            return ("binary", op, left, right), t
        return left, t

    def _sum(self, t: list) -> tuple[tuple, list]:
        left, t = self._filtered(t)
        while t and t[0] in (("op", "~"), ("op", "+")):
            op = t[0][1]
            right, t = self._filtered(t[1:])
            left = ("binary", op, left, right)
        return left, t

    def _filtered(self, t: list) -> tuple[tuple, list]:
        left, t = self._atom(t)
        while t:
            if t[0] == ("op", "|") and len(t) > 1 and t[1][0] == "name":
                if t[1][1] not in FILTERS:
                    raise TemplateError(f"unknown filter {t[1][1]!r}")
                left, t = ("filter", t[1][1], left), t[2:]
            elif t[0] == ("op", ".") and len(t) > 1 and t[1][0] == "name":
                left, t = ("key", left, ("const", t[1][1])), t[2:]
            elif t[0] == ("op", "["):
                key, t = self._or(t[1:])
                if not t or t[0] != ("op", "]"):
                    raise TemplateError("missing ]")
                left, t = ("key", left, key), t[1:]
            else:
                break
        return left, t

    def _atom(self, t: list) -> tuple[tuple, list]:
        if not t:
            raise TemplateError("an operand is missing")
        (kind, value), t = t[0], t[1:]
        if kind == "str":
            return ("const", re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[0]), value[1:-1])), t
        if kind == "num":
            return ("const", int(value)), t
        if kind == "name":
            return ("const", {"true": True, "false": False, "none": None}[value]) if value in ("true", "false", "none") else ("name", value), t
        if value == "(":
            inner, t = self._or(t)
            if not t or t[0] != ("op", ")"):
                raise TemplateError("missing )")
            return inner, t[1:]
        raise TemplateError(f"unexpected {value!r}")


def fold(tree: Any) -> Any:
    """Fold constants: expressions of constants become their value, constant tests choose their arm, text pieces join."""
    if isinstance(tree, list):
        out: list = []
        for node in map(fold, tree):
            if node[0] == "print" and node[1][0] == "const":
                node = ("const", _text(node[1][1]))
            taken = node[1][0][1] if node[0] == "if" and node[1] and node[1][0][0] == ("const", True) else [node]
            for x in taken:
                if x[0] == "const" and out and out[-1][0] == "const":
                    out[-1] = ("const", out[-1][1] + x[1])
                elif x != ("const", "") and x != ("if", []):
                    out.append(x)
        return out
    kind = tree[0]
    if kind in ("const", "name"):
        return tree
    if kind == "print":
        return ("print", fold(tree[1]))
    if kind == "for":
        return ("for", tree[1], fold(tree[2]), fold(tree[3]))
    if kind == "set":
        return ("set", tree[1], fold(tree[2]))
    if kind == "generation":
        return ("generation", fold(tree[1]))
    if kind == "if":
        arms = [(fold(a), fold(b)) for a, b in tree[1]]
        arms = [(("const", bool(a[1])) if a[0] == "const" else a, b) for a, b in arms]
        return ("if", [x for x in arms if x[0] != ("const", False)])
    parts = [fold(x) if isinstance(x, tuple) else x for x in tree]
    if all(x[0] == "const" for x in parts if isinstance(x, tuple)):
        return ("const", _expr(tuple(parts))({}))
    return tuple(parts)


def _expr(tree: tuple) -> Callable[[dict], Any]:
    kind = tree[0]
    if kind == "const":
        value = tree[1]
        return lambda env: value
    if kind == "name":
        name = tree[1]
        return lambda env: env.get(name)
    if kind == "key":
        of, key = _expr(tree[1]), _expr(tree[2])

        def lookup(env: dict) -> Any:
            value = of(env)
            return value.get(key(env)) if type(value) is dict else None

        return lookup
    if kind == "filter":
        fn, inner = FILTERS[tree[1]], _expr(tree[2])
        return lambda env: fn(inner(env))
    if kind == "not":
        inner = _expr(tree[1])
        return lambda env: not inner(env)
    if kind in ("and", "or"):
        a, b = _expr(tree[1]), _expr(tree[2])
        return (lambda env: a(env) and b(env)) if kind == "and" else (lambda env: a(env) or b(env))
    fn, a, b = _BINARY[tree[1]], _expr(tree[2]), _expr(tree[3])
    return lambda env: fn(a(env), b(env))


class _Out:
    """Pieces written so far, their code points, and the marked ranges."""

    __slots__ = ("marks", "n", "pieces")

    def __init__(self) -> None:
        self.pieces: list[str] = []
        self.n = 0
        self.marks: list[tuple[int, int]] = []

    def write(self, text: str) -> None:
        self.pieces.append(text)
        self.n += len(text)


def _node(tree: tuple) -> Callable[[dict, _Out], None]:
    kind = tree[0]
    if kind == "const":
        text = tree[1]
        return lambda env, out: out.write(text)
    if kind == "print":
        value = _expr(tree[1])
        return lambda env, out: out.write(_text(value(env)))
    if kind == "set":
        name, value = tree[1], _expr(tree[2])
        return lambda env, out: env.__setitem__(name, value(env))
    if kind == "generation":
        body = _body(tree[1])

        def marked(env: dict, out: _Out) -> None:
            start = out.n
            body(env, out)
            out.marks.append((start, out.n))

        return marked
    if kind == "if":
        arms = [(_expr(a), _body(b)) for a, b in tree[1]]

        def choose(env: dict, out: _Out) -> None:
            for test, then in arms:
                if test(env):
                    then(env, out)
                    return

        return choose
    name, items, body = tree[1], _expr(tree[2]), _body(tree[3])

    def loop(env: dict, out: _Out) -> None:
        rows = list(items(env) or ())
        inner = dict(env)
        for i, row in enumerate(rows):
            inner[name] = row
            inner["loop"] = {"index0": i, "index": i + 1, "first": i == 0, "last": i == len(rows) - 1}
            body(inner, out)

    return loop


def _body(nodes: Iterable[tuple]) -> Callable[[dict, _Out], None]:
    steps = [_node(n) for n in nodes]

    def run(env: dict, out: _Out) -> None:
        for step in steps:
            step(env, out)

    return run


class Template:
    """A compiled template: render(**context) gives the text and the loss mask's [start, end) code points."""

    def __init__(self, source: str = DEFAULT_TEMPLATE):
        self.source = source
        self.tree = fold(_Parser(source).block()[0])
        self._run = _body(self.tree)

    def __reduce__(self):  # closures aren't pickled; executors compile anew
        return Template, (self.source,)

    def render(self, **context: Any) -> tuple[str, list[tuple[int, int]]]:
        out = _Out()
        self._run(dict(context), out)
        return "".join(out.pieces), out.marks


_TURN = re.compile(r"<s>\[INST\](.*?)\[/INST\](.*?)</s>", re.S)


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The turns of a text that DEFAULT_TEMPLATE rendered: (role, text), unescaped."""
    turns, at = [], 0
    for m in _TURN.finditer(formatted):
        if m.start() != at:
            raise ValueError(f"text between turns at {at}")
        turns.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    if at != len(formatted):
        raise ValueError(f"text after the last turn at {at}")
    return turns


def format_conversations(df: DataFrame, template: str = DEFAULT_TEMPLATE, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: (id, formatted string, loss array<struct<start,end>>)."""
    compiled = Template(template)
    kind = df.schema[id_col].dataType.simpleString()
    turn = F.struct(F.col(turn_col).alias("turn"), F.coalesce(role_col, F.lit("")).alias("role"), F.coalesce(text_col, F.lit("")).alias("text"))
    grouped = df.groupBy(F.col(id_col)).agg(F.transform(F.sort_array(F.collect_list(turn)), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("messages"))
    loss_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, marks = [], []
        for messages in batch.column(1).to_pylist():
            text, loss = compiled.render(messages=messages)
            texts.append(text)
            marks.append([{"start": a, "end": b} for a, b in loss])
        return pa.record_batch([batch.column(0), pa.array(texts, pa.string()), pa.array(marks, loss_type)], names=[id_col, "formatted", "loss"])

    return map_arrow(grouped, run, f"`{id_col}` {kind}, formatted string, loss array<struct<start:bigint,end:bigint>>")


def digest(formatted: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """Read format_conversations()' rows back and digest the turns and the text under the loss mask."""
    kind = formatted.schema[id_col].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for text, loss in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            turns = read_back(text)
            masked = "".join(unescape(text[x["start"] : x["end"]]) for x in loss)
            rows.append((len(turns), hexdigest("".join(f"{r}\n{t}\n" for r, t in turns).encode()), len(masked), hexdigest(masked.encode()), len(text)))
        n, turns_sha, loss_n, loss_sha, total = map(list, zip(*rows, strict=True))
        return pa.record_batch(
            [batch.column(0), pa.array(n, pa.int64()), pa.array(turns_sha), pa.array(loss_n, pa.int64()), pa.array(loss_sha), pa.array(total, pa.int64())],
            names=[id_col, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
        )

    return map_arrow(formatted.select(id_col, "formatted", "loss"), run, f"`{id_col}` {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
