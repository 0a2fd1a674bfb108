"""Byte-level BPE by a pair occurrence index.

The distinct pre-tokens of a batch are laid out in one symbol sequence.  An index maps every adjacent
pair that has a rank to all its positions; ranks that are present sit in a heap and are applied in
ascending order, each to all its positions at once, and every merge updates only the lists of the
pairs it destroys and creates.  In a vocabulary whose tokens each come from one merge, a pair's rank is
above the ranks of the merges that made its halves, so this order gives exactly the merges that a word
by word encoder makes; the vocabulary is checked for that when it is loaded.

Results of pre-tokens are kept in a bounded cache of the Python worker.  Tokenizer files stay where they
are; their path is a parameter.  Defined results: a null text counts as empty (no ids); special token
strings inside texts are special tokens, as in the library; a null id keeps its row; repeated rows give
repeated rows; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import json
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from xmarket.llm.words import hexdigest, map_arrow

#: Fixed value: the pre-token pattern of byte-level BPE.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CACHE_ENTRIES = 700_000


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in vocabulary files: printable Latin-1 stands for itself, others from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {chr(b): b for b in own}
    for i, b in enumerate(b for b in range(256) if b not in set(own)):
        table[chr(0x100 + i)] = b
    return table


class Codec:
    """Encoder and decoder for one vocabulary file of the tokenizers library (byte-level BPE)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or not pre.get("use_regex", True) or pre.get("add_prefix_space") or spec["normalizer"]:
            raise ValueError("only plain byte-level BPE files are supported")
        to_byte = byte_alphabet()
        raw = {token: bytes(to_byte[c] for c in token) for token in model["vocab"]}
        self.bytes_of: dict[int, bytes] = {i: raw[token] for token, i in model["vocab"].items()}
        self.byte_id = [0] * 256
        for token, i in model["vocab"].items():
            if len(raw[token]) == 1:
                self.byte_id[raw[token][0]] = i
        self.ranks: dict[tuple[int, int], int] = {}
        self.merged: list[int] = []
        self.pairs: list[tuple[int, int]] = []
        made: dict[int, int] = {}
        for rank, (a, b) in enumerate(tuple(m.split(" ")) if isinstance(m, str) else m for m in model["merges"]):
            left, right, to = model["vocab"][a], model["vocab"][b], model["vocab"][a + b]
            if made.get(left, -1) > rank or made.get(right, -1) > rank or to in made:
                raise ValueError("a token comes from more than one merge: ascending ranks would not be exact")
            made[to] = rank
            self.ranks[left, right] = rank
            self.pairs.append((left, right))
            self.merged.append(to)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of |= {i: s.encode() for s, i in self.special.items()}
        names = sorted(self.special, key=len, reverse=True)
        self._special = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self._pattern = regex.compile(PATTERN)
        self._cache: dict[str, tuple[int, ...]] = {s: (i,) for s, i in self.special.items()}

    def pretokens(self, text: str) -> list[str]:
        if self._special is not None and any(s in text for s in self.special):
            out: list[str] = []
            for piece in self._special.split(text):
                out += [piece] if piece in self.special else self._pattern.findall(piece)
            return out
        return self._pattern.findall(text)

    def _merge(self, words: list[bytes]) -> list[tuple[int, ...]]:
        """Encode distinct pre-tokens together by the pair occurrence index."""
        byte_id, ranks, merged, pairs = self.byte_id, self.ranks, self.merged, self.pairs
        sym: list[int] = []
        starts: list[int] = []
        for w in words:
            starts.append(len(sym))
            sym += [byte_id[b] for b in w]
            sym.append(-1)  # no pair crosses the end of a word
        nxt, prv = list(range(1, len(sym) + 1)), list(range(-1, len(sym) - 1))
        index: dict[int, list[int]] = {}
        get = ranks.get
        for at, pair in enumerate(zip(sym, sym[1:], strict=False)):
            if (rank := get(pair)) is not None:
                index.setdefault(rank, []).append(at)
        heap = list(index)
        heapq.heapify(heap)
        end = len(sym)
        while heap:
            rank = heapq.heappop(heap)
            (left, right), to = pairs[rank], merged[rank]
            places = index.pop(rank)
            places.sort()
            for at in places:  # ascending, so that runs of one symbol merge from the left
                if sym[at] != left or (b := nxt[at]) >= end or sym[b] != right:
                    continue  # an earlier merge took one of its halves
                sym[at], sym[b] = to, -2
                after = nxt[at] = nxt[b]
                if after < end:
                    prv[after] = at
                    new = get((to, sym[after]))
                    if new is not None:
                        if new in index:
                            index[new].append(at)
                        else:
                            index[new] = [at]
                            heapq.heappush(heap, new)
                before = prv[at]
                if before >= 0:
                    new = get((sym[before], to))
                    if new is not None:
                        if new in index:
                            index[new].append(before)
                        else:
                            index[new] = [before]
                            heapq.heappush(heap, new)
        starts.append(len(sym))
        return [tuple(s for s in sym[a : b - 1] if s >= 0) for a, b in zip(starts, starts[1:], strict=False)]

    def encode_batch(self, texts: list[str | None]) -> list[list[int]]:
        split = [self.pretokens(t) if t else [] for t in texts]
        cache = self._cache
        fresh = {p for words in split for p in words if p not in cache}
        if len(cache) + len(fresh) > CACHE_ENTRIES:
            keep = {s: (i,) for s, i in self.special.items()}
            cache.clear()
            cache |= keep
            fresh = {p for words in split for p in words if p not in cache}
        missing = list(fresh)
        for p, ids in zip(missing, self._merge([p.encode("utf-8", "surrogatepass") for p in missing]), strict=True):
            cache[p] = ids
        out = []
        for words in split:
            ids: list[int] = []
            for p in words:
                ids += cache[p]
            out.append(ids)
        return out

    def decode_batch(self, ids: list[list[int]]) -> list[str]:
        of = self.bytes_of.__getitem__
        return [b"".join(map(of, x)).decode("utf-8", "replace") for x in ids]


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One codec per worker process and file."""
    return Codec(path)


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>) of every row."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.record_batch([batch.column(0), pa.array(codec(path).encode_batch(batch.column(1).to_pylist()), pa.list_(pa.int32()))], names=[id_col, "ids"])

    return map_arrow(df.select(id_col, text_col), run, f"`{id_col}` {kind}, ids array<int>")


def decode(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text) of rows of ids."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = [x or [] for x in batch.column(1).to_pylist()]
        return pa.record_batch([batch.column(0), pa.array(codec(path).decode_batch(ids), pa.string())], names=[id_col, "text"])

    return map_arrow(df.select(id_col, ids_col), run, f"`{id_col}` {kind}, text string")


def digest(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode, decode the ids again, and give counts and digests; ids and texts never leave the worker."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        own, texts = codec(path), batch.column(1).to_pylist()
        n, ids_sha, text_sha = [], [], []
        for at in range(0, len(texts), 256):
            ids = own.encode_batch(texts[at : at + 256])
            for x, back in zip(ids, own.decode_batch(ids), strict=True):
                n.append(len(x))
                ids_sha.append(hexdigest(",".join(map(str, x)).encode()))
                text_sha.append(hexdigest(back.encode()))
        return pa.record_batch([batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha), pa.array(text_sha)], names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    return map_arrow(df.select(id_col, text_col), run, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
