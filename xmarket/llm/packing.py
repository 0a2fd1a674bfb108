"""Lexical retrieval packing.

Texts become token ids (the tokenizers library, through caches of its results) and are written once, with what later
steps need: document counts per id (summed per task), a row number, and three sketch terms.  A sketch term is the term
of smallest rank among the document's in a fixed random order in which high ids, which are the rare ones, mostly come
first; related documents often share it.  Ordered by their sketch terms and then by row, documents are range-partitioned, so
related ones stand together at any corpus size and a hot text or term spreads over as many ranges as it needs.

Each task cuts its documents into shards of about ``shard_tokens`` tokens, one at a time, and builds a BM25 inverted index
over the token ids of each, with document frequencies of the whole corpus (one count per id of the vocabulary, which
bounds what is collected and sent).  A window starts with a seed document; all its terms are looked up, and unused
documents fill the window in order of their score, then in order of place.  A document that doesn't fit is cut, and its
rest seeds the next window.  So every window of a shard is full but the last, whose tokens are dealt to sequences of
powers of two: nothing is padded.

Defined results: a null or empty text has the end id only; rows with null or repeated ids are packed one by one;
ties in the score go to the earlier document; extra columns are ignored; an empty table gives no pieces.
Documents of any length are packed whole: each id lies in exactly one piece.
"""

from __future__ import annotations

import json
import re
import sys
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from xmarket.llm.bpe import byte_alphabet
from xmarket.llm.words import slices, using
from xmarket.session import written

END_ID, WINDOW = 1, 2048
CACHE_ENTRIES = 250_000  # of each of two generations
K1, B = 1.2, 0.75
SKETCH, SEED = 3, 20240917
TASK_SHARDS = 8  # shards that a task packs, one after the other


_PRETOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")  # fixed value: the file's pre-tokenizer
_UNUSUAL = re.compile(r"[\x00-\x1f\x7f-\xa0\u0180-\U0010ffff]|<\|")  # not plain Latin, or maybe a special token


class ChunkEncoder:
    """Ids of texts by the tokenizers library, which is asked once for each pre-token that is not in a cache.

    Texts are cut at ASCII spaces, which the pre-tokenizer drops anyway.  A piece of plain Latin letters, for which
    the normalizer only lowers case, is cut into pre-tokens here and each goes to the library's model; any other
    piece goes through the whole library.  The rules are those of the file, which is checked to have them.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = [(x["type"], x.get("pattern"), x.get("content")) for x in spec["normalizer"]["normalizers"]]
        split, bytewise = spec["pre_tokenizer"]["pretokenizers"]
        if steps != [("NFC", None, None), ("Replace", {"Regex": "\\s+"}, " "), ("Lowercase", None, None)] or split["pattern"] != {"Regex": _PRETOKEN.pattern} or bytewise["type"] != "ByteLevel":
            raise ValueError("the file's normalizer or pre-tokenizer is another one")
        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.no_truncation()
        self._tokenizer.no_padding()
        self._model = self._tokenizer.model
        self.vocabulary = self._tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = "<u2" if self.vocabulary <= 1 << 16 else "<u4"
        self._code = "H" if self.vocabulary <= 1 << 16 else "I"
        self._bytes = {b: c for c, b in byte_alphabet().items()}
        self._pretokens, self._chunks = _Memo(self._pretoken), _Memo(self._chunk)

    def _packed(self, ids: list[int]) -> bytes:
        out = array(self._code, ids)
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()

    def _pretoken(self, text: str) -> bytes:
        mapped = text if text.isascii() else text.encode().decode("latin-1").translate(self._bytes)
        return self._packed([t.id for t in self._model.tokenize(mapped)])

    def _chunk(self, data: bytes) -> bytes:
        text = data.decode()
        if "<|" in text if text.isascii() and text.isprintable() else _UNUSUAL.search(text):
            return self._packed(self._tokenizer.encode(text, add_special_tokens=False).ids)
        text, of = text.lower(), self._pretokens
        if text.isalpha():
            return of[text]
        if text[:-1].isalpha():
            return of[text[:-1]] + of[text[-1]]
        return b"".join([of[p] for p in _PRETOKEN.findall(text)])

    def forget(self) -> None:
        """Empty the caches."""
        self._pretokens, self._chunks = _Memo(self._pretoken), _Memo(self._chunk)

    def encode_batch(self, texts: list[str | None], end: int) -> list[bytes]:
        """Little-endian ids (dtype) of each text, the end id last."""
        self._chunks.age()
        self._pretokens.age()
        look, tail = self._chunks.__getitem__, self._packed([end])
        return [b"".join(map(look, t.encode().split())) + tail if t else tail for t in texts]


class _Memo(dict):
    """A dict that works out what it misses; what wasn't asked for in the last CACHE_ENTRIES is forgotten in age()."""

    def __init__(self, fn):
        super().__init__()
        self._fn, self._old = fn, {}

    def __missing__(self, key):
        value = self._old.get(key)
        if value is None:
            value = self._fn(key)
        self[key] = value
        return value

    def age(self) -> None:
        if len(self) > CACHE_ENTRIES:
            self._old = dict(self)
            self.clear()


@lru_cache(maxsize=2)
def encoder(path: str) -> ChunkEncoder:
    return ChunkEncoder(path)


@lru_cache(maxsize=2)
def term_orders(vocabulary: int) -> np.ndarray:
    """SKETCH orders of the ids: in each, an id's chance to come before another is in proportion to its number, as rare ids have high numbers."""
    waits = np.random.default_rng(SEED).exponential(size=(SKETCH, vocabulary)) / np.arange(1, vocabulary + 1)
    return np.argsort(np.argsort(waits, axis=1), axis=1).astype(np.int32)


def tokenize(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end: int = END_ID) -> DataFrame:
    """(id, ids binary, n, row, t0, t1, t2) of every row: ids as 16-bit numbers if the vocabulary allows, else 32-bit;
    and a row a task with null ids and its documents per id (counts)."""
    kind = df.schema[id_col].dataType.simpleString()
    width, vocabulary = np.dtype(encoder(path).dtype).itemsize, encoder(path).vocabulary
    names = [id_col, "ids", "n", "row", *(f"t{k}" for k in range(SKETCH)), "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, orders = encoder(path), term_orders(vocabulary)
        using(own, own.forget)
        row, counts = TaskContext.get().partitionId() << 40, np.zeros(vocabulary, np.int64)
        kind_of_id = None
        for batch in batches:
            kind_of_id = batch.schema.field(0).type
            for part in slices(batch):
                ids = own.encode_batch(part.column(1).to_pylist(), end)
                sizes = np.array([len(x) // width for x in ids], np.int64)
                flat, ends = np.frombuffer(b"".join(ids), own.dtype), np.cumsum(sizes)
                terms = [np.minimum.reduceat(order[flat], ends - sizes) for order in orders]
                for at, to in zip((ends - sizes).tolist(), ends.tolist(), strict=True):
                    counts[flat[at:to]] += 1  # a document counts once for each of its ids: a repeated index adds once
                rows = np.arange(row, row + len(ids))
                row += len(ids)
                yield pa.record_batch([part.column(0), pa.array(ids, pa.binary()), pa.array(sizes), pa.array(rows), *map(pa.array, terms), pa.nulls(len(ids), pa.binary())], names=names)
        if kind_of_id is not None:
            empty = [pa.nulls(1, kind_of_id), pa.nulls(1, pa.binary()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), *(pa.nulls(1, pa.int32()) for _ in orders)]
            yield pa.record_batch([*empty, pa.array([counts.tobytes()], pa.binary())], names=names)

    return df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, ids binary, n long, row long, {', '.join(f't{k} int' for k in range(SKETCH))}, counts binary")


def _document_frequencies(tokens: DataFrame, vocabulary: int) -> np.ndarray:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(vocabulary, np.int64)
        for batch in batches:
            for counts in batch.column(0).to_pylist():
                df += np.frombuffer(counts, np.int64)
        at = np.flatnonzero(df)
        yield pa.record_batch([pa.array(at, pa.int64()), pa.array(df[at])], names=["id", "df"])

    out = np.zeros(vocabulary, np.int64)
    found = tokens.where(F.col("counts").isNotNull()).select("counts").mapInArrow(run, "id long, df long").groupBy("id").agg(F.sum("df").alias("df"))
    for r in found.collect():
        out[r["id"]] = r["df"]  # at most a row for each id of the vocabulary
    return out


class Index:
    """BM25 inverted index of a shard's documents."""

    def __init__(self, docs: list[np.ndarray], idf: np.ndarray, average: float):
        lengths = np.array([len(d) for d in docs], np.int64)
        width = np.int64(len(idf))
        keys, tf = np.unique(np.concatenate([np.repeat(np.arange(len(docs), dtype=np.int64), lengths) * width + np.concatenate(docs).astype(np.int64)]), return_counts=True)
        doc, term = np.divmod(keys, width)
        weight = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * lengths[doc] / max(average, 1.0)))
        self.starts = np.searchsorted(doc, np.arange(len(docs) + 1))
        self.term, self.weight = term, weight
        order = np.argsort(term, kind="stable")
        self.doc_of, self.weight_of = doc[order], weight[order]
        self.postings = np.searchsorted(term[order], np.arange(len(idf) + 1))
        self.n = len(docs)
        # terms that an eighth of the documents have or more: a row of weights each, which add up faster than postings
        common = np.flatnonzero(np.diff(self.postings) * 8 >= self.n)
        self.row_of = np.full(len(idf), -1, np.int64)
        self.row_of[common] = np.arange(len(common))
        self.rows = np.zeros((len(common), self.n))
        found = self.row_of[term] >= 0
        self.rows[self.row_of[term[found]], doc[found]] = weight[found]

    def scores(self, seed: int) -> np.ndarray:
        """BM25 of every document for all terms of the seed."""
        mine = self.term[self.starts[seed] : self.starts[seed + 1]]
        rows = self.row_of[mine]
        start, end = self.postings[mine[rows < 0]], self.postings[mine[rows < 0] + 1]
        n = end - start
        at = np.repeat(start - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
        return self.rows[rows[rows >= 0]].sum(axis=0) + np.bincount(self.doc_of[at], self.weight_of[at], self.n)


def pack_shard(docs: list[np.ndarray], idf: np.ndarray, average: float, window: int = WINDOW) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of one shard."""
    index = Index(docs, idf, average)
    unused, at = np.ones(len(docs), bool), 0
    pieces: list[tuple[int, int, int, int, int]] = []
    sequence, filled = 0, 0
    rest: tuple[int, int] | None = None  # a cut document and where it goes on

    def put(doc: int, start: int) -> tuple[int, int] | None:
        nonlocal sequence, filled
        take = min(window - filled, len(docs[doc]) - start)
        pieces.append((doc, start, take, sequence, filled))
        filled += take
        if filled == window:
            sequence, filled = sequence + 1, 0
        return (doc, start + take) if start + take < len(docs[doc]) else None

    while True:
        if rest is None:
            while at < len(docs) and not unused[at]:
                at += 1
            if at == len(docs):
                break
            seed, start = at, 0
            unused[at] = False
        else:
            seed, start = rest
        rest = put(seed, start)
        if rest is not None or filled == 0:
            continue
        scores = np.where(unused, index.scores(seed), 0.0)
        found = 8
        while filled and rest is None:
            top = np.argpartition(-scores, found)[:found] if found < len(scores) else np.arange(len(scores))
            top = top[scores[top] > 0]
            if not len(top):
                break
            for d in top[np.lexsort((top, -scores[top]))].tolist():
                unused[d], scores[d] = False, 0.0
                rest = put(d, 0)
                if rest is not None or filled == 0:
                    break
            found *= 2
        while filled and rest is None:  # no document shares a term: go on in order
            while at < len(docs) and not unused[at]:
                at += 1
            if at == len(docs):
                break
            unused[at] = False
            rest = put(at, 0)
    return _powers(pieces, sequence, filled)


def _powers(pieces: list[tuple[int, int, int, int, int]], last: int, filled: int) -> list[tuple[int, int, int, int, int]]:
    """Deal the last, partly filled sequence to sequences of powers of two, largest first."""
    if not filled or filled & (filled - 1) == 0:
        return pieces
    out = [p for p in pieces if p[3] != last]
    ends, total = [], 0
    for bit in range(filled.bit_length() - 1, -1, -1):
        if filled >> bit & 1:
            total += 1 << bit
            ends.append(total)
    for doc, start, length, _, offset in (p for p in pieces if p[3] == last):
        done = 0
        while done < length:
            k = next(i for i, e in enumerate(ends) if offset + done < e)
            take = min(length - done, ends[k] - offset - done)
            out.append((doc, start + done, take, last + k, offset + done - (ends[k - 1] if k else 0)))
            done += take
    return out


def pack(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, shard_tokens: int = 1_000_000, end: int = END_ID) -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids binary of 32-bit numbers) of every piece."""
    kind = df.schema[id_col].dataType.simpleString()
    vocabulary, dtype = encoder(path).vocabulary, encoder(path).dtype
    tokens = written(tokenize(df, path, id_col, text_col, end), "tokens")
    docs = tokens.where(F.col("ids").isNotNull())
    whole = docs.agg(F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("tokens")).first()
    frequency = _document_frequencies(tokens, vocabulary)
    idf = np.log1p((whole["docs"] - frequency + 0.5) / (frequency + 0.5))
    average = whole["tokens"] / max(1, whole["docs"])
    sent = df.sparkSession.sparkContext.broadcast((idf, average))  # one number for each id of the vocabulary

    def shard(ids: list[pa.Scalar], docs: list[np.ndarray], first: int) -> pa.RecordBatch:
        rows = pack_shard(docs, *sent.value, window)
        parts = [docs[d][s : s + n].astype("<u4").tobytes() for d, s, n, _, _ in rows]
        column = lambda k: pa.array([r[k] for r in rows], pa.int64())
        return pa.record_batch(
            [
                ids.take(pa.array([r[0] for r in rows], pa.int64())), column(1), column(2), pa.array([zlib.crc32(x) for x in parts], pa.int64()),
                pa.array([len(docs[r[0]]) for r in rows], pa.int64()), pa.array([first + r[3] for r in rows], pa.int64()), column(4), pa.array(parts, pa.binary()),
            ],
            names=[id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        using(None)
        first, held, docs, size = TaskContext.get().partitionId() << 40, [], [], 0
        for batch in batches:
            start = 0
            for i, data in enumerate(batch.column(1).to_pylist()):
                docs.append(np.frombuffer(data, dtype))
                size += len(docs[-1])
                if size >= shard_tokens:
                    yield (out := shard(pa.concat_arrays([*held, batch.column(0).slice(start, i + 1 - start)]), docs, first))
                    first = max(out["sequence_id"].to_pylist()) + 1
                    held, docs, size, start = [], [], 0, i + 1
            if start < batch.num_rows:
                held.append(batch.column(0).slice(start))
        if docs:
            yield shard(pa.concat_arrays(held), docs, first)

    order = [*(f"t{k}" for k in range(SKETCH)), "row"]
    tasks = max(1, -(-whole["tokens"] // (TASK_SHARDS * shard_tokens)))
    dealt = docs.select(id_col, "ids", *order).repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    schema = f"`{id_col}` {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
    return dealt.select(id_col, "ids").mapInArrow(run, schema)
