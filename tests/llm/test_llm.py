"""The ten operators against brute force, exact round trips and held-out accuracy, and their edge cases."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import xxhash
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest import SF
from xmarket.llm import bpe, chat_format, embedding_dedup, language_id, near_copies, packing, quality, queries, secret_scan, sharding, simhash, substring_dedup

DOCS = "doc_id long, text string, lang string, source string, n_chars long, n_words int, fp int, shard int"
WEIRD = [None, "", " \t\n\v\f\r ", "a", "É ß ǅ  x\x1cy", "x" * 5000, "w " * 3000, "<|endoftext|> </s>[INST] \\ AKIA", "same words here", "same words here"]


def docs(spark, texts, first_id=0):
    rows = [(first_id + i, t, None if i % 3 == 0 else "en", None, None, 1, 2, 3) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def weird(spark):
    """Nulls in every column, empty and long texts, repeated rows, and columns with clashing names."""
    d = docs(spark, WEIRD)
    return d.union(d.where("doc_id = 8")).union(spark.createDataFrame([(None,) * 8, (None, "no id", "en", "s", 5, None, None, None)], DOCS))


def real():
    return pd.read_parquet(f"{SF}/documents.parquet").sort_values("doc_id").reset_index(drop=True)


def roots(n, pairs):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


# --- 1: substring dedup ---


def brute_substring(texts, window=35):
    words = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        cover = np.zeros(len(w), bool)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                cover[i : i + window] = True
        kept = b" ".join(x for x, c in zip(w, cover, strict=True) if not c)
        out.append((len(w), int(cover.sum()), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("limit", [20_000, 1])
def test_op1_on_made_texts(spark, limit):
    """Few words, periods, passages shared in several contexts; a limit of 1 takes every group the long way."""
    rng = random.Random(7)
    passage = " ".join(rng.choice("abcdefgh") + str(rng.randint(0, 9)) for _ in range(50))
    texts = [" ".join(rng.choice("ab") for _ in range(rng.randint(30, 90))) for _ in range(12)] + ["x y z " * 40, "x y z " * 40, None, "", "one two"]
    texts += [" ".join(f"{i}_{j}" for j in range(rng.randint(0, 40))) + " " + passage + " " + " ".join(f"{i}-{j}" for j in range(20)) for i in range(8)]
    got = substring_dedup.digest(substring_dedup.ranges(docs(spark, texts), group_limit=limit)).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in got] == brute_substring(texts)


@pytest.mark.parametrize("limit", [2, 6])
def test_op1_divides_groups_by_longer_prefixes(spark, limit):
    """One passage of 34 words before many endings, so that groups differ after 12, 24 or 35 words; some endings repeat."""
    rng = random.Random(11)
    head = [f"h{i}" for i in range(34)]
    texts = [" ".join(head[rng.choice((0, 10, 20)) :] + [f"t{rng.randint(0, 5)}" for _ in range(rng.randint(1, 40))]) for _ in range(60)]
    texts += [" ".join(head + ["t1", "t2"]), " ".join(["before"] + head + ["t1"]), " ".join(head)]
    got = substring_dedup.digest(substring_dedup.ranges(docs(spark, texts), group_limit=limit)).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in got] == brute_substring(texts)
    assert any(r.n_removed for r in got)


def test_op1_on_real_texts(spark):
    d = real()
    got = queries.op1_substring_dedup(spark, SF).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in got] == brute_substring(d.text)


def test_op1_edges(spark, weird):
    got = substring_dedup.digest(substring_dedup.ranges(weird)).collect()
    assert len(got) == weird.count()
    by_id = {r.doc_id: r for r in got}
    assert by_id[6].n_removed == by_id[6].n_words == 3000 and by_id[0].n_words == 0
    assert substring_dedup.ranges(weird.limit(0)).count() == 0
    clash = weird.withColumns({"key": F.col("doc_id"), "spans": F.lit("s"), "__key": F.lit(1), "a.b": F.lit(2)})
    same = substring_dedup.deduplicate(clash)
    assert same.schema.names == clash.schema.names and same.count() == clash.count()
    assert {(r["doc_id"], r["key"], r["spans"], r["__key"], r["a.b"]) for r in same.collect()} == {(r.doc_id, r.doc_id, "s", 1, 2) for r in weird.collect()}
    cut = substring_dedup.deduplicate(weird)
    assert cut.columns == weird.columns and cut.count() == weird.count()
    assert substring_dedup.cut("a  b\nc d", [{"first": 1, "n": 1}], 2) == "a  d"


# --- 2: BPE ---


def test_op2_equals_the_library(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library, own = Tokenizer.from_file(path), bpe.codec(path)
    rng = random.Random(1)
    alphabet = list("aAbB 's'llt.,0²½é́ßΣ\u0085\x1c\x00\n\t中_") + ["<|endoftext|>", "  ", " the", "aaaa"]
    texts = [*real().text[:80], "", *("".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(1500))]
    ids = own.encode_batch(texts)
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert ids == want
    assert own.decode_batch(ids) == [library.decode(x, skip_special_tokens=False) for x in want]


def test_op2_digest_and_edges(spark, weird):
    path = public_tokenizers.path("byte_bpe_50k.json")
    got = {r.doc_id: r for r in bpe.digest(weird.where("doc_id is not null"), path).collect()}
    assert got[0].n_tokens == 0 and got[0].ids_sha256 == hashlib.sha256(b"").hexdigest()
    texts = {r.doc_id: r.text for r in bpe.decode(bpe.encode(weird.where("doc_id is not null"), path), path).collect()}
    assert all(texts[i] == (t or "") for i, t in enumerate(WEIRD))
    assert got[5].decoded_sha256 == hashlib.sha256(WEIRD[5].encode()).hexdigest()
    assert bpe.encode(weird.limit(0), path).count() == 0


# --- 3: SimHash ---


def brute_fingerprint(text):
    words = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()).split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for i in range(64):
            counts[i] += h >> i & 1
    return sum(1 << i for i in range(64) if 2 * counts[i] > len(shingles))


def test_op3_equals_brute_force(spark):
    d = real()
    got = queries.op3_simhash(spark, SF).orderBy("doc_id").collect()
    fp = np.array([brute_fingerprint(t) for t in d.text], np.uint64)
    assert [r.fingerprint for r in got] == [f"{x:016x}" for x in fp]
    near = np.argwhere(np.triu(np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 3, 1))
    assert [r.component_id for r in got] == d.doc_id.to_numpy()[roots(len(d), near)].tolist()


@pytest.mark.parametrize("ball", [simhash.Ball(3, 4), simhash.Ball(5, 2), simhash.Ball(2, 4)])
def test_op3_links_random_neighbours(spark, ball):
    rng = np.random.default_rng(3)
    centres = rng.integers(0, 2**64, 30, dtype=np.uint64)
    fps = [int(c) for c in centres]
    for c in centres:
        for _ in range(8):
            flips = rng.choice(64, rng.integers(1, ball.radius + 2), replace=False)
            fps.append(int(c) ^ sum(1 << int(i) for i in flips))
    fps = sorted(set(fps))
    array = np.array(fps, np.uint64)
    near = np.argwhere(np.triu(np.bitwise_count(array[:, None] ^ array[None, :]) <= ball.radius, 1))
    edges = simhash.links(spark.createDataFrame([(int(x),) for x in array.view(np.int64)], "fp long"), ball).collect()
    place = {int(x): i for i, x in enumerate(array.view(np.int64))}
    pairs = [(place[e.src], place[e.dst]) for e in edges]
    assert all(int(fps[a] ^ fps[b]).bit_count() <= ball.radius for a, b in pairs)
    assert roots(len(fps), pairs) == roots(len(fps), near)


def test_op3_large_buckets_by_bits():
    rng = np.random.default_rng(4)
    base = int(rng.integers(0, 2**63))
    inner = np.unique(rng.integers(0, 1 << 16, 300)).astype(np.uint64)
    fps = np.unique(np.concatenate([np.uint64(base & ~0xFFFF) | inner, (np.uint64(base & ~0xFFFF) | inner[:80]) ^ np.uint64(1 << 40)]))
    place = {int(x): i for i, x in enumerate(fps)}
    by = lambda edges: roots(len(fps), [(place[a], place[b]) for a, b in edges])
    assert by(simhash._by_bits(fps, 0, simhash.Ball())) == by(simhash._by_scan(fps, 3))


def test_op3_edges(spark, weird):
    got = simhash.components(weird).collect()
    assert len(got) == weird.count()
    wordless = [r for r in got if r.fingerprint == "0" * 16]
    assert {r.doc_id for r in wordless} == {0, 1, 2, None} and {r.component_id for r in wordless} == {0}
    assert simhash.components(weird.limit(0)).count() == 0
    with pytest.raises(ValueError, match="meet"):
        simhash.Ball(5, 4)


def test_near_copies_keep_one_of_each_group(spark):
    rng = random.Random(9)
    words = [f"w{rng.randint(0, 5000)}" for _ in range(200)]
    copy = list(words)
    copy[20] = copy[150] = "changed"
    other = [f"v{rng.randint(0, 5000)}" for _ in range(200)]
    d = docs(spark, [" ".join(words), " ".join(copy), " ".join(other), " ".join(words), "short text", "short text.", None, ""], 10)
    kept = {r.doc_id for r in near_copies.keep_first(d).collect()}
    assert kept == {10, 12, 14, 15, 16}
    assert near_copies.similarity_of(near_copies.shingle_set(" ".join(words)), near_copies.shingle_set(" ".join(copy))) > 0.8


# --- 4: language ID ---


def test_op4_held_out_accuracy(spark):
    got = queries.op4_language_id(spark, "/root/testdata/sf0.01").toPandas().merge(pd.read_parquet("/root/testdata/sf0.01/documents.parquet"), on="doc_id")
    assert (got.held_out == got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 4 == 2)).all()
    held = got[got.held_out & (got.text.str.len() > 30)]
    assert (held.lang_pred == held.lang).mean() > 0.97
    assert got.score.between(0, 1).all() and set(got.lang_pred) <= set(got.lang) | {"und"}


def test_op4_never_reads_labels_of_the_held_out_fold(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    fold = language_id.held_out()
    swapped = d.withColumn("lang", F.when(fold, F.lit("xx")).otherwise(F.col("lang"))).withColumn("source", F.lit(None).cast("string"))
    a, b = language_id.fit(d.where(~fold)), language_id.fit(swapped.where(~fold))
    assert a.words == b.words and a.grams == b.grams and "xx" not in b.languages
    assert (a.word_table == b.word_table).all() and (a.gram_table == b.gram_table).all()


def test_op4_edges(spark, weird):
    model = language_id.fit(weird)
    got = {(r.doc_id, r.lang_pred): r.score for r in language_id.predict(weird, model).collect()}
    assert got[0, "und"] == 0.0 and (1, "und") in got and (2, "und") in got
    nothing = language_id.fit(weird.limit(0))
    assert {r.lang_pred for r in language_id.predict(weird, nothing).collect()} == {"und"}
    assert language_id.keep_known(weird, model).columns == weird.columns
    small = language_id.Model(["a", "b"], ["hi"], [(-1.0, -3.0)], ["^h", "o"], [(-5.0, -1.0), (-2.0, -2.5)], (-9.0, -9.0))
    assert small.word_scores("hi") == (-1.0, -3.0) and small.word_scores("ho") == (-5.0, -1.0) and small.word_scores("oo") == (-2.0, -2.5) and small.word_scores("z") == (-9.0, -9.0)


def test_op4_letters_are_unicode_letters():
    model = language_id.Model(["a", "b"], ["hi"], [(-1.0, -3.0)], ["^h"], [(-5.0, -1.0)], (-9.0, -9.0))
    for letterless in (None, "", "42 _ \u00b2\u00bd\u2163 \u0661 !", "\u2463"):
        assert model.predict(letterless) == ("und", 0.0)
    assert language_id.letter_words("Hi\u00b2ho \u00bd x\u2163y \u00c9t\u00e9_9z") == ["hi", "ho", "x", "y", "\u00e9t\u00e9", "z"]


def test_op4_equals_a_plain_word_by_word_sum():
    rng = random.Random(3)
    words, grams = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(100)], ["^w", "w", "a", "b$", "zz", "q"]
    words = sorted({w.replace("w", "v") for w in words})
    table = [(rng.uniform(-9, -1), rng.uniform(-9, -1), rng.uniform(-9, -1)) for _ in words]
    gram_table = [(rng.uniform(-9, -1), rng.uniform(-9, -1), rng.uniform(-9, -1)) for _ in grams]
    floor = (-9.0, -9.5, -9.2)
    model = language_id.Model(["a", "b", "c"], words, table, grams, gram_table, floor)

    def row(word):
        if word in words:
            return table[words.index(word)]
        for order in range(5, 0, -1):
            parts = [f"^{word}$"[i : i + order] for i in range(len(word) + 3 - order)]
            hits = [gram_table[grams.index(p)] for p in parts if p in grams]
            if hits:
                return tuple(sum(c) / len(hits) for c in zip(*hits, strict=True))
        return floor

    texts = [" ".join(rng.choice(words) if rng.random() < 0.6 else "".join(rng.choices("abwzqx", k=rng.randint(1, 6))) for _ in range(rng.randint(0, 12))) for _ in range(200)]
    labels, scores = model.predict_all(texts)
    for text, label, score in zip(texts, labels, scores, strict=True):
        if not text:
            assert (label, score) == ("und", 0.0)
            continue
        sums = [sum(x) for x in zip(*map(row, text.split()), strict=True)]
        assert sums[["a", "b", "c"].index(label)] == pytest.approx(max(sums))
        assert score == pytest.approx(1 / sum(np.exp(x - max(sums)) for x in sums))


def test_op4_sample_keeps_rare_languages(spark):
    rows = [(i, f"common words number {i % 7}", "aa") for i in range(3000)] + [(3000 + i, "seldom tongue spoken here", "zz") for i in range(5)]
    model = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), max_train_rows=100)
    assert model.languages == ["aa", "zz"] and model.predict("seldom spoken")[0] == "zz"


# --- 5: embeddings ---


def test_op5_recall_and_exactness(spark):
    rng = np.random.default_rng(5)
    rows, n = [], 0
    for label in (1, 2):
        for _ in range(120):
            c = rng.standard_normal(64)
            for _ in range(rng.integers(1, 5)):
                rows.append((n, (c + rng.standard_normal(64) * rng.uniform(0, 0.45)).astype(np.float32).tolist(), label))
                n += 1
    rows += [(n, rows[0][1], 1), (n + 1, rows[0][1], 2), (n + 2, None, 1), (n + 3, [0.0] * 64, 1), (n + 4, [float("nan")] * 64, 1), (n + 5, [None] * 64, 1), (n + 6, rows[0][1], None), (n + 7, [1.0, 2.0], 1), (None, rows[0][1], 1)]
    got = embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()
    assert len(got) == len(rows)
    by_id = {r.vec_id: r for r in got}
    good = [i for i, (v, x, lab) in enumerate(rows) if v is not None and lab is not None and x and len(x) == 64 and None not in x and np.isfinite(x).all() and np.any(x)]
    x = np.array([rows[i][1] for i in good], np.float64)
    x /= np.linalg.norm(x, axis=1)[:, None]
    lab = np.array([rows[i][2] for i in good])
    link = (x @ x.T >= 0.93) & (lab[:, None] == lab[None, :])
    np.fill_diagonal(link, False)
    want = link.sum(axis=1)
    have = np.array([by_id[rows[i][0]].n_links for i in good])
    assert (have <= want).all() and have.sum() >= 0.98 * want.sum()  # no link below the threshold; recall
    if (have == want).all():
        parts = roots(len(good), np.argwhere(np.triu(link)))
        assert [by_id[rows[i][0]].component_id for i in good] == [rows[good[p]][0] for p in parts]
    for i in range(n + 2, n + 8):
        assert by_id[i].n_links == 0 and by_id[i].kept


def test_op5_on_real_vectors(spark):
    e = pd.read_parquet(f"{SF}/embeddings.parquet").sort_values("vec_id").reset_index(drop=True)
    got = queries.op5_embedding_dedup(spark, SF).orderBy("vec_id").toPandas()
    x = np.stack(e.embedding.to_numpy()).astype(float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    link = (x @ x.T >= 0.93) & (e.label.to_numpy()[:, None] == e.label.to_numpy()[None, :])
    np.fill_diagonal(link, False)
    assert got.n_links.sum() >= 0.9 * link.sum() and (got.n_links <= link.sum(axis=1)).all()


@pytest.mark.parametrize(("kind", "labels"), [("string", ["red", "red", "blue", None]), ("double", [1.2, 1.2, 1.9, None])])
def test_op5_labels_of_other_types_and_doubles(spark, kind, labels):
    tiny = 1e-60  # below what 32 bits can hold: only the direction counts
    rows = [(i, [x * tiny for x in (3.0, 4.0, 0.0)], labels[i]) for i in range(4)]
    got = embedding_dedup.near_duplicates(spark.createDataFrame(rows, f"vec_id long, embedding array<double>, label {kind}")).collect()
    assert {(r.vec_id, r.n_links, r.component_id) for r in got} == {(0, 1, 0), (1, 1, 0), (2, 0, 2), (3, 0, 3)}


def test_op5_chunks_of_a_cell_meet(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "CHUNK", 4)
    base = np.random.default_rng(1).standard_normal(8)
    rows = [(i, (base + 0.01 * np.random.default_rng(i).standard_normal(8)).astype(np.float32).tolist(), 0) for i in range(25)]
    got = embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()
    assert {r.n_links for r in got} == {24} and {r.component_id for r in got} == {0}


# --- 6: chat formatting ---


def test_op6_escapes_are_reversible():
    rng = random.Random(2)
    for _ in range(3000):
        text = "".join(rng.choice(["<s>", "</s>", "[INST]", "[/INST]", "\\", "<", "s>", "[", "x", "é", "\n"]) for _ in range(rng.randint(0, 12)))
        safe = chat_format.escape(text)
        assert chat_format.unescape(safe) == text and not any(c in safe for c in chat_format.CONTROL)


def test_op6_template_language():
    t = chat_format.Template("{% set a = 'x' ~ 1 %}{% for m in ms %}{% if loop.first and not m.off %}{{ a }}{% elif m['k'] in 'bc' %}B{% else %}{{ m.k | upper }}{% endif %}{% if not loop.last %},{% endif %}{% endfor %}{# no #}")
    assert t.render(ms=[{"k": "a"}, {"k": "b"}, {"k": "z"}])[0] == "x1,B,Z"
    assert chat_format.Template("a{{ 'b' ~ 'c' }}{% if 1 == 1 %}d{% endif %}{% if false %}e{% endif %}").tree == [("const", "abcd")]
    text, marks = chat_format.Template("ab{% generation %}{{ x }}{% endgeneration %}c").render(x="éé")
    assert text[marks[0][0] : marks[0][1]] == "éé"
    for bad in ("{% for x %}{% endfor %}", "{% if a %}", "{{ a | nope }}", "{{ a.b( }}", "{{ ''.__class__() }}", "{% import os %}"):
        with pytest.raises(chat_format.TemplateError):
            chat_format.Template(bad)
    assert chat_format.Template("{{ x.__class__ }}").render(x="s")[0] == ""


def test_op6_edges(spark):
    rows = [(1, 0, "user", None), (1, 1, "assistant", "a</s>"), (None, 0, None, "t"), (2, None, "assistant", ""), (2, 1, "assistant", "b"), (2, 1, "assistant", "b")]
    got = {r.conv_id: r for r in chat_format.digest(chat_format.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).collect()}
    assert got[1].n_turns == 2 and got[1].loss_chars == 5 and got[1].loss_sha256 == hashlib.sha256(b"a</s>").hexdigest()
    assert got[2].n_turns == 3 and got[2].loss_chars == 2 and got[None].n_turns == 1
    assert chat_format.format_conversations(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0
    assert queries.op6_chat_format(spark, SF).where("conv_id = -7").first().n_turns == 2


# --- 7: sharding ---


def test_op7_laws(spark):
    d = real()
    got = queries.op7_sharding(spark, SF).toPandas()
    sizes = got.groupby("shard")["size"].sum()
    assert len(got) == len(d) and sizes.max() - sizes.min() <= 2 * got["size"].max()
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in got.groupby("shard"))
    texts = dict(zip(d.doc_id, d.text, strict=True))
    assert all(r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) and r.size == len(texts[r.doc_id].encode()) + 1 for r in got.itertuples())


def test_op7_hot_text_is_divided(spark):
    d = docs(spark, ["the same text over and over"] * 700 + [f"text {i} " * (i % 7 + 1) for i in range(600)])
    got = sharding.shard(d).toPandas()
    sizes = got.groupby("shard")["size"].sum()
    assert len(sizes) == 8 and sizes.max() - sizes.min() < 0.05 * sizes.mean()
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in got.groupby("shard"))


def test_op7_edges(spark, weird):
    got = sharding.shard(weird).collect()
    assert len(got) == weird.count() and {r.shard for r in got} <= set(range(8))
    assert next(r for r in got if r.doc_id == 0)["size"] == 1
    assert sharding.shard(weird.limit(0)).count() == 0


def test_heavy_groups_stay_whole(spark):
    """Groups up to a shard's size are never divided; one that holds a third of all rows is, with near equal sizes."""
    texts = ["hot " * 20] * 2000 + [f"group {i % 9} " + "x" * 60 for i in range(1800)] + [f"pair {i // 2} " + "y" * 60 for i in range(2200)]
    d = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(7)
    for shards in (8, 2):
        got = sharding.shard(d, shards).toPandas().set_index("doc_id").sort_index()
        got["text"] = texts
        assert len(got) == len(texts) and (got["size"] == got.text.str.len() + 1).all()
        by_text = got.groupby("text").agg(shards=("shard", "nunique"), bytes=("size", "sum"))
        fits = by_text.bytes <= got["size"].sum() / shards
        assert (by_text.shards[fits] == 1).all() and ((~fits).sum(), by_text.shards[~fits].gt(1).sum()) == ((1, 1) if shards == 8 else (0, 0))
        sizes = got.groupby("shard")["size"].sum()
        assert len(sizes) == shards and sizes.max() - sizes.min() <= 3 * got[got.text.str.startswith("pair")]["size"].max()
        assert all(sorted(g.slot) == list(range(len(g))) for _, g in got.groupby("shard"))


@given(st.lists(st.integers(1, 60), max_size=20), st.integers(1, 9))
def test_homes_keep_to_the_room(sizes, shards):
    total = sum(sizes) + 7
    homes, room = sharding._homes(dict(enumerate(sizes)), total, shards)
    given_ = [total * (i + 1) // shards - total * i // shards for i in range(shards)]
    held = [sum(sizes[k] for k, h in homes.items() if h == i) for i in range(shards)]
    assert [a - b for a, b in zip(given_, held, strict=True)] == room and min(room) >= 0
    assert all(sizes[k] > max(room) for k in range(len(sizes)) if k not in homes)


# --- 8: secret scan ---


def brute_base(text):
    out = []
    for m in re.finditer(r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']? *[:=] *[\"']?([A-Za-z0-9+/_.=-]+)", text or ""):
        if len(m[2]) >= 8:
            out.append((m.start(), 0, "assign", m.end()))
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text or "") if len(m[0]) >= 16]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", text or "") if len(m[0]) >= 32]
    return ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(out))


def test_op8_base_equals_brute_force(spark):
    rng = random.Random(6)
    bits = ["password", "Token", "api_key", "APIKEY", "=", ": ", '"', "'", "AKIA", "ABCDEF0123456789", "deadbeef" * 4, "x", " ", "é", "secret:longenough1", "ſecret=abcdefgh", "\n"]
    texts = [*real().text, *("".join(rng.choice(bits) for _ in range(rng.randint(0, 14))) for _ in range(800)), *WEIRD]
    for t in texts:
        base = [s for s in secret_scan.scan_text(t) if s[0] != "named"]
        assert ",".join(f"{k}:{s}:{e}" for k, s, e, _ in base) == brute_base(t)


def test_op8_follows_assignments():
    found = lambda text: [text[s:e] for k, s, e, _ in secret_scan.scan_text(text) if k == "named"]
    assert found('db.clientSecret = "Zx9!kLm2#Qw8"') == ["Zx9!kLm2#Qw8"]
    assert found('K = "Zx9kLm2Qw8rT"\nauth_token_value = K') == ["Zx9kLm2Qw8rT"]
    assert found('signing_key := "ab12CD34" + "ef56GH78"') == ["ab12CD34", "ef56GH78"]
    assert found('password_hint = "see the manual"') == [] and found('password = "changeme"') == [] and found("token_count = 1234567890") == []
    assert secret_scan.redact_text('x password=abcdefgh12 y') == "x [secret] y"


def test_op8_named_equals_brute_force():
    """Random programs of constants and concatenations, worked out by plain substitution."""
    rng = random.Random(9)
    names = ["K", "base", "part_two", "clientSecret", "db.signing_key", "auth_token", "password_hint", "x" * 400 + "_secret", "userName"]
    for _ in range(300):
        lines, at, held, want = [], 0, {}, set()
        for _ in range(rng.randint(1, 14)):
            name, line, spans, value = rng.choice(names), "", [], ""
            line = name + rng.choice([" = ", "=", " := ", ": "])
            for k in range(rng.randint(1, 3)):
                line += " + " if k else ""
                known = rng.choice(names)
                if rng.random() < 0.5 and known in held:
                    line += known
                    spans, value = spans + held[known][0], value + held[known][1]
                else:
                    text = "".join(rng.choices("abZY09!", k=rng.randint(1, 9)))
                    spans, value = [*spans, (at + len(line) + 1, at + len(line) + 1 + len(text))], value + text
                    line += f'"{text}"'
            if len(value) > 4000:
                continue
            held[name] = (spans, value)
            held.setdefault(name.rsplit(".", 1)[-1], held[name])
            if secret_scan.name_score(name) >= 1.5 and secret_scan.name_score(name) + secret_scan.literal_score(value) >= secret_scan.THRESHOLD:
                want |= set(spans)
            lines.append(line)
            at += len(line) + 1
        text = "\n".join(lines)
        assert {(s, e) for s, e, _ in secret_scan.lexed(text)} == want, text


def test_op8_lexer_reads_syntax_and_ends():
    found = lambda text: [text[s:e] for s, e, _ in sorted(secret_scan.lexed(text))]
    assert found('cfg["clientSecret"] = "Zx9!kLm2#Qw8"') == ["Zx9!kLm2#Qw8"]
    assert found('secret_key: str = "Zx9!kLm2#Qw8"') == ["Zx9!kLm2#Qw8"]
    assert found('signing_key = spare = "Zx9!kLm2#Qw8"') == ["Zx9!kLm2#Qw8"]
    assert found("it's 'auth_token': 'Zx9!kLm2#Qw8', don't") == ["Zx9!kLm2#Qw8"]
    assert found("""note = "auth_token='Zx9!kLm2#Qw8'" """) == ["Zx9!kLm2#Qw8"]
    assert found("pass_secret_key" + 200 * "z" + ' = "hT5kQ9zLp2Vx8"') == ["hT5kQ9zLp2Vx8"]
    assert found("z" * 500 + '_pass_secret_key = "hT5kQ9zLp2Vx8"') == ["hT5kQ9zLp2Vx8"]
    assert found('x = "Zx9!kLm2"\n' + 60 * "x = x + x\n" + "client_secret = x") == ["Zx9!kLm2"]
    for long in ("a=" * 100_000, 'a="' * 60_000, '\\"' * 60_000 + "=", "x: 'k' + " * 30_000, "x = x + x\n" * 20_000, "".join(f'k{i} = k{i - 1} + "a1{i}"\n' for i in range(20_000)) + "secret = k19999"):
        secret_scan.lexed(long)


def test_op8_edges(spark, weird):
    got = secret_scan.digest(secret_scan.scan(weird)).collect()
    assert len(got) == weird.count() and all(r.n_hex == 0 for r in got if r.doc_id in (0, 1))
    clean = secret_scan.redact(weird)
    assert clean.columns == weird.columns and clean.count() == weird.count()
    assert secret_scan.scan(weird.limit(0)).count() == 0


# --- 9: packing ---


def check_packing(rows, ids):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(ids)
    for i, pieces in by_doc.items():
        at, x = 0, ids[i]
        for r in sorted(pieces, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(x) and r.ids_crc32 == zlib.crc32(x[at : at + r.length].tobytes())
            at += r.length
        assert at == len(x)
    padded = total = 0
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
        padded, total = padded + (0 if at & (at - 1) == 0 else 2048 - at), total + at
    assert padded == 0 and total == sum(map(len, ids.values()))


def test_op9_packs_every_id_once(spark):
    d = real()
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {i: np.array([*library.encode(t, add_special_tokens=False).ids, 1], "<u4") for i, t in zip(d.doc_id, d.text, strict=True)}
    check_packing(queries.op9_packing(spark, SF).collect(), ids)


def test_op9_encoder_equals_the_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    library, own = Tokenizer.from_file(path), packing.encoder(path)
    rng = random.Random(8)
    alphabet = list("aAbB1²'stl.,<|>É éßÅαΣςİıǅ\u0085\x1c\x00 \n\tªº中_-") + ["<|endoftext|>", "<|STARTOFTEXT|>", "'s", "'LL", "é"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 25))) for _ in range(4000)]
    got = [np.frombuffer(x, own.dtype).tolist() for x in own.encode_batch(texts, 1)]
    assert got == [[*e.ids, 1] for e in library.encode_batch(texts, add_special_tokens=False)]


def test_op9_neighbours_fill_a_window():
    rng = np.random.default_rng(0)
    vocab = 100
    docs_ = [np.concatenate([rng.integers(10 * t, 10 * t + 10, 300), [99]]).astype("<u2") for t in range(4) for _ in range(6)]
    df = np.zeros(vocab)
    for d in docs_:
        df[np.unique(d)] += 1
    pieces = packing.pack_shard(docs_, np.log1p((len(docs_) - df + 0.5) / (df + 0.5)), 301.0)
    topics = defaultdict(set)
    for doc, _, _, sequence, offset in pieces:
        if sequence == 0:
            topics[sequence].add(doc // 6)
    assert topics[0] == {0, 1} or topics[0] == {0}  # all six of a topic come before another begins
    assert packing._powers([(0, 0, 100, 0, 0)], 0, 100) == [(0, 0, 64, 0, 0), (0, 64, 32, 1, 0), (0, 96, 4, 2, 0)]


def test_op9_windows_equal_brute_force_bm25():
    """Each window's documents against plain scores of all unused documents for all terms of the seed."""
    rng = np.random.default_rng(1)
    docs_ = [(rng.zipf(1.3, rng.integers(5, 900)) % 500).astype("<u2") for _ in range(150)]
    sets = [Counter(d.tolist()) for d in docs_]
    df = np.array([sum(t in c for c in sets) for t in range(500)], np.float64)
    idf, average = np.log1p((len(docs_) - df + 0.5) / (df + 0.5)), float(np.mean([len(d) for d in docs_]))

    def score(seed, doc):
        norm = packing.K1 * (1 - packing.B + packing.B * len(docs_[doc]) / average)
        return sum(idf[t] * sets[doc][t] * (packing.K1 + 1) / (sets[doc][t] + norm) for t in sets[seed] if t in sets[doc])

    pieces = packing.pack_shard(docs_, idf, average)
    order = [(d, s) for d, s, _, q, o in sorted(pieces, key=lambda p: (p[3], p[4]))]
    unused, expect, filled, seed, rest, queue = set(range(150)), [], 0, None, None, []
    while unused or rest:
        if rest is not None:
            seed, start = rest
        elif filled == 0 or not queue:
            seed, start = min(unused), 0
        else:
            seed, start = None, 0
        doc = seed if seed is not None else queue.pop(0)
        unused.discard(doc)
        take = min(2048 - filled, len(docs_[doc]) - start)
        expect.append((doc, start))
        filled = (filled + take) % 2048
        rest = (doc, start + take) if start + take < len(docs_[doc]) else None
        if seed is not None and rest is None and filled:
            queue = sorted((x for x in unused if score(seed, x) > 0), key=lambda x: (-round(score(seed, x), 9), x))
        if filled == 0:
            queue = []
    last = max(q for *_, q, _ in pieces)
    full = [x for x in order if x in expect]
    assert len(pieces) > 150 and full[:-3] == expect[: len(full) - 3] and last >= 20


def test_op9_equal_rows_spread_over_tasks(spark, monkeypatch):
    """Rows alike in id and text go to as many ranges and shards as their tokens need."""
    monkeypatch.setattr(packing, "TASK_SHARDS", 2)
    d = spark.createDataFrame([(None, "the same words again and again")] * 600, "doc_id long, text string").repartition(3)
    packed = packing.pack(d, public_tokenizers.path("word_bpe_49k.json"), shard_tokens=300)
    rows = packed.withColumn("task", F.spark_partition_id()).collect()
    assert sum(r.length for r in rows) == 600 * rows[0].doc_tokens and len({r.task for r in rows}) >= 4
    assert Counter(r.task for r in rows).most_common(1)[0][1] < 400
    used = defaultdict(int)
    for r in rows:
        used[r.sequence_id] += r.length
    assert all(n <= 2048 and n & (n - 1) == 0 for n in used.values())


def test_op9_edges(spark, weird):
    got = packing.pack(weird, public_tokenizers.path("word_bpe_49k.json")).collect()
    assert sum(r.length for r in got if r.doc_id == 0) == 1 and {r.doc_id for r in got} == {r.doc_id for r in weird.collect()}
    assert packing.pack(weird.limit(0), public_tokenizers.path("word_bpe_49k.json")).count() == 0


# --- 10: quality rules ---


def brute_statistics(text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    marked = {i + k for i in range(len(words) - 2) for k in range(3) if windows[tuple(words[i : i + 3])] > 1}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search("[^\x20\x09-\x0d]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(marked)


def test_op10_statistics(spark):
    rng = random.Random(3)
    texts = [*real().text, *WEIRD, *("".join(rng.choice(["a ", "b ", "c\n", "a\n", "\r\n", "# ", "é| "]) for _ in range(rng.randint(0, 60))) for _ in range(500))]
    for t in texts:
        assert quality.statistics(t)[0] == brute_statistics(t)


def test_op10_trees(spark):
    rng = np.random.default_rng(2)
    x = rng.random((3000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.7) & (x[:, 2] < 2)).astype(float)
    forest = quality.fit_forest(x, y, {})
    assert ((forest.score(x) > 0.5) == y).mean() > 0.97
    z = rng.random((3000, 2))
    noisy = (z[:, 0] + 0.3 * np.sin(20 * z[:, 0]) + 0.2 * rng.standard_normal(3000) > 0.5).astype(float)
    rising = quality.fit_forest(z, noisy, {0: 1})
    for other in (0.1, 0.9):
        line = rising.score(np.column_stack([np.linspace(0, 1, 200), np.full(200, other)]))
        assert (np.diff(line) >= -1e-12).all()


def test_op10_quality_on_real_labels(spark):
    got = queries.op10_quality_rules(spark, "/root/testdata/sf0.01").toPandas().merge(pd.read_parquet("/root/testdata/sf0.01/labels.parquet"), on="doc_id")
    judged = got[~got.base_failed]
    assert (judged.kept == (judged.quality_y == 1)).mean() > 0.9 and not got[got.base_failed].kept.any()


def test_op10_edges(spark, weird):
    labels = spark.createDataFrame([(3, 1), (4, None), (None, 0), (5, 1)], "doc_id long, quality int")
    assert quality.fit(weird, labels) is None and quality.fit(weird.limit(0), labels.limit(0)) is None
    got = quality.score(weird, None).collect()
    assert len(got) == weird.count() and next(r for r in got if r.doc_id == 0).base_failed
