"""The near-dedup stage of the corpus pipeline against brute-force Jaccard similarity."""

from __future__ import annotations

import random
from itertools import combinations

import numpy as np

from xmarket.llm import near_copies

DOCS = "doc_id long, text string"


def shingles_of(text, size=5):
    words = text.lower().split()
    return set(zip(*(words[i:] for i in range(size)), strict=False)) if len(words) >= size else ({tuple(words)} if words else set())


def similarity(a, b):
    x, y = shingles_of(a), shingles_of(b)
    return len(x & y) / len(x | y) if x or y else 1.0


def groups(texts):
    """doc_id -> smallest doc_id of its component, by comparing all pairs."""
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(range(len(texts)), 2):
        if similarity(texts[a], texts[b]) >= 0.8:
            a2, b2 = sorted((find(a), find(b)))
            root[b2] = a2
    return {x: find(x) for x in range(len(texts))}


def found(spark, texts):
    d = spark.createDataFrame(list(enumerate(texts)), DOCS).repartition(4)
    return {r.doc_id: r.component_id for r in near_copies.near_copies(d).collect()}


def test_recall_over_the_similarities(spark):
    rng = random.Random(4)
    texts, bands = [], []
    while len(texts) < 1200:
        words = [f"w{rng.randint(0, 3000)}" for _ in range(rng.randint(20, 600))]
        copy = list(words)
        for at in rng.sample(range(len(words)), rng.randint(1, max(1, len(words) // 40))):
            copy[at] = f"w{rng.randint(0, 3000)}"
        s = similarity(" ".join(words), " ".join(copy))
        if 0.8 <= s < 1:
            texts += [" ".join(words), " ".join(copy)]
            bands.append(int((s - 0.8) / 0.05))
    got = found(spark, texts)
    caught = np.array([got[2 * i] == got[2 * i + 1] for i in range(len(bands))])
    shares = {f"{0.8 + 0.05 * b:.2f}": (float(caught[np.array(bands) == b].mean()), bands.count(b)) for b in range(4)}
    print(shares)
    assert all(share >= 0.99 for share, _ in shares.values())
    assert len(set(got.values())) >= len(bands)


def test_failed_heads_do_not_cut_off_others(spark, monkeypatch):
    """All texts meet in one bucket: whichever text is compared first, pairs that are alike end up together."""
    rng = random.Random(6)
    texts = []
    for family in range(12):
        base = [f"f{family}x{rng.randint(0, 900)}" for _ in range(120)]
        for _ in range(5):
            copy = list(base)
            for at in rng.sample(range(len(base)), 2):
                copy[at] = f"n{rng.randint(0, 10**6)}"
            texts.append(" ".join(copy))
    one = np.zeros(20, np.uint64)
    monkeypatch.setattr(near_copies, "bands", lambda *_: one)
    want = groups(texts)
    assert len(set(want.values())) < len(texts)
    assert found(spark, texts) == want


def test_texts_of_the_same_words_in_other_orders(spark):
    """Shuffled texts share all words, so fingerprints of words would link them; only true pairs may be joined, and all of them."""
    rng = random.Random(8)
    texts = []
    for _ in range(20):
        words = [f"w{rng.randint(0, 400)}" for _ in range(200)]
        for _ in range(6):
            rng.shuffle(words)
            texts.append(" ".join(words))
        copy = list(words)
        copy[0] = "changed"
        texts += [" ".join(copy), " ".join(copy[:100] + ["added"] + copy[100:])]
    want = groups(texts)
    assert len(set(want.values())) == 20 * 6
    assert found(spark, texts) == want


def test_one_row_of_each_group_stays(spark):
    long = " ".join(f"w{i}" for i in range(100))
    rows = [(1, "alpha beta gamma", 1), (1, "completely different text here", 2), (2, long, 3), (3, long + " end", 4), (2, long, 5), (None, long, 6), (None, "only here without id", 7), (None, "only here without id", 8), (4, None, 9), (5, "", 10)]
    d = spark.createDataFrame(rows, "doc_id long, text string, key long").repartition(3)
    kept = near_copies.keep_first(d)
    assert kept.columns == d.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert got == sorted([(1, "alpha beta gamma"), (1, "completely different text here"), (2, long), (None, "only here without id"), (4, None)], key=str)
    assert near_copies.keep_first(d.limit(0)).count() == 0


def test_a_head_with_many_partners_is_dealt_to_tasks(spark, monkeypatch):
    monkeypatch.setattr(near_copies, "COMPARISONS", 7)
    base = [f"w{i}" for i in range(300)]
    texts = [" ".join([*base[:i], f"x{i}", *base[i + 1 :]]) for i in range(150)]
    assert set(found(spark, texts).values()) == {0}


def test_blocks_equal_plain_similarities(spark, monkeypatch):
    """A bucket larger than a block, whose head is like nothing: every link comes out of the blocks."""
    monkeypatch.setattr(near_copies, "BLOCK", 16)
    rng = random.Random(10)
    texts = []
    for family in range(25):
        base = [f"f{family}x{rng.randint(0, 900)}" for _ in range(90)]
        for _ in range(4):
            copy = list(base)
            for at in rng.sample(range(len(base)), rng.randint(0, 4)):
                copy[at] = f"n{rng.randint(0, 10**6)}"
            texts.append(" ".join(copy))
    one = np.zeros(20, np.uint64)
    monkeypatch.setattr(near_copies, "bands", lambda *_: one)
    monkeypatch.setattr(near_copies, "links", lambda nodes: nodes.sparkSession.createDataFrame([], "src long, dst long"))
    assert found(spark, texts) == groups(texts)
    sets = [near_copies.shingle_set(t) for t in texts]
    forest = near_copies._similar_forest(sets[:50], sets[50:], np.ones((50, 50), bool), 0.8)
    assert all(near_copies.similarity_of(sets[i], sets[50 + j]) >= 0.8 for i, j in forest)
