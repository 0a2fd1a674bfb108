"""What operators leave in the driver and in the workers."""

from __future__ import annotations

from pyspark.sql import functions as F

from xmarket.llm import sharding


def test_shard_plans_hold_no_tables(spark):
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id") % 4000).alias("text"))
    out = sharding.shard(docs)
    assert len(out._jdf.queryExecution().toString()) < 100_000  # 5 million with bounds and parts as literals
    rows = out.collect()
    assert len(rows) == 5000 and {(r.shard, r.slot) for r in rows} == {(s, i) for s in range(8) for i in range(sum(r.shard == s for r in rows))}


def test_a_worker_drops_the_caches_of_earlier_stages():
    import public_tokenizers

    from xmarket.llm import words
    from xmarket.llm.language_id import Model
    from xmarket.llm.packing import ChunkEncoder

    encoder, model = ChunkEncoder(public_tokenizers.path("word_bpe_49k.json")), Model(["en"], ["a"], [[0.0]], floor=(0.0,))
    words.using(encoder, encoder.forget)
    first = encoder.encode_batch(["some words, and more"], 1)
    words.using(encoder, encoder.forget)
    assert encoder._chunks and encoder._pretokens  # kept from task to task of one stage
    words.using(model, model._reset)
    assert not encoder._chunks and not encoder._pretokens
    model.predict("an unknown word")
    assert len(model._rows) > 1
    words.using(None)
    assert len(model._rows) == 1 and encoder.encode_batch(["some words, and more"], 1) == first


def test_documents_per_id_count_each_document_once(spark):
    import numpy as np
    import public_tokenizers

    from xmarket.llm import packing

    path = public_tokenizers.path("word_bpe_49k.json")
    texts = [None, "", *(" ".join(f"word {i % 7} word" for _ in range(i % 5 + 1)) for i in range(300))]
    rows = packing.tokenize(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3), path).collect()
    got = sum(np.frombuffer(r.counts, np.int64) for r in rows if r.counts is not None)
    want = np.zeros(len(got), np.int64)
    for ids in packing.encoder(path).encode_batch(texts, packing.END_ID):
        want[list(set(np.frombuffer(ids, packing.encoder(path).dtype).tolist()))] += 1
    assert (got == want).all() and got[packing.END_ID] == len(texts)
