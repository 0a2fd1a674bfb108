"""The corpus pipeline: its stages keep what they should, and edge cases pass through all of them."""

from __future__ import annotations

import pandas as pd
import pytest

import corpus_pipeline
from xmarket.session import written
from conftest import SF
from test_llm import DOCS, WEIRD, docs  # noqa: F401


def through(spark, d, sf_dir=SF):
    out = []
    for name, stage in corpus_pipeline.STAGES:
        d = written(stage(spark, d, sf_dir), name)
        out.append(d)
    return out


def test_stages_on_real_documents(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    kept = through(spark, d)
    counts = [x.count() for x in kept]
    assert d.count() >= counts[0] >= counts[1] >= counts[2] == counts[3] and counts[0] > 0.98 * d.count()
    assert all(x.columns == d.columns for x in kept[:-1])
    assert {r.doc_id for r in kept[-1].select("doc_id").distinct().collect()} == {r.doc_id for r in kept[3].select("doc_id").collect()}
    texts = kept[3].select("text", "n_chars").toPandas()
    assert (texts.text.str.len() == texts.n_chars).all() and not texts.text.str.contains("AKIA[A-Z0-9]{12}").any()


def test_near_duplicate_stage_keeps_clean_documents(spark):
    d = pd.read_parquet(f"{SF}/documents.parquet")
    kept = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, spark.read.parquet(f"{SF}/documents.parquet"), SF).collect()}
    first = d.sort_values("doc_id").drop_duplicates("text")
    assert set(d.doc_id) - kept >= set(d.doc_id) - set(first.doc_id)  # exact copies go
    shingles = {r.doc_id: {tuple(r.text.lower().split()[i : i + 5]) for i in range(len(r.text.split()) - 4)} for r in d.itertuples()}
    gone = sorted(set(first.doc_id) - kept)
    for i in gone:  # what else goes has a near copy
        assert max(len(shingles[i] & shingles[j]) / max(1, len(shingles[i] | shingles[j])) for j in shingles if j != i) >= 0.8


@pytest.mark.parametrize("empty", [False, True])
def test_edges_pass_through(spark, empty):
    d = docs(spark, WEIRD).union(spark.createDataFrame([(None,) * 8, (None, "some english words with no id at all", "en", "s", 5, None, None, None)], DOCS))
    kept = through(spark, d.limit(0) if empty else d)
    assert all(x.columns == d.columns for x in kept[:-1])


def test_entry_registers_everything(spark):
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert "pipeline" in names and {f"op{n}" for n in range(1, 11)} <= {x.split("_")[0] for x in names}
