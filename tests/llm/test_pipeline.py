"""The pipeline against brute force on what its stages decide, and on awkward tables."""

from __future__ import annotations

import corpus_pipeline
from tests.llm.test_operators import SMALL, leak_truth, near_truth


def test_stages_on_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, SMALL)
        if name != "packing":
            assert docs.columns == before.columns
        kept[name] = {r["doc_id"]: r["text"] for r in docs.collect()} if name != "packing" else docs.collect()
    truth = near_truth(kept["quality"], 5, 80)
    assert set(kept["near_duplicates"]) == {i for i, (_, first) in truth.items() if i == first}
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()}
    clean = {i for i, t in kept["near_duplicates"].items() if not leak_truth(t, items)[3]}
    assert set(kept["decontamination"]) == clean
    assert {r["doc_id"] for r in kept["packing"]} == clean
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    good = [i for i in kept["language"] if labels.get(i) == 1]
    assert sum(i in kept["quality"] for i in good) >= 0.97 * len(good)


def test_awkward_documents(spark, awkward, empty):
    for docs in (awkward.select("doc_id", "text", "lang", "source", "n_chars"), empty.select("doc_id", "text", "lang", "source", "n_chars")):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SMALL)
        docs.collect()


def test_documents_with_more_columns(spark, awkward):
    """Columns ``id`` and ``score`` beside those of documents: the first passes, the second is what a stage made of it."""
    docs = awkward
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
        assert docs.columns == awkward.columns, name
    rows = docs.collect()
    assert all(r["id"] == "x" and 0 <= r["score"] <= 1 for r in rows)
    plain = awkward.select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        plain = stage(spark, plain, SMALL)
    key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["text"])
    assert sorted(map(key, rows)) == sorted(map(key, plain.collect()))
