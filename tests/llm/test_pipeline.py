"""The pipeline, stage by stage, against plain versions of each stage's decision."""

from __future__ import annotations

from collections import Counter

import sentencepiece
from test_lsh_forest import brute

import corpus_pipeline as cp
from corpusloom.llm import pu_quality
from corpusloom.llm.queries import tokenizer_model
from corpusloom.session import cut_lineage


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    all_rows = {r["doc_id"]: r for r in docs.collect()}
    good = cut_lineage(cp.quality(spark, docs, sf))
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    scores = pu_quality.score_documents(docs, labels).where("predicted = 1").collect()
    assert {r["doc_id"] for r in good.collect()} == {r["doc_id"] for r in scores}
    assert good.columns == docs.columns

    unique = cut_lineage(cp.near_duplicates(spark, good, sf))
    rows = [(r["doc_id"], r["text"]) for r in good.collect()]
    assert sorted(r["doc_id"] for r in unique.collect()) == sorted({c for _, c, _ in brute(rows)})

    mixed = cut_lineage(cp.mixing(spark, unique, sf))
    counts = Counter(r["doc_id"] for r in mixed.collect())
    assert mixed.columns == docs.columns and max(counts.values()) <= 2
    words = lambda ids: sum(len(all_rows[i]["text"].split()) * n for i, n in ids.items())
    longest = max(len(all_rows[i]["text"].split()) for i in all_rows)
    sources = {all_rows[r["doc_id"]]["source"] for r in unique.collect()}
    assert abs(words(counts) - 1.5 * words(Counter(r["doc_id"] for r in unique.collect()))) <= longest * len(sources)

    sp = sentencepiece.SentencePieceProcessor(model_proto=tokenizer_model())
    for r in cp.token_ids(spark, mixed, sf).collect():
        assert r["ids"] == sp.encode(all_rows[r["doc_id"]]["text"])


def test_odd_rows_pass(spark, sf):
    text = "one two three four five six seven"
    rows = [(1, text, "en", "a", 1), (1, text, "en", "a", 1), (None, text, None, None, None), (2, None, "en", "a", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = cp.near_duplicates(spark, df.withColumn("key", df["doc_id"]), sf).collect()
    assert sorted(r["doc_id"] for r in kept) == [1, 2]
    assert cp.mixing(spark, df, sf).where("doc_id = 1").count() % 2 == 0
    for _, stage in cp.STAGES:
        assert stage(spark, df.where("false"), sf).count() == 0
