from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusloom.functions.text import WHITESPACE, strip_text, tokens
from corpusloom.operators import preprocess as P


def test_whitespace_is_pythons():
    assert set(WHITESPACE) == {chr(c) for c in range(0x110000) if chr(c).isspace()}


def test_strip_matches_python(spark):
    @settings(max_examples=3, deadline=None)
    @given(st.lists(st.text(alphabet=WHITESPACE + "ab​﻿é", max_size=8), min_size=1, max_size=60))
    def check(texts):
        df = spark.createDataFrame([(t,) for t in texts], "t string")
        got = df.select(strip_text(F.col("t")), tokens(F.col("t"))).collect()
        assert [r[0] for r in got] == [t.strip() for t in texts]
        assert [r[1] for r in got] == [t.lower().split() for t in texts]

    check()


def test_absent_key_is_empty_and_null_stays_null(spark):
    content = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (3, " ")], "id long, body string")
    meta = spark.createDataFrame([(1, 0, "old"), (1, 1, None), (9, 0, "x")], "id long, pos int, title string")
    out = P.preprocess(content, meta, "id", "body", ["title"], ["pos"])
    assert out.columns == ["text", "id", "title"]
    assert sorted((r["text"], r["title"]) for r in out.collect()) == [("a", None), ("b", None), ("c", "")]


def test_key_filter_reaches_the_reader(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    meta = spark.read.parquet(f"{sf}/labels.parquet")
    plan = P.preprocess(docs, meta, "doc_id", "text", ["quality"], ["quality"])._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(doc_id)]" in plan
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_both_limit_paths_agree(spark, monkeypatch):
    rows = spark.range(1000).select(F.col("id"), (F.col("id") % 7).alias("shard"))
    top = {r["id"] for r in P.limit_records(rows, 123, ["shard", "id"]).collect()}
    monkeypatch.setattr(P, "TOPK_ROWS", 10)
    ranged = {r["id"] for r in P.limit_records(rows, 123, ["shard", "id"]).collect()}
    assert top == ranged and len(top) == 123
    assert P.limit_records(rows, None, ["id"]).count() == 1000
