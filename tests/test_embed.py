import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.operators import embed as E
from corpusloom.plans import embed_run as ER


def as_dict(df):
    return {r[0]: np.array(r[1], dtype=np.float32) for r in df.collect()}


def test_batched_model_equals_default_embedder(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    jvm = as_dict(E.hash_embed(docs, "doc_id", dim=32, max_tokens=50))
    model = as_dict(E.embed(docs, "doc_id", E.hashing_model(32, 50), partitions=3))
    assert jvm.keys() == model.keys()
    assert all(np.array_equal(jvm[k], model[k]) for k in jvm)


def test_edge_texts(spark):
    df = spark.createDataFrame([(1, ""), (2, "A a"), (3, "x y z")], "id long, text string")
    got = as_dict(E.hash_embed(df, "id", dim=16))
    assert np.abs(got[1]).sum() == 0 and np.abs(got[2]).sum() == 1
    cut = as_dict(E.hash_embed(df, "id", dim=16, max_chars=1))
    assert np.array_equal(cut[2], got[2])


def test_mean_pool_and_length_check(spark):
    df = spark.createDataFrame([("a", [1.0, 2.0]), ("a", [3.0, 6.0]), ("b", [0.0, 1.0])], "k string, v array<double>")
    assert {r[0]: list(r[1]) for r in E.mean_pool(df, "k", "v").collect()} == {"a": [2.0, 4.0], "b": [0.0, 1.0]}
    good = E.to_embeddings(df.withColumnRenamed("v", "embeddings"), 2)
    assert E.vectors_only(good).schema.simpleString() == "struct<embeddings:array<float>>"
    with pytest.raises(Exception, match="expected 3"):
        E.to_embeddings(df.withColumnRenamed("v", "embeddings"), 3).collect()


def test_run_all_isolates_failures_and_resumes(spark, tmp_path, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    rows = []
    for i, name in enumerate(["a", "b", "c"]):
        folder = str(tmp_path / name / "preprocessed")
        if name != "b":
            docs.filter(F.col("doc_id") % 3 == i).write.parquet(folder)
        rows.append((name, folder, str(tmp_path / name / "embedding"), 1))
    cat = spark.createDataFrame(rows, "key string, preprocessed string, embeddings_out string, shards long")
    records = str(tmp_path / "records")
    s = ER.EmbedSettings(key="doc_id", dim=8, rows_per_shard=20)
    first = ER.run_all(cat, records, s, parallel=2)
    assert {r["key"]: r["ok"] for r in first.collect()} == {"a": True, "b": False, "c": True}
    assert not ER.all_succeeded(first)
    record = {r["dataset_key"]: r for r in spark.read.schema(ER.RECORD_SCHEMA).json(records).collect()}
    assert set(record) == {"a", "c"}
    assert record["a"]["num_documents"] == docs.filter("doc_id % 3 = 0").count()
    assert spark.read.parquet(rows[0][2]).count() == record["a"]["num_documents"]
    docs.filter("doc_id % 3 = 1").write.parquet(rows[1][1])
    second = ER.run_all(cat, records, s)
    assert [(r["key"], r["ok"]) for r in second.collect()] == [("b", True)]
    assert ER.run_all(cat, records, s).isEmpty()


def test_only_listed_shards_are_embedded(spark, tmp_path):
    folder = tmp_path / "d"
    for name, ids in (("part-00000", range(5)), ("part-00001", range(5, 8)), ("leftover", range(100, 104))):
        spark.createDataFrame([(i, "x y") for i in ids], "id long, text string").coalesce(1).write.parquet(str(tmp_path / name))
        (file,) = (tmp_path / name).glob("*.parquet")
        folder.mkdir(exist_ok=True)
        (folder / f"{name}.parquet").write_bytes(file.read_bytes())
    cat = spark.createDataFrame([("d", str(folder), str(tmp_path / "out"), 2)], "key string, preprocessed string, embeddings_out string, shards long")
    for limit, docs, files in ((None, 8, 2), (1, 5, 1)):
        records = str(tmp_path / f"records{limit}")
        assert ER.all_succeeded(ER.run_all(cat, records, ER.EmbedSettings(dim=8, file_limit=limit)))
        record = spark.read.schema(ER.RECORD_SCHEMA).json(records).collect()[0]
        assert (record["num_documents"], record["num_input_files"]) == (docs, files)
