import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.sources import catalog as C
from corpusloom.sources import registry as R
from corpusloom.sources import shards as S
from corpusloom.sources import sinks
from corpusloom.sources import splits as SP

CONFIG = {
    "laws": {
        "hf_name": "org/laws",
        "category": "pretraining",
        "format": "parquet",
        "hf_configs": ["metadata", "content"],
        "join_key": "id",
        "text_field": "content",
        "metadata_fields": ["title"],
        "text_strategy": {"fields": ["content"], "template": "raw_text"},
    },
    "notes": {"hf_name": "org/notes", "format": "jsonl"},
}


def test_registry_and_requirements(spark, tmp_path):
    path = tmp_path / "config.json"
    path.write_text(json.dumps({"datasets": CONFIG}))
    reg = R.registry(spark, R.load_config(str(path))["datasets"])
    assert reg.schema == R.REGISTRY_SCHEMA
    assert R.require_dataset(reg, "laws")["text_strategy"]["fields"] == ["content"]
    with pytest.raises(KeyError):
        R.require_dataset(reg, "absent")
    with pytest.raises(ValueError):
        R.require_dataset(reg, "notes")


@pytest.fixture
def shard_root(spark, tmp_path, sf):
    root = tmp_path / "laws" / "preprocessed"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").repartition(3)
    docs.write.parquet(str(root))
    return str(root), docs.count()


def test_inventory_reads_no_column(spark, shard_root):
    root, total = shard_root
    counted = S.shard_inventory(spark.read.parquet(root))
    assert counted.count() == 3
    assert counted.agg(F.sum("rows")).head()[0] == total
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan


def test_scan_is_pruned_and_has_provenance(spark, shard_root):
    root, total = shard_root
    scan = S.scan_shards(spark, root, ["doc_id"])
    assert "ReadSchema: struct<doc_id:bigint>" in scan._jdf.queryExecution().executedPlan().toString()
    names = {r[0] for r in S.with_source_shard(spark.read.parquet(root)).select("source_shard").distinct().collect()}
    assert names == {f for f in os.listdir(root) if f.endswith(".parquet")}
    ordered = S.with_scan_order(spark.read.parquet(root)).select("shard_path", "shard_row").distinct()
    assert ordered.count() == total


def test_corrupt_shard(spark, shard_root):
    root, total = shard_root
    with open(f"{root}/part-99999-bad.parquet", "wb") as fh:
        fh.write(b"not parquet at all")
    files = S.list_files(spark, root)
    assert files.count() == 4
    schema = "doc_id long, text string"
    rows = {os.path.basename(r["path"]): r["rows"] for r in S.count_shards(spark, files, root, schema, "zero").collect()}
    assert rows["part-99999-bad.parquet"] == 0 and sum(rows.values()) == total
    with pytest.raises(Exception):
        S.count_shards(spark, files, root, schema, "fail").collect()


def paths_df(spark, *paths):
    return S.split_path(spark.createDataFrame([(p,) for p in paths], "path string"))


def test_listing_styles(spark):
    files = paths_df(
        spark, "/a/part-1.parquet", "/a/part_1_of_2.parquet", "/a/part_9.parquet", "/a/x.parquet", "/a/.part-0.parquet",
        "/b/x.parquet", "/b/y.parquet", "/b/notes.txt",
    )
    embed = {r["path"] for r in S.shard_filter(files, "embed").collect()}
    assert embed == {"/a/part-1.parquet", "/a/part_1_of_2.parquet", "/b/x.parquet", "/b/y.parquet"}
    reduce = {r["path"] for r in S.shard_filter(files, "reduce").collect()}
    assert reduce == {"/a/part-1.parquet", "/a/part_1_of_2.parquet", "/a/part_9.parquet"}
    assert S.limit_shards(files, 0).count() == files.count()
    assert S.limit_shards(S.shard_filter(files, "embed"), 1).count() == 2


def test_canonical_names_are_stable(spark):
    done = paths_df(spark, "/a/part-00000-of-00002.parquet", "/a/part-00001-of-00002.parquet")
    assert not S.canonical_names(done).filter("renamed").count()
    fresh = paths_df(spark, "/a/b.parquet", "/a/a.parquet")
    names = {r["old_name"]: r["new_name"] for r in S.canonical_names(fresh).collect()}
    assert names == {"a.parquet": "part-00000-of-00002.parquet", "b.parquet": "part-00001-of-00002.parquet"}


def small_catalog(spark):
    disk = spark.createDataFrame([("laws", 10, 2), ("extra", 5, 1), ("empty", 0, 0), (".tmp", 1, 1)], "key string, rows long, shards long")
    return C.catalog(R.registry(spark, CONFIG), disk, "/data")


def test_catalog_and_export(spark, tmp_path):
    cat = small_catalog(spark)
    status = {r["key"]: r["status"] for r in cat.collect()}
    assert status == {"laws": C.READY, "extra": C.DISK_ONLY_READY, "empty": C.MISSING, "notes": C.MISSING}
    C_json, C_tsv = str(tmp_path / "j"), str(tmp_path / "t")
    sinks.export_catalog(cat, C_json, "json")
    sinks.export_catalog(cat, C_tsv, "tsv")
    back = spark.read.json(C_json)
    assert set(back.columns) == set(C.EXPORT_COLUMNS) and back.count() == 4
    tsv = spark.read.option("header", "true").option("sep", "\t").csv(C_tsv)
    assert tsv.columns == C.EXPORT_COLUMNS
    with pytest.raises(ValueError):
        sinks.export_catalog(cat, C_json, "xml")


def test_selection_rules(spark, tmp_path):
    cat = small_catalog(spark)
    assert C.select_datasets(cat, exact=[]).count() == 4
    with pytest.raises(ValueError):
        C.select_datasets(cat, exact=["laws"], prefix="l")
    assert C.parse_key_lines(["", "# no", " laws ", "laws"]) == ["laws"]
    keys = tmp_path / "keys.txt"
    keys.write_text("# comment\n\n laws \nabsent\nempty\n")
    wanted = C.read_key_list(spark, str(keys))
    assert {r["key"]: r["reason"] for r in C.missing_keys(cat, wanted).collect()} == {
        "absent": C.NO_DIRECTORY,
        "empty": C.NO_PREPROCESSED,
    }
    assert C.select_wanted(cat, wanted).count() == 0
    assert C.select_wanted(cat, wanted.filter("key = 'laws'")).count() == 1
    hidden = C.missing_keys(cat, wanted.filter("key = 'laws'"), available=C.candidates(cat).filter("key <> 'laws'"))
    assert hidden.head()["reason"] == C.NOT_SELECTABLE


def test_sidecars(spark, tmp_path):
    for name, text in (("good", '{"dataset_key": "d",\n "num_documents": 3}'), ("bad", "{not json")):
        folder = tmp_path / "d" / name
        (folder / "embeddings").mkdir(parents=True)
        (folder / "metadata.json").write_text(text)
    (tmp_path / "d" / "none" / "embeddings").mkdir(parents=True)
    root = str(tmp_path)
    paths = spark.createDataFrame(
        [(root, f"{root}/d/{s}/embeddings/part-0.parquet") for s in ("good", "bad", "none")], "root string, path string"
    )
    splits = SP.summarise_splits(SP.discover_splits(paths)).withColumn(
        "embedding_dir", F.concat(F.lit("file:"), "embedding_dir")
    )
    schema = T.StructType([T.StructField("dataset_key", T.StringType()), T.StructField("num_documents", T.LongType())])
    rows = {r["sub_label"]: r["metadata"] for r in SP.with_sidecars(splits, SP.read_sidecars(spark, root, schema)).collect()}
    assert rows["good"]["num_documents"] == 3
    assert rows["none"] is None and (rows["bad"] is None or rows["bad"]["num_documents"] is None)


def test_flat_root_needs_no_subfolder(spark):
    rows = [("/v/laws/embedding", "/v/laws/embedding/part-0.parquet"), ("/w/x", "/w/x/part-0.parquet"), ("/w/x", "/w/x/d/s/embeddings/part_1.parquet")]
    got = {(r["dataset_key"], r["sub_label"]) for r in SP.discover_splits(spark.createDataFrame(rows, "root string, path string")).collect()}
    assert got == {("laws", "embedding"), ("d", "s")}


def test_round_trips(spark, tmp_path, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = str(tmp_path / "p")
    sinks.write_parquet(docs.coalesce(1), out, columns=["doc_id", "lang"], rows_per_shard=50)
    assert len([f for f in os.listdir(out) if f.endswith(".parquet")]) == -(-docs.count() // 50)
    assert os.path.exists(f"{out}/_SUCCESS")
    back = spark.read.parquet(out)
    assert back.columns == ["doc_id", "lang"]
    assert back.exceptAll(docs.select("doc_id", "lang")).isEmpty()
    csv = str(tmp_path / "c")
    sinks.write_csv(docs.select("doc_id", "lang"), csv, enabled=False)
    assert not os.path.exists(csv)
    sinks.write_csv(docs.select("doc_id", "lang"), csv)
    assert spark.read.option("header", "true").csv(csv).count() == docs.count()
