from pyspark.sql import functions as F

from corpusloom.queries import runs


def tables(spark, d, files=5):
    """Documents in several files, with labels and conversations."""
    docs = spark.range(60).selectExpr("id AS doc_id", "concat('text ', id) AS text", "element_at(array('de', 'en', 'es', 'fr'), int(id % 4) + 1) AS lang", "'s' AS source")
    docs.repartition(files).write.parquet(f"{d}/documents.parquet")
    spark.range(20).selectExpr("id AS doc_id", "int(id % 2) AS quality", "0 AS toxic").coalesce(1).write.parquet(f"{d}/labels.parquet")
    spark.range(3).selectExpr("id AS conv_id", "0L AS turn", "'user' AS role", "'hi' AS text").coalesce(1).write.parquet(f"{d}/conversations.parquet")
    return d


def shards(spark, root):
    """Files with rows, by folder."""
    read = spark.read.option("recursiveFileLookup", "true").parquet(root)
    at = read.select(F.col("_metadata.file_path").alias("p")).distinct()
    return {r[0]: r[1] for r in at.groupBy(F.regexp_extract("p", "([^/]*)/[^/]*$", 1)).count().collect()}


def test_no_language_is_written_by_one_task(spark, tmp_path, monkeypatch):
    d = tables(spark, str(tmp_path))
    for name, languages in (("embed_folders", 4), ("embed_failures", 3)):
        monkeypatch.setattr(runs, "folder", lambda _, n=name: f"{tmp_path}/{n}")
        found = getattr(runs, name)(spark, d).collect()
        assert len(found) == 4 and all(r["num_documents"] == 15 for r in found if r["ok"])
        many = [n for place, n in shards(spark, f"{tmp_path}/{name}/out").items() if place.startswith("lang=")]
        assert len(many) == languages and min(many) > 1


def test_content_has_as_many_shards_as_the_scan_tasks(spark, tmp_path, monkeypatch):
    d = tables(spark, str(tmp_path))
    monkeypatch.setattr(runs, "folder", lambda _: f"{tmp_path}/run")
    assert runs.preprocess_folders(spark, d).count() == 60
    assert shards(spark, f"{tmp_path}/run/raw/content")["content"] > 3
