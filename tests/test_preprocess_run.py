import pytest
from pyspark.sql import functions as F

from corpusloom.plans.preprocess_run import PreprocessSettings, run_preprocess


def test_folders_in_and_out(spark, tmp_path):
    raw = tmp_path / "raw"
    for name, ids in (("content/a/x.parquet", range(5)), ("content/b.parquet", range(5, 9))):
        rows = [(i, f" text {i} " if i != 3 else " ") for i in ids]
        spark.createDataFrame(rows, "id long, content string").coalesce(1).write.parquet(str(raw / name))
    meta = [(i, f"t{i}") for i in (0, 1, 1, 8)] + [(1, "last")]
    spark.createDataFrame(meta, "id long, title string").coalesce(1).write.parquet(str(raw / "metadata/m.parquet"))
    s = PreprocessSettings("id", "content", ["title"])
    out = run_preprocess(spark, str(raw), str(tmp_path / "out"), s)
    found = {r["id"]: (r["text"], r["title"]) for r in out.collect()}
    assert set(found) == {0, 1, 2, 4, 5, 6, 7, 8} and found[1] == ("text 1", "last") and found[2] == ("text 2", "")
    assert out.select("source_shard").distinct().count() == 2 and out.columns == ["text", "id", "title", "source_shard"]
    limited = PreprocessSettings("id", "content", ["title"], shard_limit=1, record_limit=3)
    few = run_preprocess(spark, str(raw), str(tmp_path / "few"), limited)
    assert sorted(r["id"] for r in few.collect()) == [0, 1, 2]
    empty = spark.read.parquet(str(raw / "metadata/m.parquet")).filter(F.lit(False))
    empty.write.mode("overwrite").parquet(str(tmp_path / "raw2/metadata"))
    spark.range(1).selectExpr("id", "'x' AS content").write.parquet(str(tmp_path / "raw2/content"))
    with pytest.raises(ValueError, match="no rows"):
        run_preprocess(spark, str(tmp_path / "raw2"), str(tmp_path / "o2"), s)
    with pytest.raises(FileNotFoundError):
        (tmp_path / "raw3/content").mkdir(parents=True)
        run_preprocess(spark, str(tmp_path / "raw3"), str(tmp_path / "o3"), s)
