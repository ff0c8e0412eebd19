import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.plans import reduce_run as RR
from corpusloom.session import ensure_checkpoint_dir

SETTINGS = RR.ReduceSettings(cap=30, iterations=2, epochs=2, tsne_3d=False)


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(2)
    sizes = {"one": 40, "two": 12, "few": 4}
    rows = [("d", s, f"{s}{i}", [float(v) for v in rng.normal(size=8)]) for s, n in sizes.items() for i in range(n)]
    rows += [("d", "ragged", f"r{i}", [1.0] * (3 + i % 2)) for i in range(8)]
    return spark.createDataFrame(rows, "dataset_key string, sub_label string, id string, embeddings array<float>")


@pytest.fixture(scope="module")
def labels(vectors):
    return vectors.select("dataset_key", "sub_label").distinct().withColumns(
        {
            "dataset_name": F.lit("D"),
            "category": F.lit("c"),
            "text_strategy_template": F.lit("raw_text"),
            "text_strategy_fields": F.lit('["text"]'),
        }
    )


def test_run_writes_records_and_resumes(spark, tmp_path, vectors, labels):
    out = str(tmp_path / "out")
    scratch = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(scratch))
    report = {r["sub_label"]: r for r in RR.run_reduce(vectors, labels, "id", out, SETTINGS).collect()}
    assert set(os.listdir(scratch)) == before
    assert report["one"]["done"] and report["two"]["done"]
    assert not report["few"]["done"] and report["few"]["ok"]
    assert not report["ragged"]["ok"] and "ragged" in report["ragged"]["error"]

    reduced = spark.read.parquet(f"{out}/reduced")
    assert reduced.columns == [*RR.LABEL_COLUMNS, "row_id", *RR.COORDINATE_COLUMNS, "id", "split_key", "split_label"]
    assert dict(reduced.dtypes)["sub_label"] == "string"
    counts = {r["sub_label"]: r["count"] for r in reduced.groupBy("sub_label").count().collect()}
    assert counts == {"one": 30, "two": 12}
    one = reduced.filter("sub_label = 'one'")
    assert sorted(r[0] for r in one.select("row_id").collect()) == list(range(30))
    assert one.filter("NOT isnan(tsne_3d_x) OR isnan(tsne_2d_x) OR isnan(umap_2d_x) OR isnan(umap_3d_z)").isEmpty()
    assert os.path.isdir(f"{out}/reduced_csv")

    assert {r[0] for r in reduced.select("sub_label").distinct().collect()} == {"one", "two"}

    record = {r["sub_label"]: r for r in RR.read_records(spark, f"{out}/records").collect()}
    assert record["one"]["num_rows"] == 30 and record["one"]["total_available"] == 40
    assert record["two"]["columns_2d_3d"] == RR.COORDINATE_COLUMNS
    again = RR.run_reduce(vectors, labels, "id", out, SETTINGS)
    assert {r["sub_label"] for r in again.collect()} == {"few", "ragged"}


def test_column_order(vectors, labels):
    good = vectors.filter("sub_label IN ('one', 'two')")
    out = RR.reduce(good, labels, "id", SETTINGS)
    assert out.columns == [*RR.LABEL_COLUMNS, "row_id", *RR.COORDINATE_COLUMNS, "id"]
    assert dict(out.dtypes)["tsne_2d_x"] == "float" and dict(out.dtypes)["row_id"] == "bigint"


def test_layout_queries_run_full_rounds(spark, sf, monkeypatch):
    from corpusloom.queries import reduction as Q

    asked, default = {}, RR.ReduceSettings()
    monkeypatch.setattr(Q, "tsne_layout", lambda p, start, dims, rounds: asked.setdefault(("tsne", dims), rounds))
    monkeypatch.setattr(Q, "umap_layout", lambda p, start, dims, rounds: asked.setdefault(("umap", dims), rounds))
    monkeypatch.setattr(Q.RR, "reduce", lambda rows, labels, key, settings: settings)
    for name, dims in (("tsne", 2), ("tsne", 3), ("umap", 2), ("umap", 3)):
        getattr(Q, f"{name}_query")(dims)(spark, sf)
    assert asked == {("tsne", 2): 1000, ("tsne", 3): 1000, ("umap", 2): 500, ("umap", 3): 500}
    full = Q.reduce_full(spark, sf)
    assert (full.iterations, full.epochs) == (default.iterations, default.epochs) == (1000, 500)
