from hashlib import md5

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import sampling as SM

SPLIT = ("s",)


@pytest.fixture(scope="module")
def rows(spark):
    """One split holds most rows; the others are tiny."""
    sizes = {"hot": 2000, "n4": 4, "n5": 5, "n6": 6, "n31": 31, "n91": 91}
    data = [(s, f"{s}-{i}") for s, n in sizes.items() for i in range(n)]
    return spark.createDataFrame(data, "s string, k string").repartition(5), sizes, data


@pytest.mark.parametrize("cap", [1, 5, 31, 700, 5000])
def test_sample_is_exact_and_seeded(rows, cap):
    df, sizes, data = rows
    got = SM.sample_split(df, "k", cap, 7, SPLIT)
    picked = {}
    for r in got.collect():
        picked.setdefault(r["s"], set()).add(r["k"])
    for s, n in sizes.items():
        order = sorted((md5(f"7:{k}".encode()).hexdigest(), k) for t, k in data if t == s)
        assert picked[s] == {k for _, k in order[: min(cap, n)]}
    moved = SM.sample_split(df.repartition(2), "k", cap, 7, SPLIT)
    assert moved.exceptAll(got).isEmpty()


def test_row_ids_are_dense_for_hot_and_tiny_splits(rows):
    df, sizes, data = rows
    numbered = SM.with_row_id(df.repartition(6), SPLIT, ["k"]).collect()
    for s, n in sizes.items():
        mine = sorted((r["k"], r["row_id"]) for r in numbered if r["s"] == s)
        assert [i for _, i in mine] == list(range(n))


def test_params_and_eligibility(spark):
    counts = spark.createDataFrame([(n,) for n in (4, 5, 6, 31, 91, 1000)], "rows long")
    got = {r["rows"]: r for r in SM.reduction_params(SM.eligible(counts)).collect()}
    assert 4 not in got
    for n, r in got.items():
        assert r["perplexity"] == min(30, max(1, n - 1) // 3)
        assert r["tsne_neighbors"] == min(n - 1, max(90, 3 * r["perplexity"]))
        assert r["umap_neighbors"] == min(15, n - 1)
    assert SM.plan_reduction(counts, 0).filter("planned_rows <> rows").isEmpty()


def test_vector_check(spark):
    df = spark.createDataFrame(
        [("ok", [1.0, 2.0]), ("ok", [0.0, 1.0]), ("ragged", [1.0]), ("ragged", [1.0, 2.0]), ("null", None), ("hole", [None, 1.0])],
        "s string, embeddings array<float>",
    )
    checked = SM.check_vectors(df, split=SPLIT)
    assert {r["s"] for r in checked.filter("ok").collect()} == {"ok"}
    SM.require_vectors(checked.filter("s = 'ok'"))
    with pytest.raises(ValueError):
        SM.require_vectors(checked)


def test_hot_split_is_not_ranked_in_one_task(rows):
    df, _, _ = rows
    plan = SM.sample_split(df, "k", 700, 7, SPLIT)._jdf.queryExecution().executedPlan().toString()
    assert "_bucket" in plan and F is not None
