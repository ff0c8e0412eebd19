import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.operators import affinities as A
from corpusloom.operators import neighbors as N

SPLIT = ("s",)


def frame(spark, parts):
    rows = [(s, i, [float(v) for v in x]) for s, m in parts.items() for i, x in enumerate(m)]
    return spark.createDataFrame(rows, "s string, row_id long, embeddings array<double>").repartition(3)


def brute(m, k, metric):
    if metric == "cosine":
        m = m / np.linalg.norm(m, axis=1, keepdims=True)
    d2 = ((m[:, None] - m[None]) ** 2).sum(-1)
    d = d2 / 2 if metric == "cosine" else np.sqrt(d2)
    out = {}
    for i in range(len(m)):
        order = sorted((d[i, j], j) for j in range(len(m)) if j != i)[:k]
        out[i] = order
    return out


def check(df, parts, k, metric):
    got = {}
    for r in df.collect():
        got.setdefault((r["s"], r["row_id"]), []).append((r["rank"], r["neighbor"], r["distance"]))
    for s, m in parts.items():
        for i, want in brute(m, k, metric).items():
            mine = sorted(got.get((s, i), []))
            assert [j for _, j, _ in mine] == [j for _, j in want]
            assert np.allclose([d for _, _, d in mine], [d for d, _ in want], atol=1e-12)


@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
@pytest.mark.parametrize("block_rows", [7, 1000])
def test_blocks_match_brute_force(spark, metric, block_rows):
    rng = np.random.default_rng(3)
    parts = {"big": rng.normal(size=(60, 6)) * rng.uniform(1, 5, (60, 1)), "small": rng.normal(size=(4, 6))}
    check(N.knn_exact(frame(spark, parts), 5, metric, SPLIT, block_rows=block_rows), parts, 5, metric)


def test_copies_tie_by_id(spark):
    """A third of the rows are the same vector: zero distances, smallest ids first."""
    rng = np.random.default_rng(4)
    m = rng.integers(-3, 4, size=(60, 4)).astype(float)
    m[::3] = [1.0, 2.0, 3.0, 4.0]
    parts = {"a": m}
    check(N.knn(frame(spark, parts), 6, "euclidean", "exact", SPLIT), parts, 6, "euclidean")


def test_affinities_reach_the_perplexity(spark):
    rng = np.random.default_rng(5)
    knn = N.knn_exact(frame(spark, {"a": rng.normal(size=(40, 5))}), 15, "euclidean", SPLIT)
    rows = {}
    for r in A.tsne_affinities(knn, 5, SPLIT).collect():
        rows.setdefault(r["row_id"], []).append(r["p"])
    for p in rows.values():
        p = np.array(p)
        assert p.sum() == pytest.approx(1) and np.exp(-(p * np.log(p)).sum()) == pytest.approx(5, rel=1e-6)
    w = {}
    for r in A.umap_memberships(knn, SPLIT).collect():
        w.setdefault(r["row_id"], []).append(r["w"])
    assert all(sum(v) == pytest.approx(np.log2(15), rel=1e-6) for v in w.values())


def test_identical_points_have_finite_weights(spark):
    knn = N.knn_exact(frame(spark, {"a": np.ones((12, 3))}), 5, "euclidean", SPLIT)
    p = [r["p"] for r in A.tsne_affinities(knn, 3, SPLIT).collect()]
    assert np.allclose(p, 0.2)
    w = [r["w"] for r in A.fuzzy_union(A.umap_memberships(knn, SPLIT), SPLIT).collect()]
    assert np.allclose(w, 1.0)


def test_cells_are_exact_with_all_probes_and_close_with_few(spark):
    rng = np.random.default_rng(6)
    centers = rng.normal(size=(6, 8)) * 3
    m = np.concatenate([c + rng.normal(size=(n, 8)) for c, n in zip(centers, (80, 20, 10, 10, 10, 10))])
    parts = {"a": m}
    df = frame(spark, parts)
    full = N.knn_ivf(df, 5, "euclidean", SPLIT, cells=6, probes=6, block_rows=16)
    check(full, parts, 5, "euclidean")
    few = {(r["row_id"], r["neighbor"]) for r in N.knn_ivf(df, 5, "cosine", SPLIT, cells=6, probes=2, block_rows=16).collect()}
    want = {(i, j) for i, near in brute(m, 5, "cosine").items() for _, j in near}
    assert len(few) == len(want) and len(few & want) / len(want) > 0.85


@pytest.mark.parametrize("scale", [1e5, 1e6, 1e12])
def test_an_outlier_blurs_nothing(spark, scale):
    rng = np.random.default_rng(7)
    m = rng.normal(size=(120, 6))
    m[0] *= scale
    parts = {"a": m, None: rng.normal(size=(30, 6))}
    got = N.knn(frame(spark, parts), 5, "euclidean", split=SPLIT)
    near = {}
    for r in got.collect():
        near.setdefault((r["s"], r["row_id"]), []).append((r["rank"], r["neighbor"]))
    for s, x in parts.items():
        for i, want in brute(x, 5, "euclidean").items():
            if (s, i) != ("a", 0):  # the outlier's own distances differ in their last digits only
                assert [j for _, j in sorted(near[s, i])] == [j for _, j in want]
            assert len(near[s, i]) == 5


def test_cell_search_is_complete_and_repeats(spark):
    rng = np.random.default_rng(8)
    df = frame(spark, {"a": rng.normal(size=(100, 5))})
    first = N.knn(df, 90, "euclidean", "ivf", SPLIT)
    assert first.groupBy("row_id").count().filter("count <> 90").isEmpty() and first.count() == 9000
    again = N.knn(df.repartition(7), 20, "euclidean", "ivf", SPLIT)
    assert sorted(again.collect()) == sorted(N.knn(df.coalesce(1), 20, "euclidean", "ivf", SPLIT).collect())


@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
def test_pruned_search_equals_all_pairs(spark, metric):
    """Splits of 1 to 400 rows with clusters, ties and copies; slices and cells smaller than the number of neighbours too."""
    from corpusloom.operators.pruned import knn_pruned

    rng = np.random.default_rng(4)
    rows = []
    for s, n in (("big", 400), ("mid", 40), ("few", 3), ("one", 1), (None, 12)):
        x = rng.integers(0, 8, size=(8, 6))[rng.integers(0, 8, n)] * 4 + rng.integers(0, 2, size=(n, 6)) + 1
        rows += [(s, i, [float(v) for v in r]) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "s string, row_id long, embeddings array<double>")
    want = {tuple(r) for r in N.knn_exact(df, 5, metric, ("s",)).withColumn("distance", F.round("distance", 9)).collect()}
    for block, cell in ((2048, None), (7, 4)) if metric == "euclidean" else ((16, 10),):
        found = knn_pruned(df, 5, metric, ("s",), block_rows=block, cell_rows=cell)
        got = [tuple(r) for r in found.edges.withColumn("distance", F.round("distance", 9)).select("s", "row_id", "neighbor", "distance", "rank").collect()]
        assert len(got) == len(set(got)) and set(got) == want, (block, cell)
    report = {r["s"]: (r["pairs"], r["compared"]) for r in found.report.collect()}
    assert report["big"][0] == 400 * 399 // 2 and report["one"] == (0, 0)
    if metric == "euclidean":
        assert report["big"][1] * 3 < report["big"][0]
    assert knn_pruned(df.where("false"), 5, metric, ("s",)).edges.count() == 0


def dealt_rows(monkeypatch, *modules):
    """Counts the rows that ``search_groups`` is given, call by call."""
    counted, search = [], N.search_groups

    def counting(dealt, *args):
        counted.append(dealt.count())
        return search(dealt, *args)

    for module in modules:
        monkeypatch.setattr(module, "search_groups", counting)
    return counted


@pytest.mark.parametrize("method", ["exact", "ivf"])
def test_vectors_are_copied_a_bounded_number_of_times(spark, monkeypatch, method):
    """Far more blocks than groups: copies follow the groups, and no list is cut again by all pairs of blocks."""
    m = np.random.default_rng(9).normal(size=(900, 4))
    counted = dealt_rows(monkeypatch, N)
    if method == "exact":
        found = N.knn_exact(frame(spark, {"a": m}), 5, "euclidean", SPLIT, block_rows=8)
    else:
        found = N.knn_ivf(frame(spark, {"a": m}), 5, "euclidean", SPLIT, cells=3, probes=3, block_rows=8)
    check(found, {"a": m}, 5, "euclidean")
    assert counted == [900 * (N.GROUPS if method == "exact" else 3)]


def test_pruned_copies_follow_groups_not_cells(spark, monkeypatch):
    from corpusloom.operators import pruned

    m = np.random.default_rng(10).normal(size=(600, 4))
    counted = dealt_rows(monkeypatch, pruned)
    found = pruned.knn_pruned(frame(spark, {"a": m}), 5, "euclidean", SPLIT, block_rows=64, cell_rows=4)
    check(found.edges, {"a": m}, 5, "euclidean")
    assert max(counted) <= 600 * 11  # ten groups of 64 rows, 150 cells


def test_rows_of_one_id_share_a_list(spark):
    rows = [("a", i // 2, [float(i), 1.0]) for i in range(40)]
    df = spark.createDataFrame(rows, "s string, row_id long, embeddings array<double>")
    got = N.knn_exact(df, 3, "euclidean", SPLIT, block_rows=8)
    assert got.groupBy("row_id").count().where("count <> 3").isEmpty() and got.where("neighbor = row_id").isEmpty()
    first = got.where("row_id = 0").orderBy("rank").collect()
    assert [(r["neighbor"], r["distance"]) for r in first] == [(1, 1.0), (1, 2.0), (1, 2.0)]
