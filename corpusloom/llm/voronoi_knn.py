"""Exact top-k inner products by a Voronoi join.

A few pivots cut space into cells. Queries are grouped by their nearest pivot,
data vectors too, and each group is summed up by a few numbers: radius, largest
norm, and the smallest distances of different ids to the pivot. From the summaries alone follows,
for each group of queries, a score that its k-th best candidate reaches at least;
a data vector is copied to a group only if its own distance to its pivot allows
such a score. Groups are then solved one by one, exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.session import broadcast_if_small, cut_lineage

#: Pivots at most, queries of a group, and data rows of one local problem.
PIVOTS, GROUP_QUERIES, SLICE_ROWS = 64, 1024, 16_384


def usable(vector: Column) -> Column:
    """Neither null nor holding null or non-finite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False))


def _padded(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for row, v in zip(out, vectors):
        row[: len(v)] = v
    return out


def _located(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Adds each vector's nearest pivot, its distance and its norm."""
    width, half = pivots.shape[1], (pivots**2).sum(1) / 2

    def locate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x = _padded(b["v"], width)
            cell = (x @ pivots.T - half).argmax(1) if len(b) else np.zeros(0, int)
            far = np.sqrt(((x - pivots[cell]) ** 2).sum(1))
            yield b.assign(cell=cell.astype("int32"), far=far, norm=np.sqrt((x**2).sum(1)))

    return rows.mapInPandas(locate, "id long, v array<double>, is_query boolean, cell int, far double, norm double")


def _needs(cells: list, pivots: np.ndarray, k: int):
    """For each query group and data cell the distance to the cell's pivot from which a vector may matter.

    A query is its cell's pivot plus at most the radius, a data vector its pivot
    plus ``far``: their product differs from the pivots' product by no more than
    radius * |pivot| + norm * far. The lower bounds of the k + 1 best ids over all
    cells (one may be the query's own) give what the k-th best score reaches; an id
    counts once, with its best bound, however many rows have it.
    """
    norms, products = np.sqrt((pivots**2).sum(1)), pivots @ pivots.T

    def needs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for g in b.itertuples():
                bound: dict = {}
                for c, nearest in cells:
                    for far, i in nearest:
                        low = products[g.cell, c] - g.radius * norms[c] - g.norm * far
                        bound[i] = max(bound.get(i, -np.inf), low)
                at_least = sorted(bound.values(), reverse=True)
                reach = at_least[k] - 1e-6 * (1 + abs(at_least[k])) if len(at_least) > k else -np.inf
                for c, _ in cells:
                    gap = reach - products[g.cell, c] - g.radius * norms[c]
                    if gap <= 0 or g.norm > 0:
                        out.append((c, g.group, max(gap / g.norm, 0.0) if gap > 0 else 0.0))
            yield pd.DataFrame(out, columns=["cell", "group", "need"])

    return needs


def _solve(k: int):
    def solve(key: tuple, queries: pd.DataFrame, data: pd.DataFrame) -> pd.DataFrame:
        names = ["query_id", "vec_id", "score"]
        if not len(queries) or not len(data):
            return pd.DataFrame({n: pd.Series(dtype="int64") for n in names})
        width = max(map(len, [*queries["qv"], *data["v"]]))
        q, x = _padded(queries["qv"], width), _padded(data["v"], width)
        ids, own = data["id"].to_numpy(), queries["qid"].to_numpy()
        order = np.argsort(ids, kind="stable")
        ids, x = ids[order], x[order]
        parts = []
        for start in range(0, len(q), 256):
            score = q[start : start + 256] @ x.T
            score[own[start : start + 256, None] == ids[None, :]] = -np.inf
            for row, qid in zip(score, own[start : start + 256]):
                # Copies of an id may take places, so all rows as good as the k-th best id are looked at.
                take = min(len(row), k)
                while True:
                    cut = np.partition(row, -take)[-take]
                    near = np.flatnonzero((row >= cut) & (row > -np.inf))
                    near = near[np.lexsort((ids[near], -row[near]))]
                    unique = near[np.sort(np.unique(ids[near], return_index=True)[1])]
                    if len(unique) >= k or take == len(row):
                        break
                    take = min(len(row), take * 2)
                best = unique[:k]
                parts.append((np.full(len(best), qid), ids[best], row[best].astype("int64")))
        return pd.DataFrame(dict(zip(names, map(np.concatenate, zip(*parts)))))

    return solve


def top_products(
    vectors: DataFrame, is_query: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding",
    levels: int = 256, pivots: int = PIVOTS, group_queries: int = GROUP_QUERIES, slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """The k best candidates of every query: ``query_id, rank, vec_id, score``.

    Components become ``floor(levels * x)``; the score is the integer inner product,
    ties go to the smaller id, fewer than k candidates are all returned. Rows with a
    null id, and vectors that are null or hold null or non-finite components, take
    no part. A shorter vector counts as filled up with zeros. A query's candidates
    are the rows with another id; an id that several rows share counts once, with
    its best score. Other columns take no part.

    Pivots are a bounded choice of vectors (by a hash of the id); their cells'
    summaries and query counts, a few numbers for each, are all that the driver
    sees. Groups hold ``group_queries`` queries: a larger cell is dealt into
    several. A group's data are dealt into slices of about ``slice_rows``, so
    neither a common vector or id nor a crowded cell ends up in one task.
    """
    spark = vectors.sparkSession
    ints = F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * levels).cast("double"))
    rows = vectors.where(F.col(key).isNotNull() & usable(F.col(vector))).select(
        F.col(key).cast("long").alias("id"), ints.alias("v"), is_query.alias("is_query")
    )
    chosen = rows.orderBy(F.xxhash64("id"), "id").limit(pivots).collect()
    if not chosen:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    width = rows.agg(F.max(F.size("v"))).first()[0]
    points = _padded(pd.Series([r["v"] for r in chosen]), max(width, 1))

    # Rows are dealt by their number, so the copies of an id don't meet in one task.
    located = cut_lineage(_located(rows, points).withColumn("place", F.monotonically_increasing_id()))
    queries = located.where("is_query")
    crowd = {r["cell"]: r["count"] for r in queries.groupBy("cell").count().collect()}
    # Cells with few queries share a group with their like, up to the size of a group; large cells are dealt into several.
    first, room, group_of, deal = 0, 0, {}, {}
    for cell in sorted(crowd):
        parts = -(-crowd[cell] // group_queries)
        if parts == 1 and crowd[cell] <= room:
            group_of[cell], deal[cell], room = first - 1, 1, room - crowd[cell]
        else:
            group_of[cell], deal[cell] = first, parts
            first, room = first + parts, (group_queries - crowd[cell] if parts == 1 else 0)
    if not crowd:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    table = spark.createDataFrame([(c, group_of[c], deal[c]) for c in crowd], "cell int, first int, parts int")
    # One row per cell, PIVOTS at most.
    salt = F.pmod(F.xxhash64("place"), F.col("parts")).cast("int")
    queries = queries.join(F.broadcast(table), "cell").withColumn("group", F.col("first") + salt)

    small = Window.partitionBy("cell").orderBy("far", "id")
    cells = [
        (r["cell"], [(x["far"], x["id"]) for x in r["nearest"]])
        for r in located.groupBy("cell", "id")
        .agg(F.min("far").alias("far"))
        .withColumn("n", F.row_number().over(small))
        .where(f"n <= {k + 1}")
        .groupBy("cell")
        .agg(F.collect_list(F.struct("far", "id")).alias("nearest"))
        .collect()
    ]
    summary = queries.groupBy("group", "cell").agg(F.max("far").alias("radius"), F.max("norm").alias("norm"))
    limits = summary.mapInPandas(_needs(cells, points, k), "cell int, group int, need double")
    limits = cut_lineage(limits.groupBy("cell", "group").agg(F.min("need").alias("need")))

    count = located.count()
    slices = max(int(spark.conf.get("spark.sql.shuffle.partitions")) // max(1, first), -(-count // slice_rows))
    near = located.join(broadcast_if_small(limits), "cell").where("far >= need")
    data = near.select("group", F.pmod(F.xxhash64("place"), F.lit(slices)).cast("int").alias("slice"), "id", "v")
    asked = queries.select("group", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"), F.col("id").alias("qid"), F.col("v").alias("qv"))
    solved = asked.groupBy("group", "slice").cogroup(data.groupBy("group", "slice"))
    solved = solved.applyInPandas(_solve(k), "query_id long, vec_id long, score long")
    best = solved.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(f"rank <= {k}").select("query_id", "rank", "vec_id", "score")
