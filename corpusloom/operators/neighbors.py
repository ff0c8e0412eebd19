"""k-nearest-neighbour graph per split."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from corpusloom.operators.sampling import SEED, SPLIT, count_splits
from corpusloom.session import broadcast_if_small, cut_lineage, join_keys

# Rows of one block: two blocks of 4096-wide vectors take 128 MB as float64, their products 32 MB each.
BLOCK_ROWS = 2048

# Groups of queries a split is dealt into, which is how often its vectors are copied, rows of a group at least
# if there are fewer groups, and its rows and numbers at most. Tasks at most that groups are dealt to.
GROUPS = 24
FEWEST_ROWS = 256
GROUP_ROWS = 1 << 15
GROUP_VALUES = 1 << 23
MOST_TASKS = 1024

# What a row is in a group: asks only, asks and is found, is found only.
QUERY, BOTH, OTHER = range(3)

# Numbers of a task's difference rows looked at together.
DIFFERENCES = 1 << 22

# Cells of the approximate search at most, queries of a cell in one group at most, cells searched at least, and values of the sample its centres come from.
MAX_CELLS = 4096
CELL_GROUP_ROWS = 1 << 14
PROBES = 8
SAMPLE_VALUES = 1 << 25


def stack_vectors(column: pa.ChunkedArray) -> np.ndarray:
    """A list column of equal lengths as a float64 matrix."""
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return values.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(values), -1)


def unit_rows(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(norm > 0, norm, 1.0)


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d2 = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T)
    return np.maximum(d2, 0.0)


def nearest(
    left_ids: np.ndarray, left: np.ndarray, right_ids: np.ndarray, right: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k nearest right rows of every left row, itself excluded, ties by id.

    Returns left positions, right positions and squared distances. ``right_ids``
    must be ascending. The product form of a distance is off by a few units in
    the last place of the two rows' own lengths, so every row that may belong to
    the k nearest by that bound is looked at again with exact differences. Far
    rows have wide bounds of their own and none on other pairs.
    """
    squares = (left * left).sum(1)[:, None] + (right * right).sum(1)[None, :]
    d2 = np.maximum(squares - 2.0 * (left @ right.T), 0.0)
    slack = squares * (4 * (left.shape[1] + 4) * np.finfo(np.float64).eps)
    d2[left_ids[:, None] == right_ids[None, :]] = np.inf
    take = min(k, len(right_ids))
    kth = np.partition(d2 + slack, take - 1, axis=1)[:, take - 1 : take]
    row, col = np.nonzero((d2 - slack <= kth) & np.isfinite(d2))
    exact = np.empty(len(row))
    step = max(1, DIFFERENCES // max(1, left.shape[1]))
    for start in range(0, len(row), step):
        diff = left[row[start : start + step]] - right[col[start : start + step]]
        exact[start : start + step] = np.einsum("ij,ij->i", diff, diff)
    order = np.lexsort((col, exact, row))
    row, col, exact = row[order], col[order], exact[order]
    first = np.searchsorted(row, np.arange(len(left_ids)))
    keep = np.arange(len(row)) - first[row] < k
    return row[keep], col[keep], exact[keep]


def to_distance(d2: np.ndarray, metric: str) -> np.ndarray:
    """On unit vectors the cosine distance is half the squared distance."""
    return d2 / 2.0 if metric == "cosine" else np.sqrt(d2)


def edge_schema(df: DataFrame, split: Sequence[str], row_id: str) -> T.StructType:
    fields = [df.schema[c] for c in split] + [
        T.StructField(row_id, df.schema[row_id].dataType),
        T.StructField("neighbor", df.schema[row_id].dataType),
        T.StructField("distance", T.DoubleType()),
    ]
    return T.StructType(fields)


def closest(edges: DataFrame, k: int, split: Sequence[str], row_id: str) -> DataFrame:
    """Keep the k best edges of each row; a partial cut runs before the shuffle."""
    best = Window.partitionBy(*split, row_id).orderBy("distance", "neighbor")
    return edges.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


class _Tile:
    """Some query rows and their nearest rows so far among those compared with them."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, k: int, metric: str) -> None:
        self.ids, self.x, self.k, self.metric = ids, x, k, metric
        self.room = 1.0 - 4 * (x.shape[1] + 6) * np.finfo(np.float64).eps
        self.half = (x * x).sum(1) * (self.room / 2)
        self.kth = np.full(len(ids), np.inf)  # distance of the k-th row so far
        self.best = (np.empty(0, dtype=np.int64), np.empty(0), ids[:0])  # position, distance, neighbour
        self.new: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def compare(self, ids: np.ndarray, x: np.ndarray) -> None:
        """Look at some rows, ascending by id; the product form rules out the far ones as in ``nearest``."""
        if not len(ids):
            return
        if np.isinf(self.kth).any():
            row, col, d2 = nearest(self.ids, self.x, ids, x, self.k)
            self._take(row, to_distance(d2, self.metric), ids[col])
            return
        most = 2 * self.kth if self.metric == "cosine" else self.kth**2 * (1 + 8 * np.finfo(np.float64).eps)
        one = np.ones((len(ids), 1))
        left = np.column_stack([self.x, most / 2 - self.half, np.ones(len(self.ids))])
        right = np.hstack([x, one, (x * x).sum(1)[:, None] * (-self.room / 2)])
        row, col = np.divmod(np.flatnonzero(left @ right.T >= 0), len(ids))
        apart = self.ids[row] != ids[col]
        row, col = row[apart], col[apart]
        step = max(1, DIFFERENCES // max(1, x.shape[1]))
        for start in range(0, len(row), step):
            r, c = row[start : start + step], col[start : start + step]
            diff = self.x[r] - x[c]
            distance = to_distance(np.einsum("ij,ij->i", diff, diff), self.metric)
            near = distance <= self.kth[r]
            self._take(r[near], distance[near], ids[c[near]])

    def _take(self, row: np.ndarray, distance: np.ndarray, ids: np.ndarray) -> None:
        self.new.append((row, distance, ids))
        self.waiting += len(row)
        if self.waiting > len(self.ids) * self.k // 2 or np.isinf(self.kth).any():
            self.settle()

    def settle(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cut the lists to k rows each."""
        if self.new:
            row, distance, ids = (np.concatenate(v) for v in zip(self.best, *self.new))
            self.best, self.new, self.waiting = _first_k(row, distance, ids, self.k)[:3], [], 0
            row, distance, _ = self.best
            count = np.bincount(row, minlength=len(self.ids))
            full = count >= self.k
            self.kth[full] = distance[np.cumsum(count)[full] - 1]
        return self.best


def _first_k(row: np.ndarray, distance: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The k smallest (distance, id) of each row, in order, and their ranks from 1."""
    order = np.lexsort((ids, distance, row))
    row = row[order]
    rank = np.arange(len(row)) - np.searchsorted(row, row) + 1
    keep = rank <= k
    return row[keep], distance[order][keep], ids[order][keep], rank[keep]


class _Group:
    """The query rows of a group and all rows they are compared with, a part at a time.

    ``cells`` and ``meets`` say, where given, in which cell a row is and with which
    of the group's cells a row is to be compared.
    """

    def __init__(self, k: int, metric: str, block_rows: int) -> None:
        self.k, self.metric, self.block_rows = k, metric, block_rows
        self.queries: list[tuple] = []
        self.tiles: list[tuple[int | None, _Tile]] = []
        self.rows: list[tuple] = []
        self.waiting = 0

    def add(self, role: int, part: tuple) -> None:
        """``part``: ids, vectors, cells, meets of rows of one role; queries come before the rows that are none."""
        if role <= BOTH:
            self.queries.append(part)
        if role >= BOTH:
            self.rows.append(part)
            self.waiting += len(part[0])
        if role > BOTH and self.waiting >= self.block_rows:
            self._compare()

    def _joined(self, parts: list[tuple]) -> tuple:
        ids, x = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        if parts[0][2] is None:
            return ids, x, None, None
        return ids, x, np.concatenate([p[2] for p in parts]), [m for p in parts for m in p[3]]

    def _compare(self) -> None:
        if not self.tiles:
            ids, x, cells, _ = self._joined(self.queries)
            order = np.lexsort((ids,) if cells is None else (ids, cells))
            cuts = [0] if cells is None else [0, *(np.flatnonzero(np.diff(cells[order])) + 1)]
            for lo, hi in zip(cuts, [*cuts[1:], len(ids)]):
                for at in range(lo, hi, self.block_rows):
                    part = order[at : min(at + self.block_rows, hi)]
                    self.tiles.append((None if cells is None else int(cells[part[0]]), _Tile(ids[part], x[part], self.k, self.metric)))
            self.queries = []
        if not self.rows:
            return
        ids, x, cells, meets = self._joined(self.rows)
        self.rows, self.waiting = [], 0
        order = np.argsort(ids, kind="stable")
        for at in range(0, len(ids), self.block_rows):
            part = order[at : at + self.block_rows]
            near, vectors = ids[part], x[part]
            if cells is None:
                for _, tile in self.tiles:
                    tile.compare(near, vectors)
                continue
            found, which = np.unique(cells[part], return_inverse=True)
            example = {int(cells[i]): i for i in part}
            with_cells = [set(meets[example[int(c)]]) for c in found]
            for cell, tile in self.tiles:
                met = np.array([cell in w for w in with_cells])[which]
                tile.compare(near[met], vectors[met])

    def lists(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Row, neighbour, distance, rank; rows of one id share one list."""
        self._compare()
        ids = np.concatenate([tile.ids for _, tile in self.tiles])
        names, number = np.unique(ids, return_inverse=True)
        starts = np.cumsum([0, *(len(tile.ids) for _, tile in self.tiles)])
        found = [tile.settle() for _, tile in self.tiles]
        row = np.concatenate([number[start + r] for start, (r, _, _) in zip(starts, found)])
        row, distance, near, rank = _first_k(row, *(np.concatenate([f[i] for f in found]) for i in (1, 2)), self.k)
        return names[row], near, distance, rank


def search_groups(
    dealt: DataFrame, parts: int, k: int, metric: str, split: Sequence[str], row_id: str, vector: str, block_rows: int
) -> DataFrame:
    """The k nearest rows, in each ``_group``, of every query row in it: split, row_id, neighbor, distance, rank.

    ``_role`` tells what a row is in its group: ``QUERY``, ``BOTH``, or ``OTHER`` to be
    compared with the queries only. A group goes to one task, queries first; the task
    holds those, their lists and ``block_rows`` other rows at a time, so what a group
    is compared with may be of any size, and only the final lists leave the task.
    With columns ``_cell`` and ``_meets`` a row is compared only with queries in the
    cells it meets.
    """
    schema = T.StructType([*edge_schema(dealt, split, row_id).fields, T.StructField("rank", T.IntegerType())])
    arrow, celled = to_arrow_schema(schema), "_cell" in dealt.columns

    def finished(keys: list, group: _Group) -> pa.RecordBatch:
        row, near, distance, rank = group.lists()
        columns = [pa.array([key] * len(row), field.type) for key, field in zip(keys, arrow)]
        columns += [pa.array(v, field.type) for v, field in zip((row, near, distance, rank), list(arrow)[len(keys) :])]
        return pa.RecordBatch.from_arrays(columns, schema=arrow)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, keys, group = None, [], None
        for batch in batches:
            places, roles = batch["_group"].to_numpy(), batch["_role"].to_numpy()
            cuts = [0, *(np.flatnonzero((np.diff(places) != 0) | (np.diff(roles) != 0)) + 1), len(places)]
            for lo, hi in zip(cuts, cuts[1:]):
                if hi == lo:
                    continue
                if places[lo] != number:
                    if group:
                        yield finished(keys, group)
                    number, group = places[lo], _Group(k, metric, block_rows)
                    keys = [batch[c][lo].as_py() for c in split]
                part = batch.slice(lo, hi - lo)
                x = stack_vectors(part[vector])
                if metric == "cosine":
                    x = unit_rows(x)
                ids = part[row_id].to_numpy(zero_copy_only=False)
                cells = (part["_cell"].to_numpy(), part["_meets"].to_pylist()) if celled else (None, None)
                group.add(int(roles[lo]), (ids, x, *cells))
        if group:
            yield finished(keys, group)

    placed = dealt.repartitionById(parts, F.pmod(F.col("_group"), F.lit(parts)).cast("int"))
    return placed.sortWithinPartitions("_group", "_role").mapInArrow(search, schema)


def group_counts(df: DataFrame, split: Sequence[str], vector: str, block_rows: int) -> DataFrame:
    """split, rows, groups: into how many groups of queries the rows of each split are dealt."""
    sizes = df.groupBy(*split).agg(F.count(F.lit(1)).alias("rows"), F.max(F.size(vector)).alias("_width"))
    most = F.least(F.lit(GROUP_ROWS), F.ceil(F.lit(GROUP_VALUES) / F.greatest("_width", F.lit(1))))
    few = F.least(F.ceil(F.col("rows") / min(FEWEST_ROWS, block_rows)), F.lit(GROUPS))
    return sizes.select(*split, "rows", F.greatest(few, F.ceil(F.col("rows") / most)).cast("long").alias("groups"))


def numbered_groups(counts: DataFrame, order: Sequence[str], groups: str = "groups") -> tuple[DataFrame, int]:
    """``counts`` with ``_first``, the number of the first group of each row, and the tasks that all groups make.

    Numbered in one task: there is one row per split or cell, not per vector.
    """
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    numbered = cut_lineage(counts.withColumn("_first", F.coalesce(F.sum(groups).over(before), F.lit(0)).cast("long")))
    total = numbered.agg(F.sum(groups)).first()[0] or 1
    return numbered, int(min(total, MOST_TASKS))


def knn_exact(
    df: DataFrame,
    k: int,
    metric: str = "cosine",
    split: Sequence[str] = SPLIT,
    row_id: str = "row_id",
    vector: str = "embeddings",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Exact graph by products of groups of queries with all rows.

    Every split is cut by id hash into ``GROUPS`` groups of queries, more where a
    group would pass ``GROUP_ROWS`` rows or ``GROUP_VALUES`` numbers. All rows of the
    split stream past each group, ``block_rows`` at a time, so vectors are copied
    once for each group and only final lists leave a task; the cost is quadratic in
    the rows of a split.
    """
    split = list(split)
    groups, parts = numbered_groups(group_counts(df, split, vector, block_rows), split)
    own = join_keys(df.select(*split, row_id, vector), broadcast_if_small(groups.drop("rows")), split)
    own = own.withColumn("_own", F.col("_first") + F.pmod(F.xxhash64(row_id), F.col("groups")))
    sent = own.withColumn("_group", F.explode(F.sequence(F.col("_first"), F.col("_first") + F.col("groups") - 1)))
    role = F.when(F.col("_own") == F.col("_group"), BOTH).otherwise(OTHER)
    dealt = sent.select(*split, row_id, vector, "_group", role.alias("_role"))
    return search_groups(dealt, parts, k, metric, split, row_id, vector, block_rows)


def cell_centers(sample: np.ndarray, cells: int, rounds: int = 5) -> np.ndarray:
    """Lloyd's rounds from the first ``cells`` rows of a sample; a cell that empties keeps its centre."""
    centers = sample[:cells].copy()
    for _ in range(rounds):
        own = np.concatenate(
            [squared_distances(sample[i : i + BLOCK_ROWS], centers).argmin(1) for i in range(0, len(sample), BLOCK_ROWS)]
        )
        sums = np.zeros_like(centers)
        np.add.at(sums, own, sample)
        counts = np.bincount(own, minlength=len(centers))[:, None]
        centers = np.where(counts > 0, sums / np.maximum(counts, 1), centers)
    return centers


def with_probes(
    df: DataFrame, centers: np.ndarray, probes: int, metric: str, vector: str = "embeddings",
    living: np.ndarray | None = None, rows: int = 0,
) -> DataFrame:
    """Add ``_cells``: the ``probes`` nearest centres of every row, nearest first.

    With ``living``, the rows of each cell, further centres follow until the
    cells hold ``rows`` rows.
    """
    shared = df.sparkSession.sparkContext.broadcast((centers, living))

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def assign(column: pd.Series) -> pd.Series:
        centers, living = shared.value
        x = np.stack(column.to_numpy()).astype(np.float64)
        found = []
        for start in range(0, len(x), BLOCK_ROWS):
            part = x[start : start + BLOCK_ROWS]
            order = squared_distances(unit_rows(part) if metric == "cosine" else part, centers).argsort(1, kind="stable")
            need = np.full(len(part), probes)
            if living is not None:
                need = np.maximum(need, (living[order].cumsum(1) < rows).sum(1) + 1)
            found += [row[:n].astype(np.int32) for row, n in zip(order, need)]
        return pd.Series(found)

    return df.withColumn("_cells", assign(vector))


def knn_ivf(
    df: DataFrame,
    k: int,
    metric: str = "cosine",
    split: Sequence[str] = SPLIT,
    row_id: str = "row_id",
    vector: str = "embeddings",
    cells: int | None = None,
    probes: int = PROBES,
    block_rows: int = BLOCK_ROWS,
    seed: int = SEED,
) -> DataFrame:
    """Approximate graph of one split: exact ranking inside the nearest cells.

    A row lives in its nearest cell and searches the ``probes`` nearest ones, or as
    many more as it takes to see ``k`` other rows, so every list is complete.
    The queries of a cell are cut into groups of bounded size past which its rows
    stream, so a cell that holds a third of the split is many bounded tasks and
    loses nothing. With as many probes as cells the graph is exact.

    Centres come from a sample of ``SAMPLE_VALUES`` numbers at most (but a row for
    each cell), chosen by a hash of the id, so the graph is the same under any
    partitioning. Their number is ``cells``, by default the root of the rows and
    ``MAX_CELLS`` at most, which bounds what every task is sent.
    """
    split = list(split)
    n = df.count()
    cells = cells or max(1, min(MAX_CELLS, int(np.ceil(np.sqrt(n)))))
    width = df.select(F.max(F.size(vector))).first()[0] or 1
    group_rows = max(1, min(CELL_GROUP_ROWS, GROUP_VALUES // max(1, width)))
    by_hash = df.select(vector).orderBy(F.xxhash64(F.lit(seed), row_id), row_id)
    some = by_hash.limit(max(cells, min(50 * cells, SAMPLE_VALUES // width))).toArrow()
    sample = stack_vectors(some[vector])
    centers = cell_centers(unit_rows(sample) if metric == "cosine" else sample, min(cells, len(sample)))
    own = cut_lineage(with_probes(df.select(*split, row_id, vector), centers, 1, metric).withColumn("_home", F.col("_cells")[0]))
    homes = {r["_home"]: r["count"] for r in own.groupBy("_home").count().collect()}  # a row per cell
    living = np.array([homes.get(c, 0) for c in range(len(centers))])
    reached = with_probes(own.drop("_cells"), centers, probes, metric, vector, living, min(k + 1, n))
    placed = cut_lineage(reached.drop("_home"))
    searching = placed.withColumn("_cell", F.explode("_cells"))
    asked = searching.groupBy("_cell").agg(F.ceil(F.count(F.lit(1)) / group_rows).cast("long").alias("groups"))
    groups, parts = numbered_groups(asked, ["_cell"])
    dealt = searching.join(F.broadcast(groups), "_cell")  # at most MAX_CELLS rows
    dealt = dealt.withColumn("_own", F.col("_first") + F.pmod(F.xxhash64(row_id), F.col("groups")))
    lives = F.col("_cells")[0] == F.col("_cell")
    everywhere = F.sequence(F.col("_first"), F.col("_first") + F.col("groups") - 1)
    sent = dealt.withColumn("_group", F.explode(F.when(lives, everywhere).otherwise(F.array("_own"))))
    role = F.when(F.col("_own") != F.col("_group"), OTHER).otherwise(F.when(lives, BOTH).otherwise(QUERY))
    rows = sent.select(*split, row_id, vector, "_group", role.alias("_role"))
    partial = search_groups(rows, parts, k, metric, split, row_id, vector, block_rows).drop("rank")
    return closest(partial, k, split, row_id)


def knn_over_copies(
    df: DataFrame,
    k: int,
    graph: Callable[[DataFrame], DataFrame],
    split: Sequence[str] = SPLIT,
    row_id: str = "row_id",
    vector: str = "embeddings",
) -> DataFrame:
    """Build the graph over distinct vectors and give every copy its neighbours.

    Of each set of copies only the smallest id enters ``graph``, and only its
    first k + 1 ids can appear as neighbours, so a set that holds a third of all
    rows costs one vector. The result equals the graph over all rows.
    """
    split = list(split)
    marks = ["_h1", "_h2"]
    keyed = df.withColumn("_h1", F.xxhash64(vector)).withColumn("_h2", F.xxhash64(F.lit(1), vector))
    by_copy = Window.partitionBy(*split, *marks).orderBy(row_id)
    heads = keyed.withColumn("_nth", F.row_number().over(by_copy)).filter(F.col("_nth") <= k + 1)
    heads = cut_lineage(heads)
    first = heads.filter("_nth = 1")
    rep = first.select(*split, *marks, F.col(row_id).alias("_rep"))
    members = join_keys(heads.select(*split, *marks, F.col(row_id).alias("_member")), rep, [*split, *marks]).drop(*marks)
    edges = cut_lineage(graph(first.select(*split, row_id, vector)).drop("rank"))
    others = join_keys(edges.withColumnsRenamed({row_id: "_from", "neighbor": "_rep"}), members, [*split, "_rep"])
    own = members.select(*split, F.col("_rep").alias("_from"), "_member", F.lit(0.0).alias("distance"))
    reachable = others.select(*split, "_from", "_member", "distance").unionByName(own)
    best = Window.partitionBy(*split, "_from").orderBy("distance", "_member")
    nearby = reachable.withColumn("_nth", F.row_number().over(best)).filter(F.col("_nth") <= k + 1).drop("_nth")
    rows = join_keys(keyed.select(*split, row_id, *marks), rep, [*split, *marks]).drop(*marks)
    pairs = join_keys(rows.withColumnRenamed("_rep", "_from"), nearby, [*split, "_from"]).filter(F.col("_member") != F.col(row_id))
    named = pairs.select(*split, row_id, F.col("_member").alias("neighbor"), "distance")
    return closest(named, k, split, row_id)


def has_copies(df: DataFrame, split: Sequence[str] = SPLIT, vector: str = "embeddings") -> bool:
    marked = df.select(*split, F.xxhash64(vector).alias("_h1"), F.xxhash64(F.lit(1), vector).alias("_h2"))
    return not marked.groupBy(*split, "_h1", "_h2").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").isEmpty()


def knn(
    df: DataFrame,
    k: int,
    metric: str = "cosine",
    method: str = "exact",
    split: Sequence[str] = SPLIT,
    row_id: str = "row_id",
    vector: str = "embeddings",
) -> DataFrame:
    """The k nearest rows of every row inside its split, itself excluded.

    Columns: split, row_id, neighbor, distance, rank; ties go to the smaller id.
    ``exact`` compares all block pairs, at any size; ``pruned`` gives the same and
    leaves out the pairs of cells that bounds rule out; ``ivf`` searches the nearest
    cells and may miss neighbours, but never returns short lists. Copies of a
    vector are handled once.
    """
    if metric not in ("cosine", "euclidean"):
        raise ValueError(f"unknown metric {metric!r}")
    if method not in ("exact", "pruned", "ivf"):
        raise ValueError(f"unknown method {method!r}")

    def graph(distinct: DataFrame) -> DataFrame:
        if method == "exact":
            return knn_exact(distinct, k, metric, split, row_id, vector)
        if method == "pruned":
            from corpusloom.operators.pruned import knn_pruned

            return knn_pruned(distinct, k, metric, split, row_id, vector).edges
        parts = []
        for row in distinct.select(*split).distinct().collect():  # one row per split; each is a search of its own
            mine = distinct
            for c in split:
                mine = mine.filter(F.col(c).eqNullSafe(F.lit(row[c])))
            parts.append(knn_ivf(mine, k, metric, split, row_id, vector))
        if not parts:
            return knn_exact(distinct, k, metric, split, row_id, vector)
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out

    if has_copies(df, split, vector):
        return knn_over_copies(df, k, graph, split, row_id, vector)
    return graph(df)
