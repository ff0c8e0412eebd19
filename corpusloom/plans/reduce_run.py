"""Reduce step: all four layouts of every split, assembled, written and recorded."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from corpusloom.operators import sampling as SM
from corpusloom.operators.affinities import fuzzy_union, tsne_affinities, tsne_symmetrise, umap_memberships
from corpusloom.operators.neighbors import knn
from corpusloom.operators.pca import pca_init
from corpusloom.operators.sampling import SPLIT
from corpusloom.operators.layout import restore_keys, run_lanes
from corpusloom.operators.tsne import ITERATIONS, no_layout, spatial_graph, tsne_lane
from corpusloom.operators.umap import EPOCHS, sampling_graph, umap_lane
from corpusloom.session import broadcast_if_small, cut_lineage, join_keys, scratch_tables
from corpusloom.sources.catalog import pending
from corpusloom.sources.shards import count_shards, plain_path
from corpusloom.sources.splits import NO_FIELDS, UNKNOWN
from corpusloom.sources.sinks import write_csv, write_json, write_parquet

# Column names and order of the reduced table.
LABEL_COLUMNS = [
    "dataset_key",
    "dataset_name",
    "sub_label",
    "category",
    "text_strategy_template",
    "text_strategy_fields",
]
COORDINATE_COLUMNS = [
    "tsne_2d_x",
    "tsne_2d_y",
    "umap_2d_x",
    "umap_2d_y",
    "tsne_3d_x",
    "tsne_3d_y",
    "tsne_3d_z",
    "umap_3d_x",
    "umap_3d_y",
    "umap_3d_z",
]
BACKEND = "spark"

RECORD_SCHEMA = (
    "dataset_key string, sub_label string, num_rows long, total_available long, "
    "reduction_backend string, columns_2d_3d array<string>"
)


@dataclass(frozen=True)
class ReduceSettings:
    cap: int = SM.MAX_POINTS
    perplexity: int = SM.PERPLEXITY
    neighbors: int = SM.NEIGHBORS
    min_dist: float = SM.MIN_DIST
    seed: int = SM.SEED
    tsne_3d: bool = True
    iterations: int = ITERATIONS
    epochs: int = EPOCHS
    method: str = "exact"


def select_points(vectors: DataFrame, key: str, settings: ReduceSettings) -> DataFrame:
    """Sampled, numbered vectors of the splits that are large enough.

    Keeps the source key beside ``row_id``, which counts the sampled order.
    """
    sampled = SM.sample_split(SM.to_vectors(vectors.select(*SPLIT, key, "embeddings")), key, settings.cap, settings.seed)
    numbered = SM.with_row_id(sampled, SPLIT, ["sample_order", key]).drop("sample_order")
    enough = SM.eligible(SM.count_splits(numbered)).select(*SPLIT)
    return join_keys(numbered, broadcast_if_small(enough), SPLIT, "left_semi")


def layouts(
    points: DataFrame, settings: ReduceSettings, failures: list[DataFrame] | None = None
) -> dict[str, DataFrame]:
    """The four layouts by name. Each metric's graph is built once for 2D and 3D.

    A split that fails in a layout has no rows there; see ``run_lanes`` for ``failures``.
    """
    params = cut_lineage(
        SM.reduction_params(SM.count_splits(points), perplexity=settings.perplexity, neighbors=settings.neighbors)
    )
    init = cut_lineage(pca_init(points, 3))
    tsne_k = max(SM.MIN_TSNE_NEIGHBORS, 3 * settings.perplexity)
    near = cut_lineage(knn(points, tsne_k, "euclidean", method=settings.method))
    p = tsne_affinities(near, F.col("perplexity"), params=params.select(*SPLIT, "perplexity"))
    joint = cut_lineage(tsne_symmetrise(p, params))
    fuzzy = cut_lineage(
        fuzzy_union(umap_memberships(knn(points, settings.neighbors, "cosine", method=settings.method)))
    )
    by_p, by_w = spatial_graph(init, joint, 2), sampling_graph(init, fuzzy)

    # Tasks start in this order: the longest come first, so that none is left over at a round's end.
    lanes = {"tsne_3d": tsne_lane(joint, init, 3, settings.iterations, graph=by_p)} if settings.tsne_3d else {}
    lanes |= {
        "tsne_2d": tsne_lane(joint, init, 2, settings.iterations, graph=by_p),
        "umap_3d": umap_lane(fuzzy, init, 3, settings.epochs, settings.min_dist, settings.seed, graph=by_w),
        "umap_2d": umap_lane(fuzzy, init, 2, settings.epochs, settings.min_dist, settings.seed, graph=by_w),
    }
    # One loop runs all four, a round of each at a time.
    done = dict(zip(lanes, run_lanes(lanes.values(), failures)))
    out = {name: restore_keys(done[name], lane.graph, SPLIT, 3 if name.endswith("3d") else 2) for name, lane in lanes.items()}
    return out if settings.tsne_3d else out | {"tsne_3d": no_layout(points.select(*SPLIT, "row_id"), 3)}


def assemble(points: DataFrame, labels: DataFrame, coords: dict[str, DataFrame], extra: Sequence[str] = ()) -> DataFrame:
    """Labels, row_id and the ten coordinates in their fixed order, then ``extra`` keys.

    A split without a label row keeps its rows and gets the labels' defaults. A
    split with several label rows would repeat its rows, so that is an error.
    """
    twice = labels.groupBy(*SPLIT).count().filter("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"more than one label row for {twice[0].asDict()}")
    out = join_keys(points.select(*SPLIT, "row_id", *extra), labels.select(*LABEL_COLUMNS), SPLIT, "left")
    defaults = {"category": UNKNOWN, "text_strategy_template": UNKNOWN, "text_strategy_fields": NO_FIELDS}
    out = out.withColumns({c: F.coalesce(c, F.lit(v)) for c, v in defaults.items()})
    out = out.withColumn("dataset_name", F.coalesce("dataset_name", "dataset_key"))
    for name, table in coords.items():
        renamed = table.withColumnsRenamed({c: f"{name}_{c}" for c in ("x", "y", "z") if c in table.columns})
        out = join_keys(out, renamed, [*SPLIT, "row_id"])
    return out.select(*LABEL_COLUMNS, "row_id", *COORDINATE_COLUMNS, *extra)


def reduce(
    vectors: DataFrame,
    labels: DataFrame,
    key: str,
    settings: ReduceSettings = ReduceSettings(),
    failures: list[DataFrame] | None = None,
) -> DataFrame:
    """The reduced table of all splits of ``vectors`` (split columns, key, embeddings).

    A split that fails in a layout is left out if ``failures`` is a list, which then
    gets tables (split columns, error); else the failure is raised.
    """
    points = select_points(vectors, key, settings)
    return assemble(points, labels, layouts(points, settings, failures), extra=[key])


def read_vectors(spark: SparkSession, split_files: DataFrame, root: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """Vectors of the listed shards (``discover_splits``) below ``root``, and the splits that can't be read.

    A split one of whose shards gives no row, being corrupt or empty, is set aside as
    (split columns, error); the others' rows get its columns.
    """
    counted = count_shards(spark, split_files, root, schema, on_corrupt="zero")
    named = counted.groupBy(*SPLIT).agg(F.min("rows").alias("_least"), F.min_by("file_name", "rows").alias("_shard"))
    unread = cut_lineage(
        named.where("_least = 0").select(*SPLIT, F.concat(F.lit("a shard can't be read or is empty: "), "_shard").alias("error"))
    )
    scan = (
        spark.read.schema(schema).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
        .option("ignoreCorruptFiles", "true").parquet(root)
    )
    columns = scan.columns
    rows = scan.withColumn("path", plain_path(F.col("_metadata.file_path")))
    listed = counted.where("rows > 0").select("path", *SPLIT)
    kept = join_keys(listed, broadcast_if_small(unread.select(*SPLIT)), SPLIT, "left_anti")
    return rows.join(kept, "path").select(*SPLIT, *columns), unread


def reduction_record(reduced: DataFrame, available: DataFrame) -> DataFrame:
    """One record per reduced split; ``available`` has the rows before sampling."""
    counts = reduced.groupBy(*SPLIT).agg(F.count(F.lit(1)).alias("num_rows"))
    return join_keys(counts, available.select(*SPLIT, F.col("rows").alias("total_available")), SPLIT).select(
        *SPLIT,
        "num_rows",
        "total_available",
        F.lit(BACKEND).alias("reduction_backend"),
        F.array(*[F.lit(c) for c in COORDINATE_COLUMNS]).alias("columns_2d_3d"),
    )


def pending_splits(splits: DataFrame, done: DataFrame) -> DataFrame:
    """Splits without a finished record."""
    return pending(splits, done, on=SPLIT)


def read_records(spark: SparkSession, path: str, schema: str = RECORD_SCHEMA) -> DataFrame:
    """Finished records; none if the folder does not exist yet."""
    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)


def run_reduce(
    vectors: DataFrame,
    labels: DataFrame,
    key: str,
    out: str,
    settings: ReduceSettings = ReduceSettings(),
    csv: bool = True,
    unread: DataFrame | None = None,
) -> DataFrame:
    """Reduce every split that has no record below ``out`` yet.

    A split whose vectors are ragged, null or not finite, or whose layout fails, is
    reported as failed and left out; the others go through one job. ``unread`` are
    splits (split columns, error) that gave no vectors, to be reported beside them. Rows are written per split with dynamic
    overwrite below folders ``split_key=…/split_label=…``, which repeat the split's
    name, so the files hold every column in its order and type. The record — which
    marks a split as done — comes last, so an interrupted run is simply repeated.
    Returns (split, done, error, ok), a row for each split; ``done`` are those with
    a written record. Intermediate tables are deleted at the end, also of a failed run.
    """
    spark = vectors.sparkSession
    with scratch_tables(spark):
        report = _reduce_pending(spark, vectors, labels, key, out, settings, csv)
        if unread is not None:
            report = report.unionByName(unread.selectExpr(*SPLIT, "false AS done", "error", "false AS ok"))
        return spark.createDataFrame(report.collect(), report.schema)


def _reduce_pending(
    spark: SparkSession, vectors: DataFrame, labels: DataFrame, key: str, out: str, settings: ReduceSettings, csv: bool
) -> DataFrame:
    checked = cut_lineage(SM.check_vectors(SM.to_vectors(vectors)))
    todo = cut_lineage(pending_splits(checked, read_records(spark, f"{out}/records")))
    good = SM.eligible(todo.filter("ok"))
    fine = F.coalesce(F.col("ok"), F.lit(False))
    failures: list[DataFrame] = []

    def report() -> DataFrame:
        told = todo.select(*SPLIT, F.lit(None).cast("string").alias("_error")).limit(0)
        for table in failures:
            told = told.unionByName(table.select(*SPLIT, F.col("error").alias("_error")))
        told = told.groupBy(*SPLIT).agg(F.min("_error").alias("_error"))
        finished = read_records(spark, f"{out}/records").select(*SPLIT, F.lit(True).alias("_done")).distinct()
        return join_keys(join_keys(todo, finished, SPLIT, "left"), told, SPLIT, "left").select(
            *SPLIT,
            F.coalesce("_done", F.lit(False)).alias("done"),
            F.when(~fine, "vectors are ragged, empty, null or not finite")
            .when(F.col("rows") < SM.MIN_ROWS, "too few rows")
            .when(F.col("_done").isNull(), F.coalesce("_error", F.lit("no rows were written")))
            .alias("error"),
            fine.alias("ok"),
        )

    if good.isEmpty():
        return report()
    chosen = join_keys(vectors, broadcast_if_small(good.select(*SPLIT)), SPLIT, "left_semi")
    reduced = cut_lineage(reduce(chosen, labels, key, settings, failures))
    by_split = ["split_key", "split_label"]
    spread = reduced.repartitionByRange(*SPLIT, "row_id").withColumns(dict(zip(by_split, map(F.col, SPLIT))))
    write_parquet(spread, f"{out}/reduced", partition_by=by_split, mode="overwrite")
    write_csv(spread, f"{out}/reduced_csv", enabled=csv, partition_by=by_split, mode="overwrite")
    write_json(reduction_record(reduced, good), f"{out}/records", mode="append")
    return report()
