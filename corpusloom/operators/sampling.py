"""Planning, sampling and numbering of embedding splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.ordering import digest_bucket, sample_digest
from corpusloom.session import broadcast_if_small, cut_lineage, join_keys

SPLIT = ("dataset_key", "sub_label")

# Defaults of the reduce step.
MAX_POINTS = 0
PERPLEXITY = 30
NEIGHBORS = 15
MIN_DIST = 0.1
SEED = 42
MIN_ROWS = 5
MIN_TSNE_NEIGHBORS = 90


def count_splits(df: DataFrame, split: Sequence[str] = SPLIT) -> DataFrame:
    return df.groupBy(*split).agg(F.count(F.lit(1)).alias("rows"))


def plan_reduction(counts: DataFrame, cap: int = MAX_POINTS) -> DataFrame:
    """Rows each split will contribute: ``min(rows, cap)``, cap 0 = all."""
    planned = F.least(F.col("rows"), F.lit(cap).cast("long")) if cap > 0 else F.col("rows")
    return counts.withColumn("planned_rows", planned)


def eligible(counts: DataFrame, rows: str = "rows") -> DataFrame:
    """Splits with enough rows to be laid out."""
    return counts.filter(F.col(rows) >= MIN_ROWS)


def reduction_params(
    counts: DataFrame, rows: str = "rows", perplexity: int = PERPLEXITY, neighbors: int = NEIGHBORS
) -> DataFrame:
    """Clamp perplexity and neighbour counts to what a split's size allows."""
    n = F.col(rows)
    perp = F.least(F.lit(perplexity), F.floor(F.greatest(F.lit(1), n - 1) / 3)).cast("long")
    wanted = F.greatest(F.lit(MIN_TSNE_NEIGHBORS), F.ceil(F.lit(3) * F.col("perplexity")))
    return (
        counts.withColumn("perplexity", perp)
        .withColumn("tsne_neighbors", F.least(n - 1, wanted).cast("long"))
        .withColumn(
            "umap_neighbors",
            F.when(n > 1, F.least(F.lit(neighbors), n - 1)).otherwise(F.lit(2)).cast("long"),
        )
    )


def sample_split(
    df: DataFrame, key: str, cap: int, seed: int = SEED, split: Sequence[str] = SPLIT
) -> DataFrame:
    """Exactly ``min(rows, cap)`` rows of every split, without replacement.

    Rows are ordered by a seeded digest of their key. Instead of ranking a
    whole split in one task, the digest's leading digits cut it into uniform
    buckets: a histogram finds the bucket the cap falls in, everything before
    it is kept, and only that one bucket is ranked. Adds ``sample_order``:
    the digest for sampled splits, empty where all rows are kept.
    """
    split = list(split)
    if cap <= 0:
        return df.withColumn("sample_order", F.lit(""))
    digest = df.withColumn("_digest", sample_digest(F.col(key), seed))
    bucketed = digest.withColumn("_bucket", digest_bucket(F.col("_digest")))
    histogram = bucketed.groupBy(*split, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy(*split).orderBy("_bucket")
    running = histogram.withColumn("_total", F.sum("_n").over(Window.partitionBy(*split))).withColumn(
        "_before", F.sum("_n").over(upto) - F.col("_n")
    )
    edge = running.filter((F.col("_before") <= cap - 1) & (F.col("_before") + F.col("_n") >= F.least(F.lit(cap), "_total")))
    edge = edge.select(
        *split,
        F.col("_bucket").alias("_edge"),
        (F.lit(cap) - F.col("_before")).alias("_need"),
        (F.col("_total") > cap).alias("_cut"),
    )
    marked = join_keys(bucketed, broadcast_if_small(cut_lineage(edge)), split)
    rank = F.row_number().over(Window.partitionBy(*split, "_bucket").orderBy("_digest", key))
    inner = marked.filter(~F.col("_cut") | (F.col("_bucket") < F.col("_edge")))
    border = (
        marked.filter(F.col("_cut") & (F.col("_bucket") == F.col("_edge")))
        .withColumn("_rank", rank)
        .filter(F.col("_rank") <= F.col("_need"))
        .drop("_rank")
    )
    kept = inner.unionByName(border)
    return kept.withColumn("sample_order", F.when(F.col("_cut"), F.col("_digest")).otherwise(F.lit(""))).drop(
        "_digest", "_bucket", "_edge", "_need", "_cut"
    )


def with_row_id(df: DataFrame, split: Sequence[str], order: Sequence[str], name: str = "row_id") -> DataFrame:
    """Dense 0..n-1 numbers per split in ``order``, without a single-task sort.

    Rows are range-partitioned by (split, order), so a split of any size spreads
    over many sorted partitions. Each partition numbers its own rows; one count
    per (split, partition) gives the offsets. The numbered rows are written to
    the checkpoint folder first, since the numbers must not change between the
    counting and the joining pass.
    """
    split = list(split)
    keys = [*split, *order]
    numbered = cut_lineage(
        df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_mid", F.monotonically_increasing_id())
    ).withColumn("_part", F.shiftright("_mid", 33))
    runs = numbered.groupBy(*split, "_part").agg(F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*split).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = runs.withColumn("_offset", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
    joined = join_keys(numbered, broadcast_if_small(offsets), [*split, "_part"])
    row_id = F.col("_mid") - F.col("_first") + F.col("_offset")
    return joined.withColumn(name, row_id).drop("_mid", "_part", "_first", "_offset")


def to_vectors(df: DataFrame, column: str = "embeddings") -> DataFrame:
    """Cast to float32 lists."""
    return df.withColumn(column, F.col(column).cast("array<float>"))


def check_vectors(df: DataFrame, column: str = "embeddings", split: Sequence[str] = SPLIT) -> DataFrame:
    """Vector lengths per split; ``ok`` is false for ragged, empty or null vectors and for such with a number that isn't finite."""
    size = F.size(column)
    far = float("inf")
    bad = F.col(column).isNull() | F.exists(column, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == far))
    return (
        df.groupBy(*split)
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.min(size).alias("min_dim"),
            F.max(size).alias("max_dim"),
            F.count_if(bad).alias("bad_vectors"),
        )
        .withColumn(
            "ok",
            (F.col("min_dim") == F.col("max_dim")) & (F.col("min_dim") > 0) & (F.col("bad_vectors") == 0),
        )
    )


def require_vectors(checked: DataFrame) -> None:
    """Raise if any split failed ``check_vectors``; names a few of them."""
    bad = checked.filter(~F.coalesce("ok", F.lit(False))).limit(5).collect()
    if bad:
        raise ValueError(f"vectors of one split must share one length: {[r.asDict() for r in bad]}")
