"""The dataset catalog: configured keys, keys on disk, status, selection."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import paths as P
from corpusloom.session import join_keys

# Status words and the exported column order.
READY = "ready"
DISK_ONLY_READY = "disk_only_ready"
MISSING = "missing_preprocessed"
EXPORT_COLUMNS = ["key", "in_config", "status", "rows", "shards", "hf_name", "preprocessed", "embeddings_out"]

NO_DIRECTORY = "no dataset directory"
NO_PREPROCESSED = "no preprocessed shards"
NOT_SELECTABLE = "not selectable"


def dataset_inventory(shard_rows: DataFrame, key: Column) -> DataFrame:
    """Rows and shards per dataset from a shard inventory (path, rows)."""
    return shard_rows.groupBy(key.alias("key")).agg(
        F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("shards")
    )


def catalog(
    reg: DataFrame,
    on_disk: DataFrame,
    root: str,
    central_override: str | None = None,
    central: str | None = None,
) -> DataFrame:
    """Configured keys ∪ keys on disk with status, sizes and folders.

    ``on_disk`` has key, rows, shards; a directory without shards is a row with
    zero or null counts. The result is unsorted; ``sorted_catalog`` orders it.
    """
    configured = reg.select("key", "hf_name", F.lit(True).alias("_configured"))
    disk = on_disk.filter(~P.is_hidden(F.col("key"))).select("key", "rows", "shards", F.lit(True).alias("_disk"))
    both = configured.join(disk, "key", "full_outer")
    shards = F.coalesce("shards", F.lit(0)).cast("long")
    in_config = F.coalesce("_configured", F.lit(False))
    status = (
        F.when((shards > 0) & in_config, READY).when(shards > 0, DISK_ONLY_READY).otherwise(MISSING)
    )
    return both.select(
        "key",
        in_config.alias("in_config"),
        status.alias("status"),
        F.coalesce("rows", F.lit(0)).cast("long").alias("rows"),
        shards.alias("shards"),
        F.coalesce("hf_name", F.lit("")).alias("hf_name"),
        P.preprocessed_path(root, F.col("key")).alias("preprocessed"),
        P.embedding_path(root, F.col("key"), central_override, central).alias("embeddings_out"),
        F.coalesce("_disk", F.lit(False)).alias("on_disk"),
    )


def sorted_catalog(cat: DataFrame) -> DataFrame:
    return cat.orderBy("key")


def parse_key_lines(lines: Iterable[str]) -> list[str]:
    """Dataset keys from text lines; blank lines and ``#`` comments are ignored."""
    stripped = (line.strip() for line in lines)
    return sorted({line for line in stripped if line and not line.startswith("#")})


def read_key_list(spark: SparkSession, path: str) -> DataFrame:
    """A key file as a one-column DataFrame, same rule as ``parse_key_lines``."""
    from corpusloom.functions.text import strip_text

    key = strip_text(F.col("value"))
    return (
        spark.read.text(path)
        .select(key.alias("key"))
        .filter((F.col("key") != "") & ~F.startswith("key", F.lit("#")))
        .distinct()
    )


def select_datasets(
    cat: DataFrame,
    exact: list[str] | DataFrame | None = None,
    prefix: str | None = None,
    contains: list[str] | None = None,
) -> DataFrame:
    """Filter by exact keys, by ``p`` or ``p/…``, or by case-insensitive substring.

    Exact and prefix exclude each other; an empty exact list means no filter.
    """
    if prefix and (isinstance(exact, DataFrame) or exact):
        raise ValueError("use either exact keys or a prefix, not both")
    key = F.col("key")
    if isinstance(exact, DataFrame):
        cat = cat.join(exact.select("key").distinct(), "key", "left_semi")
    elif exact:
        cat = cat.filter(key.isin(exact))
    if prefix is not None:
        cat = cat.filter((key == prefix) | F.startswith(key, F.lit(prefix + "/")))
    if contains:
        needles = F.array(*[F.lit(c.lower()) for c in contains])
        cat = cat.filter(F.exists(needles, lambda x: F.contains(F.lower(key), x)))
    return cat


def candidates(cat: DataFrame) -> DataFrame:
    """Catalog rows that have shards to embed."""
    return cat.filter(F.col("shards") > 0)


def missing_keys(cat: DataFrame, wanted: DataFrame, available: DataFrame | None = None) -> DataFrame:
    """Requested keys that cannot be embedded, with the reason."""
    available = candidates(cat) if available is None else available
    absent = wanted.select("key").distinct().join(available.select("key"), "key", "left_anti")
    known = cat.select("key", "on_disk", "shards")
    reason = (
        F.when(~F.coalesce("on_disk", F.lit(False)), NO_DIRECTORY)
        .when(F.coalesce("shards", F.lit(0)) == 0, NO_PREPROCESSED)
        .otherwise(NOT_SELECTABLE)
    )
    return absent.join(known, "key", "left").select("key", reason.alias("reason"))


def select_wanted(cat: DataFrame, wanted: DataFrame) -> DataFrame:
    """The wanted candidates — or none at all if any wanted key is missing."""
    chosen = candidates(cat)
    if not missing_keys(cat, wanted).isEmpty():
        return chosen.limit(0)
    return select_datasets(chosen, exact=wanted)


def catalog_summary(cat: DataFrame) -> DataFrame:
    """Total names, names ready to embed, names without preprocessed shards."""
    return cat.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("status").isin(READY, DISK_ONLY_READY)).alias("embed_ready"),
        F.count_if(F.col("status") == MISSING).alias("missing"),
    )


def estimate(cat: DataFrame, dim: int) -> DataFrame:
    """Dry run of the embed step: rows and the float32 volume in GB."""
    total = F.coalesce(F.sum("rows"), F.lit(0)).cast("long")
    return cat.agg(total.alias("total_rows")).withColumn(
        "estimated_gb", F.col("total_rows") * F.lit(dim) * F.lit(4) / F.lit(1e9)
    )


def pending(cat: DataFrame, done: DataFrame, on: tuple[str, ...] = ("key",)) -> DataFrame:
    """Rows whose key has no finished output yet."""
    return join_keys(cat, done.select(*on).distinct(), on, "left_anti")
