"""Parquet shard folders: listing, row inventory, column-pruned scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions import paths as P


def scan_shards(
    spark: SparkSession,
    path: str | list[str],
    columns: Sequence[str],
    schema: T.StructType | str | None = None,
    recursive: bool = False,
) -> DataFrame:
    """Read only ``columns`` of the shards; the pruning reaches the Parquet reader."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.parquet(*([path] if isinstance(path, str) else path)).select(*columns)


def with_source_shard(df: DataFrame) -> DataFrame:
    """Add ``source_shard``, the name of the file each row came from."""
    return df.withColumn("source_shard", F.col("_metadata.file_name"))


def with_scan_order(df: DataFrame) -> DataFrame:
    """Add ``shard_path`` and ``shard_row``: the order of a scan, as plain columns."""
    return df.withColumn("shard_path", F.col("_metadata.file_path")).withColumn(
        "shard_row", F.col("_metadata.row_index")
    )


def list_files(spark: SparkSession, root: str, pattern: str = "*.parquet") -> DataFrame:
    """Every matching file below ``root``: path, directory, file_name.

    The binary source lists files as rows; its content column is pruned, so no
    file is opened. Names starting with ``.`` or ``_`` are never listed.
    """
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(root)
        .select("path")
        .transform(split_path)
    )


def split_path(df: DataFrame, path: str = "path") -> DataFrame:
    return df.withColumn("directory", P.directory(F.col(path))).withColumn("file_name", P.file_name(F.col(path)))


def shard_match(name: Column, style: str) -> Column:
    """Does a file name count as a shard for the ``embed`` or the ``reduce`` step?"""
    if style == "embed":
        return name.rlike(P.PART_DASH) | name.rlike(P.PART_UNDERSCORE_OF)
    if style == "reduce":
        return name.rlike(P.PART_DASH) | name.rlike(P.PART_UNDERSCORE)
    raise ValueError(f"unknown listing style {style!r}")


def shard_filter(files: DataFrame, style: str = "embed") -> DataFrame:
    """Keep the shard files of each directory.

    ``embed`` falls back to every Parquet file of a directory that has no
    matching name; ``reduce`` has no fallback. The per-directory test is an
    aggregate joined back, so a directory of any size stays spread out.
    """
    visible = files.filter(~P.is_hidden(F.col("file_name")) & P.is_parquet(F.col("file_name")))
    matched = visible.withColumn("_match", shard_match(F.col("file_name"), style))
    if style == "reduce":
        return matched.filter("_match").drop("_match")
    any_match = matched.groupBy("directory").agg(F.max("_match").alias("_any"))
    return matched.join(any_match, "directory").filter(F.col("_match") | ~F.col("_any")).drop("_match", "_any")


def limit_shards(files: DataFrame, n: int | None, per: Sequence[str] = ("directory",)) -> DataFrame:
    """The first ``n`` shards by name of every directory; 0 or ``None`` means all."""
    if not n:
        return files
    rank = F.row_number().over(Window.partitionBy(*per).orderBy("file_name"))
    return files.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def shard_inventory(df: DataFrame, path: Column | None = None) -> DataFrame:
    """Rows per shard without reading a data column.

    On a file scan the only column asked for is the file path, so the counts
    come from the footers. ``path`` overrides it for tables that carry their own.
    """
    path = F.col("_metadata.file_path") if path is None else path
    return df.groupBy(path.alias("path")).agg(F.count(F.lit(1)).alias("rows"))


def count_shards(
    spark: SparkSession,
    files: DataFrame,
    root: str,
    schema: T.StructType | str,
    on_corrupt: str = "fail",
) -> DataFrame:
    """Rows of every listed file below ``root``.

    ``on_corrupt="zero"`` counts an unreadable file as 0 rows; ``"fail"`` lets
    the scan raise. Files that yield no row at all still appear.
    """
    if on_corrupt not in ("fail", "zero"):
        raise ValueError("on_corrupt is 'fail' or 'zero'")
    scan = (
        spark.read.schema(schema)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .option("ignoreCorruptFiles", str(on_corrupt == "zero").lower())
        .parquet(root)
    )
    counted = shard_inventory(scan).withColumn("path", plain_path(F.col("path")))
    listed = files.withColumn("path", plain_path(F.col("path")))
    return listed.join(counted, "path", "left").withColumn("rows", F.coalesce("rows", F.lit(0).cast("long")))


def plain_path(path: Column) -> Column:
    """``file:///x`` and ``file:/x`` name the same file."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def canonical_names(files: DataFrame) -> DataFrame:
    """The map old name → ``part-<i>-of-<n>.parquet`` per directory.

    The five-digit format bounds a directory at 99,999 files, so ranking one
    directory in one task is bounded too. ``renamed`` is false throughout a
    directory whose names are canonical already.
    """
    shards = files.filter(~P.is_hidden(F.col("file_name")) & P.is_parquet(F.col("file_name")))
    whole = Window.partitionBy("directory")
    ranked = shards.withColumn("_i", F.row_number().over(whole.orderBy("file_name")) - 1).withColumn(
        "_n", F.count(F.lit(1)).over(whole)
    )
    return ranked.select(
        "directory",
        F.col("file_name").alias("old_name"),
        P.canonical_name(F.col("_i"), F.col("_n")).alias("new_name"),
    ).withColumn("renamed", F.col("old_name") != F.col("new_name"))
