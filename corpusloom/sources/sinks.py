"""Writers: Parquet, CSV and JSON, with the catalog export."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from corpusloom.sources.catalog import EXPORT_COLUMNS

# Fixed value: records per output shard.
ROWS_PER_SHARD = 10_000


def write_parquet(
    df: DataFrame,
    path: str,
    columns: Sequence[str] | None = None,
    partition_by: Sequence[str] = (),
    rows_per_shard: int | None = ROWS_PER_SHARD,
    mode: str = "errorifexists",
) -> None:
    """Write shards of at most ``rows_per_shard`` rows; ``_SUCCESS`` marks the end."""
    out = df.select(*columns) if columns else df
    writer = out.write.mode(mode)
    if rows_per_shard:
        writer = writer.option("maxRecordsPerFile", rows_per_shard)
    if partition_by:  # an overwrite replaces only the partitions it writes
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def write_csv(
    df: DataFrame,
    path: str,
    enabled: bool = True,
    sep: str = ",",
    partition_by: Sequence[str] = (),
    mode: str = "errorifexists",
) -> None:
    """The CSV copy; switched off with ``enabled=False``."""
    if not enabled:
        return
    writer = df.write.mode(mode).option("header", "true").option("sep", sep)
    if partition_by:  # an overwrite replaces only the partitions it writes
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.csv(path)


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def export_catalog(cat: DataFrame, path: str, fmt: str = "json", mode: str = "errorifexists") -> None:
    """The catalog's eight public columns as JSON or TSV, sorted by key."""
    out = cat.select(*EXPORT_COLUMNS).orderBy("key")
    if fmt == "json":
        write_json(out, path, mode)
    elif fmt == "tsv":
        write_csv(out, path, sep="\t", mode=mode)
    else:
        raise ValueError(f"unknown catalog format {fmt!r}")
