"""Preprocess step over folders: content and metadata shards in, preprocessed shards out."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators.preprocess import preprocess
from corpusloom.sources.shards import limit_shards, list_files, with_scan_order, with_source_shard
from corpusloom.sources.sinks import ROWS_PER_SHARD, write_parquet


@dataclass(frozen=True)
class PreprocessSettings:
    key: str
    text: str
    fields: Sequence[str]
    shard_limit: int | None = None
    record_limit: int | None = None
    rows_per_shard: int = ROWS_PER_SHARD


def read_folder(spark: SparkSession, folder: str, limit: int | None = None) -> DataFrame:
    """Rows of the Parquet files at any depth below ``folder``, the first ``limit`` files by path, in scan order.

    One path per file comes to the driver, as with any read of a folder.
    """
    files = list_files(spark, folder).withColumn("root", F.lit(folder)).withColumn("file_name", F.col("path"))
    paths = [r["path"] for r in limit_shards(files, limit, ("root",)).select("path").orderBy("path").collect()]
    if not paths:
        raise FileNotFoundError(f"no Parquet files below {folder}")
    return with_scan_order(with_source_shard(spark.read.parquet(*paths)))


def run_preprocess(spark: SparkSession, raw: str, out: str, settings: PreprocessSettings, mode: str = "overwrite") -> DataFrame:
    """``raw/content`` joined to ``raw/metadata``, cleaned, and written as shards to ``out``; returns what was written.

    Each document carries ``source_shard``, the file it came from. The last
    metadata row of a key in scan order wins, so all of the metadata is read;
    limits apply to content files and to surviving records.
    """
    content = read_folder(spark, f"{raw}/content", settings.shard_limit)
    meta = read_folder(spark, f"{raw}/metadata")
    done = preprocess(
        content,
        meta,
        settings.key,
        settings.text,
        settings.fields,
        ["shard_path", "shard_row"],
        settings.record_limit,
        ["shard_path", "shard_row"],
    )
    write_parquet(done, out, rows_per_shard=settings.rows_per_shard, mode=mode)
    return spark.read.schema(done.schema).parquet(out)
