"""Embed step over many datasets: resumable, recorded, one failure at a time."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators.embed import BATCH_SIZE, EMBEDDING_DIM, MAX_SEQ_LENGTH, hash_embed, to_embeddings
from corpusloom.plans.reduce_run import read_records
from corpusloom.sources.catalog import candidates, pending
from corpusloom.sources.shards import limit_shards, list_files, shard_filter
from corpusloom.sources.sinks import ROWS_PER_SHARD, write_json, write_parquet

RECORD_SCHEMA = (
    "dataset_key string, model_id string, embedding_dim int, max_seq_length int, batch_size int, "
    "num_gpus int, num_input_files long, num_documents long, time_taken_s double, "
    "throughput_docs_per_sec double, timestamp string"
)
RESULT_SCHEMA = "key string, ok boolean, error string"

Embedder = Callable[[DataFrame], DataFrame]

# Appends to one folder share its commit folder, so they take turns.
_APPEND = threading.Lock()


@dataclass(frozen=True)
class EmbedSettings:
    key: str = "id"
    text: str = "text"
    model_id: str = "hashing"
    dim: int = EMBEDDING_DIM
    max_seq_length: int = MAX_SEQ_LENGTH
    batch_size: int = BATCH_SIZE
    rows_per_shard: int = ROWS_PER_SHARD
    file_limit: int | None = None


def default_embedder(s: EmbedSettings) -> Embedder:
    return lambda df: hash_embed(df, s.key, s.text, s.dim, s.max_seq_length)


def run_record(spark: SparkSession, s: EmbedSettings, key: str, files: int, docs: int, elapsed: float) -> DataFrame:
    """The record of one finished dataset: counts, time (2 dp), docs/s (1 dp)."""
    base = spark.createDataFrame(
        [(key, s.model_id, s.dim, s.max_seq_length, s.batch_size, files, docs, elapsed)],
        "dataset_key string, model_id string, embedding_dim int, max_seq_length int, batch_size int, "
        "num_input_files long, num_documents long, elapsed double",
    )
    rate = F.when(F.col("elapsed") > 0, F.col("num_documents") / F.col("elapsed")).otherwise(F.lit(0.0))
    return (
        base.withColumn("num_gpus", F.lit(spark.sparkContext.defaultParallelism))
        .withColumn("time_taken_s", F.round("elapsed", 2))
        .withColumn("throughput_docs_per_sec", F.round(rate, 1))
        .withColumn("timestamp", F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss"))
        .select(*[f.split()[0] for f in RECORD_SCHEMA.split(", ")])
    )


def listed_shards(spark: SparkSession, folder: str, limit: int | None = None) -> list[str]:
    """Paths of a dataset's shards by the embed step's listing rule, the first ``limit`` by name of each folder.

    One path per shard of one dataset, as many as Spark's reader lists itself.
    """
    shards = limit_shards(shard_filter(list_files(spark, folder), "embed"), limit)
    paths = [r["path"] for r in shards.select("path").orderBy("path").collect()]
    if not paths:
        raise FileNotFoundError(f"no shards in {folder}")
    return paths


def embed_dataset(
    spark: SparkSession,
    row: Row,
    records: str,
    settings: EmbedSettings,
    embedder: Embedder | None = None,
    source: Callable[[Row], DataFrame] | None = None,
) -> None:
    """Embed one catalog row and append its record.

    Only listed shards are read, whatever else lies in the folder. Documents are
    counted while the vectors are written. The record is appended after the write
    has committed, so an interrupted dataset is done again.
    """
    files = row["shards"]
    if source:
        docs = source(row)
    else:
        paths = listed_shards(spark, row["preprocessed"], settings.file_limit)
        docs, files = spark.read.parquet(*paths), len(paths)
    vectors = to_embeddings((embedder or default_embedder(settings))(docs), settings.dim)
    seen = Observation()
    start = time.perf_counter()
    counted = vectors.observe(seen, F.count(F.lit(1)).alias("docs"))
    write_parquet(counted, row["embeddings_out"], rows_per_shard=settings.rows_per_shard, mode="overwrite")
    elapsed = time.perf_counter() - start
    record = run_record(spark, settings, row["key"], files, seen.get["docs"], elapsed)
    with _APPEND:
        write_json(record, records, mode="append")


def run_all(
    cat: DataFrame,
    records: str,
    settings: EmbedSettings = EmbedSettings(),
    embedder: Embedder | None = None,
    source: Callable[[Row], DataFrame] | None = None,
    parallel: int = 1,
) -> DataFrame:
    """Embed every dataset with shards and no record; returns (key, ok, error).

    One dataset's failure is reported and the rest go on. The driver holds only
    catalog rows; ``parallel`` lets small datasets share the cluster.
    """
    spark = cat.sparkSession
    done = read_records(spark, records, RECORD_SCHEMA).select(F.col("dataset_key").alias("key"))
    todo = pending(candidates(cat), done).orderBy("key").collect()

    def attempt(row: Row) -> tuple[str, bool, str | None]:
        try:
            embed_dataset(spark, row, records, settings, embedder, source)
        except Exception as exc:  # noqa: BLE001 - reported in the result
            return row["key"], False, f"{type(exc).__name__}: {exc}"
        return row["key"], True, None

    with ThreadPoolExecutor(max_workers=max(parallel, 1)) as pool:
        results = list(pool.map(attempt, todo))
    return spark.createDataFrame(results, RESULT_SCHEMA)


def all_succeeded(results: DataFrame) -> bool:
    return results.filter(~F.col("ok")).isEmpty()
