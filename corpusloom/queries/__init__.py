"""The registered queries: every operator on the given tables, with its SQL check."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession


class Query(NamedTuple):
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def all_queries() -> dict[str, Query]:
    from corpusloom.queries import catalog, embedding, preprocess, reduction, runs, sampling

    merged: dict[str, Query] = {}
    for module in (preprocess, catalog, embedding, sampling, reduction, runs):
        merged.update(module.QUERIES)
    return merged
