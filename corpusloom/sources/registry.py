"""The dataset registry: one row per configured dataset."""

from __future__ import annotations

import json
from collections.abc import Mapping
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

REGISTRY_SCHEMA = T.StructType(
    [
        T.StructField("key", T.StringType(), False),
        T.StructField("hf_name", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("format", T.StringType()),
        T.StructField("hf_configs", T.ArrayType(T.StringType())),
        T.StructField("join_key", T.StringType()),
        T.StructField("text_field", T.StringType()),
        T.StructField("metadata_fields", T.ArrayType(T.StringType())),
        T.StructField(
            "text_strategy",
            T.StructType(
                [
                    T.StructField("fields", T.ArrayType(T.StringType())),
                    T.StructField("template", T.StringType()),
                    T.StructField("description", T.StringType()),
                    T.StructField("preprocessing", T.StringType()),
                ]
            ),
        ),
    ]
)


def load_config(path: str) -> dict[str, Any]:
    """Settings from a JSON or YAML file."""
    text = Path(path).read_text(encoding="utf-8")
    if path.endswith(".json"):
        return json.loads(text)
    import yaml

    return yaml.safe_load(text)


def registry(spark: SparkSession, datasets: Mapping[str, Mapping[str, Any]]) -> DataFrame:
    """The ``datasets:`` block of a configuration as a DataFrame."""
    rows = []
    for key, spec in datasets.items():
        strategy = spec.get("text_strategy")
        rows.append(
            (
                key,
                spec.get("hf_name"),
                spec.get("category"),
                spec.get("format"),
                spec.get("hf_configs"),
                spec.get("join_key"),
                spec.get("text_field"),
                spec.get("metadata_fields"),
                None
                if strategy is None
                else tuple(strategy.get(f) for f in ("fields", "template", "description", "preprocessing")),
            )
        )
    return spark.createDataFrame(rows, REGISTRY_SCHEMA)


def usable_datasets(reg: DataFrame) -> DataFrame:
    """Registry rows the preprocess step accepts: Parquet only."""
    return reg.filter(F.col("format") == "parquet")


def require_dataset(reg: DataFrame, key: str) -> Row:
    """The registry row of ``key``; unknown keys and other formats are errors."""
    found = reg.filter(F.col("key") == key).head(1)
    if not found:
        raise KeyError(f"unknown dataset {key!r}")
    if found[0]["format"] != "parquet":
        raise ValueError(f"dataset {key!r} must have format parquet, not {found[0]['format']!r}")
    return found[0]
