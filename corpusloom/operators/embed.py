"""Embed step: text projection, token window, model inference, pooling, output form."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, predict_batch_udf, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.text import tokens, truncate_chars, truncate_tokens

# Defaults of the embed step.
EMBEDDING_DIM = 4096
MAX_SEQ_LENGTH = 32_768
BATCH_SIZE = 8

VECTOR = T.ArrayType(T.FloatType())

# Rows turned into one dense block at a time inside a task.
DENSE_ROWS = 256

PredictFactory = Callable[[], Callable[[np.ndarray], np.ndarray]]


def embed_input(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """The columns the step reads: the text, and the key the vectors are stored under."""
    return df.select(key, text)


def token_window(text: Column, max_tokens: int = MAX_SEQ_LENGTH, max_chars: int | None = None) -> Column:
    """Tokens of a text inside the model window."""
    return truncate_tokens(tokens(truncate_chars(text, max_chars)), max_tokens)


def token_codes(toks: Column) -> Column:
    """Each token's leading nine md5 hex digits as a number: eight pick the
    dimension, the ninth the sign."""
    return F.transform(toks, lambda t: F.conv(F.substring(F.md5(t), 1, 9), 16, 10).cast("long"))


def _pool_codes(flat: np.ndarray, lengths: np.ndarray, dim: int) -> np.ndarray:
    """Mean of the signed one-hot token vectors of each row."""
    row = np.repeat(np.arange(len(lengths)), lengths)
    sign = np.where((flat & 15) < 8, 1.0, -1.0)
    total = np.bincount(row * dim + (flat >> 4) % dim, weights=sign, minlength=len(lengths) * dim)
    return (total.reshape(len(lengths), dim) / np.maximum(lengths, 1)[:, None]).astype(np.float32)


def hashing_embedder(dim: int = EMBEDDING_DIM) -> Callable[[Column], Column]:
    """Weight-free default embedder: token codes → one float32 vector per row.

    Hashing stays in the JVM; Python only counts codes per dimension, a block
    of rows at a time. The operation is row-local: nothing is shuffled.
    """

    @F.pandas_udf(VECTOR)
    def pooled(codes: pd.Series) -> pd.Series:
        out: list[np.ndarray] = []
        for at in range(0, len(codes), DENSE_ROWS):
            block = [np.asarray(c, dtype=np.int64) for c in codes.iloc[at : at + DENSE_ROWS]]
            lengths = np.array([len(c) for c in block])
            out.extend(_pool_codes(np.concatenate(block), lengths, dim))
        return pd.Series(out)

    once = pooled.asNondeterministic()  # so that no rule copies the call into a filter
    return lambda toks: once(token_codes(toks))


def hash_embed(
    df: DataFrame,
    key: str,
    text: str = "text",
    dim: int = EMBEDDING_DIM,
    max_tokens: int = MAX_SEQ_LENGTH,
    max_chars: int | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Key and vector of every row, by the default embedder.

    ``partitions`` spreads the rows first when the input has fewer shards than
    the cluster has workers.
    """
    toks = token_window(F.col(text), max_tokens, max_chars)
    source = embed_input(df, key, text)
    if partitions:
        source = source.repartition(partitions)
    return source.select(key, hashing_embedder(dim)(toks).alias("embeddings"))


def hashing_model(dim: int = EMBEDDING_DIM, max_tokens: int = MAX_SEQ_LENGTH) -> PredictFactory:
    """The default embedder in the form a real model takes: a predict factory.

    The factory runs once per Python worker; the function it returns maps a
    batch of texts to a ``(batch, dim)`` array.
    """

    def load() -> Callable[[np.ndarray], np.ndarray]:
        from hashlib import md5

        def predict(texts: np.ndarray) -> np.ndarray:
            codes = [
                [int(md5(t.encode()).hexdigest()[:9], 16) for t in text.lower().split()[:max_tokens]]
                for text in texts.ravel()
            ]
            flat = np.array([c for row in codes for c in row], dtype=np.int64)
            return _pool_codes(flat, np.array([len(row) for row in codes]), dim)

        return predict

    return load


def embed(
    df: DataFrame,
    key: str,
    model: PredictFactory,
    text: str = "text",
    batch_size: int = BATCH_SIZE,
    partitions: int | None = None,
    max_chars: int | None = None,
) -> DataFrame:
    """Batched inference with a plugged-in model.

    ``partitions`` spreads the rows before the model when the input has fewer
    shards than the cluster has workers.
    """
    source = embed_input(df, key, text)
    if partitions:
        source = source.repartition(partitions)
    infer = predict_batch_udf(model, return_type=VECTOR, batch_size=batch_size).asNondeterministic()
    return source.select(key, infer(truncate_chars(F.col(text), max_chars)).alias("embeddings"))


def mean_pool(df: DataFrame, key: str, vector: str) -> DataFrame:
    """Per-dimension mean of the vectors of a key.

    ``Summarizer`` keeps one running vector per key and partition, so neither
    the dimensions nor a hot key are exploded into rows.
    """
    mean = Summarizer.mean(array_to_vector(F.col(vector)))
    return df.groupBy(key).agg(vector_to_array(mean).alias("embeddings"))


def to_embeddings(df: DataFrame, dim: int, column: str = "embeddings") -> DataFrame:
    """Float32 lists of exactly ``dim`` values; any other length fails the job."""
    value = F.col(column).cast(VECTOR)
    checked = F.when(F.size(value) == dim, value).otherwise(
        F.raise_error(F.concat(F.lit(f"expected {dim} values, found "), F.size(value).cast("string")))
    )
    return df.withColumn(column, checked)


def vectors_only(df: DataFrame) -> DataFrame:
    """Just the vector column, the form without keys."""
    return df.select("embeddings")
