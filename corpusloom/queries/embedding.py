"""Embedding queries over the whole document and vector tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.text import WHITESPACE
from corpusloom.operators import embed as E
from corpusloom.queries import Query, table

DIM = 64
WINDOW = 128


def long_form(df: DataFrame, key: str, column: str = "embeddings") -> DataFrame:
    """Non-zero coordinates as (key, dim, value)."""
    return (
        df.select(key, F.posexplode(column).alias("dim", "value"))
        .filter("value <> 0")
        .withColumn("value", F.round(F.col("value").cast("double"), 6))
    )


WS_CLASS_SQL = "('[' || " + " || ".join(f"chr({ord(c)})" for c in WHITESPACE) + " || ']+')"
TOKENS_SQL = f"""
tok AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(text), {WS_CLASS_SQL}), lambda t: t <> '') AS toks
  FROM documents
)"""


def hash_sql(window: int) -> str:
    return f"""WITH {TOKENS_SQL},
win AS (SELECT doc_id, toks[1:{window}] AS toks FROM tok),
one AS (SELECT doc_id, len(toks) AS n, md5(unnest(toks)) AS h FROM win),
coded AS (
  SELECT doc_id, n, CAST('0x' || h[1:8] AS BIGINT) % {DIM} AS dim,
         CASE WHEN h[9] IN ('0','1','2','3','4','5','6','7') THEN 1 ELSE -1 END AS sign
  FROM one
)
SELECT doc_id, CAST(dim AS INTEGER) AS dim, round(CAST(CAST(sum(sign) AS DOUBLE) / any_value(n) AS FLOAT)::DOUBLE, 6) AS value
FROM coded GROUP BY doc_id, dim HAVING sum(sign) <> 0"""


def documents(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents")


def workers(spark: SparkSession) -> int:
    return spark.sparkContext.defaultParallelism


def text_projection(spark: SparkSession, d: str) -> DataFrame:
    return E.embed_input(documents(spark, d), "doc_id")


def truncate_tokens(spark: SparkSession, d: str) -> DataFrame:
    toks = E.token_window(F.col("text"), WINDOW)
    capped = E.token_window(F.col("text"), E.MAX_SEQ_LENGTH, max_chars=WINDOW * 4)
    return documents(spark, d).select(
        "doc_id", F.array_join(toks, " ").alias("window"), F.size(toks).alias("kept"), F.size(capped).alias("kept_by_chars")
    )


def hash_embed(spark: SparkSession, d: str) -> DataFrame:
    return long_form(E.hash_embed(documents(spark, d), "doc_id", dim=DIM, partitions=workers(spark)), "doc_id")


def hash_embed_window(spark: SparkSession, d: str) -> DataFrame:
    return long_form(E.hash_embed(documents(spark, d), "doc_id", dim=DIM, max_tokens=WINDOW), "doc_id")


def batch_embed(spark: SparkSession, d: str) -> DataFrame:
    return long_form(E.embed(documents(spark, d), "doc_id", E.hashing_model(DIM), partitions=workers(spark)), "doc_id")


def mean_pool(spark: SparkSession, d: str) -> DataFrame:
    pooled = E.mean_pool(table(spark, d, "embeddings"), "label", "embedding")
    return pooled.select("label", F.posexplode("embeddings").alias("dim", "value")).withColumn(
        "value", F.round("value", 6)
    )


def vector_output(spark: SparkSession, d: str) -> DataFrame:
    doubled = table(spark, d, "embeddings").select(
        "vec_id", F.transform("embedding", lambda x: x.cast("double") / 3).alias("embeddings")
    )
    out = E.to_embeddings(doubled, DIM)
    return out.select("vec_id", F.posexplode("embeddings").alias("dim", "value")).withColumn(
        "value", F.round(F.col("value").cast("double"), 6)
    )


QUERIES = {
    "text_projection": Query(text_projection, "SELECT doc_id, text FROM documents"),
    "truncate_tokens": Query(
        truncate_tokens,
        f"""WITH {TOKENS_SQL},
capped AS (
  SELECT doc_id, len(list_filter(regexp_split_to_array(lower(text[1:{WINDOW * 4}]), {WS_CLASS_SQL}),
                                 lambda t: t <> '')) AS kept_by_chars
  FROM documents
)
SELECT t.doc_id, array_to_string(t.toks[1:{WINDOW}], ' ') AS "window",
       CAST(len(t.toks[1:{WINDOW}]) AS INTEGER) AS kept, CAST(c.kept_by_chars AS INTEGER) AS kept_by_chars
FROM tok t JOIN capped c ON t.doc_id = c.doc_id""",
    ),
    "hash_embed": Query(hash_embed, hash_sql(E.MAX_SEQ_LENGTH)),
    "hash_embed_window": Query(hash_embed_window, hash_sql(WINDOW)),
    "batch_embed": Query(batch_embed, hash_sql(E.MAX_SEQ_LENGTH)),
    "mean_pool": Query(
        mean_pool,
        """WITH e AS (
  SELECT label, CAST(unnest(embedding) AS DOUBLE) AS x, unnest(range(len(embedding))) AS dim FROM embeddings
)
SELECT label, CAST(dim AS INTEGER) AS dim, round(avg(x), 6) AS value FROM e GROUP BY label, dim""",
    ),
    "vector_output": Query(
        vector_output,
        """SELECT vec_id, CAST(unnest(range(len(embedding))) AS INTEGER) AS dim,
       round(CAST(CAST(CAST(unnest(embedding) AS DOUBLE) / 3 AS FLOAT) AS DOUBLE), 6) AS value
FROM embeddings""",
    ),
}
