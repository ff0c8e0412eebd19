"""Preprocess queries. Content is every document with padded text, plus blank
rows (one per label) and null-key rows (one per conversation turn), so that the
cleaning rules have something to do; metadata is the label table with nulls."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.text import WHITESPACE, is_blank, strip_text
from corpusloom.operators import preprocess as P
from corpusloom.queries import Query, table

FIELDS = ["quality", "toxic"]


def content(spark: SparkSession, d: str) -> DataFrame:
    pad = F.when(F.col("lang") == "en", F.concat(F.lit("\u3000\t"), F.col("text"), F.lit("\xa0"))).when(
        F.col("lang") == "de", F.concat(F.lit("\u2028 "), F.col("text"), F.lit("\x1f\n"))
    )
    docs = table(spark, d, "documents").select(
        "doc_id", F.coalesce(pad, F.col("text")).alias("content"), F.col("source").alias("source_shard")
    )
    blank = table(spark, d, "labels").select(
        "doc_id",
        F.when(F.col("quality") == 1, F.lit("\u3000\n ")).when(F.col("toxic") == 1, F.lit("")).alias("content"),
        F.lit("blank").alias("source_shard"),
    )
    keyless = table(spark, d, "conversations").select(
        F.when(F.col("turn") < 0, F.col("conv_id")).alias("doc_id"), F.col("text").alias("content"), F.col("role").alias("source_shard")
    )
    return docs.unionByName(blank).unionByName(keyless)


def meta(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "labels").select(
        "doc_id",
        F.col("quality").cast("string").alias("quality"),
        F.when(F.col("quality") == 1, F.col("toxic").cast("string")).alias("toxic"),
    )


CONTENT_SQL = """
content AS (
  SELECT doc_id,
         CASE WHEN lang = 'en' THEN chr(12288) || chr(9) || text || chr(160)
              WHEN lang = 'de' THEN chr(8232) || ' ' || text || chr(31) || chr(10)
              ELSE text END AS content,
         source AS source_shard
  FROM documents
  UNION ALL
  SELECT doc_id, CASE WHEN quality = 1 THEN chr(12288) || chr(10) || ' ' WHEN toxic = 1 THEN '' END, 'blank'
  FROM labels
  UNION ALL
  SELECT CASE WHEN turn < 0 THEN conv_id END, text, role FROM conversations
)"""
META_SQL = """
meta AS (
  SELECT doc_id, CAST(quality AS VARCHAR) AS quality,
         CASE WHEN quality = 1 THEN CAST(toxic AS VARCHAR) END AS toxic
  FROM labels
)"""
WS_SQL = "(" + " || ".join(f"chr({ord(c)})" for c in WHITESPACE) + ")"
CLEAN_SQL = f"""
clean AS (
  SELECT doc_id, trim(content, {WS_SQL}) AS text, source_shard
  FROM content
  WHERE doc_id IS NOT NULL AND trim(content, {WS_SQL}) <> ''
)"""
ENRICH_COLUMNS_SQL = """
  CASE WHEN m.doc_id IS NULL THEN '' ELSE m.quality END AS quality,
  CASE WHEN m.doc_id IS NULL THEN '' ELSE m.toxic END AS toxic"""


def preprocess_full(spark: SparkSession, d: str) -> DataFrame:
    return P.preprocess(content(spark, d), meta(spark, d), "doc_id", "content", FIELDS, ["quality"])


def metadata_last_wins(spark: SparkSession, d: str) -> DataFrame:
    return P.metadata_lookup(table(spark, d, "conversations"), "conv_id", ["role", "text"], ["turn"])


def enrich_left_join(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "source", "lang")
    return P.enrich(docs, meta(spark, d), "doc_id", FIELDS)


def drop_blank_rows(spark: SparkSession, d: str) -> DataFrame:
    return P.drop_blank(content(spark, d), "doc_id", "content")


def blank_profile(spark: SparkSession, d: str) -> DataFrame:
    rows = content(spark, d)
    return rows.groupBy("source_shard").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("doc_id").isNull()).alias("null_keys"),
        F.count_if(is_blank(F.col("content"))).alias("blank_texts"),
    )


def strip_text_query(spark: SparkSession, d: str) -> DataFrame:
    return content(spark, d).select("doc_id", "source_shard", strip_text(F.col("content")).alias("text"))


def record_limit(spark: SparkSession, d: str) -> DataFrame:
    clean = P.drop_blank(content(spark, d), "doc_id", "content")
    return P.limit_records(clean, 100, ["source_shard", "doc_id"]).select("doc_id", "source_shard")


def rename_and_order(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").withColumn("source_shard", F.col("source"))
    return P.project_preprocessed(docs, "doc_id", "text", ["lang", "n_chars"])


QUERIES = {
    "preprocess_full": Query(
        preprocess_full,
        f"""WITH {CONTENT_SQL}, {META_SQL}, {CLEAN_SQL}
SELECT c.text, c.doc_id, {ENRICH_COLUMNS_SQL}, c.source_shard
FROM clean c LEFT JOIN meta m ON c.doc_id = m.doc_id""",
    ),
    "metadata_last_wins": Query(
        metadata_last_wins,
        """SELECT conv_id, arg_max(role, turn) AS role, arg_max(text, turn) AS text
FROM conversations GROUP BY conv_id""",
    ),
    "enrich_left_join": Query(
        enrich_left_join,
        f"""WITH {META_SQL}
SELECT d.doc_id, d.source, d.lang, {ENRICH_COLUMNS_SQL}
FROM documents d LEFT JOIN meta m ON d.doc_id = m.doc_id""",
    ),
    "drop_blank_rows": Query(
        drop_blank_rows,
        f"""WITH {CONTENT_SQL}
SELECT doc_id, content, source_shard FROM content
WHERE doc_id IS NOT NULL AND trim(content, {WS_SQL}) <> ''""",
    ),
    "blank_profile": Query(
        blank_profile,
        f"""WITH {CONTENT_SQL}
SELECT source_shard, count(*) AS rows, count(*) FILTER (doc_id IS NULL) AS null_keys,
       count(*) FILTER (coalesce(trim(content, {WS_SQL}), '') = '') AS blank_texts
FROM content GROUP BY source_shard""",
    ),
    "strip_text": Query(
        strip_text_query,
        f"WITH {CONTENT_SQL} SELECT doc_id, source_shard, trim(content, {WS_SQL}) AS text FROM content",
    ),
    "record_limit": Query(
        record_limit,
        f"""WITH {CONTENT_SQL}
SELECT doc_id, source_shard FROM content
WHERE doc_id IS NOT NULL AND trim(content, {WS_SQL}) <> ''
ORDER BY source_shard, doc_id LIMIT 100""",
    ),
    "rename_and_order": Query(
        rename_and_order,
        f"""SELECT trim(text, {WS_SQL}) AS text, doc_id, lang, n_chars, source AS source_shard FROM documents""",
    ),
}
