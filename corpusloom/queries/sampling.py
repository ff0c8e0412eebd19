"""Planning and sampling queries. Document splits are (source, lang); vector splits are labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators import sampling as SM
from corpusloom.queries import Query, table

DOC_SPLIT = ("source", "lang")
CAP = 10


def documents(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", *DOC_SPLIT)


def counts(spark: SparkSession, d: str) -> DataFrame:
    return SM.count_splits(documents(spark, d), DOC_SPLIT)


def plan_reduction(spark: SparkSession, d: str) -> DataFrame:
    return SM.plan_reduction(counts(spark, d), CAP)


def eligible_splits(spark: SparkSession, d: str) -> DataFrame:
    return SM.eligible(counts(spark, d))


def reduction_params(spark: SparkSession, d: str) -> DataFrame:
    return SM.reduction_params(SM.eligible(counts(spark, d)))


def sample_split(spark: SparkSession, d: str) -> DataFrame:
    return SM.sample_split(documents(spark, d), "doc_id", CAP, SM.SEED, DOC_SPLIT)


def sample_vectors(spark: SparkSession, d: str) -> DataFrame:
    vectors = table(spark, d, "embeddings").select("vec_id", "label")
    return SM.sample_split(vectors, "vec_id", 2 * CAP, SM.SEED, ("label",)).select("vec_id", "label")


def dense_row_id(spark: SparkSession, d: str) -> DataFrame:
    return SM.with_row_id(documents(spark, d), DOC_SPLIT, ["doc_id"])


def sampled_row_id(spark: SparkSession, d: str) -> DataFrame:
    sampled = SM.sample_split(documents(spark, d), "doc_id", CAP, SM.SEED, DOC_SPLIT)
    return SM.with_row_id(sampled, DOC_SPLIT, ["sample_order", "doc_id"]).drop("sample_order")


def vector_check(spark: SparkSession, d: str) -> DataFrame:
    vectors = SM.to_vectors(table(spark, d, "embeddings"), "embedding")
    return SM.check_vectors(vectors, "embedding", ("label",))


COUNTS_SQL = "counts AS (SELECT source, lang, count(*) AS rows FROM documents GROUP BY ALL)"
SAMPLE_SQL = f"""
ordered AS (
  SELECT doc_id, source, lang, md5('{SM.SEED}:' || doc_id) AS digest,
         count(*) OVER (PARTITION BY source, lang) AS n,
         row_number() OVER (PARTITION BY source, lang ORDER BY md5('{SM.SEED}:' || doc_id), doc_id) AS pos
  FROM documents
),
sampled AS (
  SELECT doc_id, source, lang, CASE WHEN n > {CAP} THEN digest ELSE '' END AS sample_order
  FROM ordered WHERE pos <= {CAP}
)"""

QUERIES = {
    "plan_reduction": Query(
        plan_reduction, f"WITH {COUNTS_SQL} SELECT source, lang, rows, least(rows, {CAP}) AS planned_rows FROM counts"
    ),
    "eligible_splits": Query(eligible_splits, f"WITH {COUNTS_SQL} SELECT * FROM counts WHERE rows >= 5"),
    "reduction_params": Query(
        reduction_params,
        f"""WITH {COUNTS_SQL}, p AS (
  SELECT *, least(30, greatest(1, rows - 1) // 3) AS perplexity FROM counts WHERE rows >= 5
)
SELECT *, CAST(least(rows - 1, greatest(90, ceil(3 * perplexity))) AS BIGINT) AS tsne_neighbors,
       least(15, rows - 1) AS umap_neighbors
FROM p""",
    ),
    "sample_split": Query(sample_split, f"WITH {SAMPLE_SQL} SELECT * FROM sampled"),
    "sample_vectors": Query(
        sample_vectors,
        f"""SELECT vec_id, label FROM embeddings
QUALIFY row_number() OVER (PARTITION BY label ORDER BY md5('{SM.SEED}:' || vec_id), vec_id) <= {2 * CAP}""",
    ),
    "dense_row_id": Query(
        dense_row_id,
        """SELECT doc_id, source, lang, row_number() OVER (PARTITION BY source, lang ORDER BY doc_id) - 1 AS row_id
FROM documents""",
    ),
    "sampled_row_id": Query(
        sampled_row_id,
        f"""WITH {SAMPLE_SQL}
SELECT doc_id, source, lang,
       row_number() OVER (PARTITION BY source, lang ORDER BY sample_order, doc_id) - 1 AS row_id
FROM sampled""",
    ),
    "vector_check": Query(
        vector_check,
        """SELECT label, count(*) AS rows, CAST(min(len(embedding)) AS INTEGER) AS min_dim,
       CAST(max(len(embedding)) AS INTEGER) AS max_dim, CAST(0 AS BIGINT) AS bad_vectors,
       min(len(embedding)) = max(len(embedding)) AS ok
FROM embeddings GROUP BY label""",
    ),
}
