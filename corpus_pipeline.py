"""The corpus pipeline over ``documents``: quality, near duplicates, mixing, token ids.

Each stage works on all that the one before kept. Stages 1 to 3 return the columns
of ``documents``; a document that the mix takes twice is two rows. The last one
returns a row of token ids for each row it gets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import hash_mix, lsh_forest, piece_table, pu_quality
from corpusloom.llm.queries import table, tokenizer_model
from corpusloom.session import cut_lineage

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Words that a worker of the tokenizer remembers, few since executors still hold memory that earlier stages took.
MEMO_WORDS = 150_000


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier accepts; it is trained on these documents and ``labels``."""
    model = pu_quality.train(docs, table(spark, sf_dir, "labels"))
    docs = docs.select(*COLUMNS)
    return docs.where(pu_quality.quality_score(model, F.col("text")) >= pu_quality.THRESHOLD)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of each class that names it, which has the class's smallest id.

    Rows with one id and different texts may be of different classes, so ids are
    looked at with their texts; of rows equal in both one stays. Documents without
    an id can't be named and stay if their class has no other.
    """
    docs = docs.select(*COLUMNS)
    marked = docs.withColumn("key", F.xxhash64(F.coalesce("text", F.lit("")), "doc_id"))
    classes = lsh_forest.similarity_classes(marked.select("key", "text"), "key")
    named = classes.select("key", "class_id").distinct()
    # The row to keep of each class: smallest id, then smallest key; a key stands for rows equal in id and text.
    best = (
        marked.select("key", "doc_id").distinct().join(named, "key").groupBy("class_id")
        .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("best"))
        .select("best.key")
    )
    return marked.join(best, "key", "left_semi").dropDuplicates(["key"]).select(*COLUMNS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    docs = docs.select(*COLUMNS)
    # The mix is told whole rows apart, so equal rows get equal counts and join back one to one.
    keyed = docs.withColumn("key", F.xxhash64(*COLUMNS))
    times = hash_mix.mix(keyed, "key").where("times > 0").select("key", "times").distinct()
    taken = keyed.join(times, "key")
    return taken.select(*COLUMNS, F.explode(F.sequence(F.lit(1), F.col("times")))).select(*COLUMNS)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text and digests of ids and decoded text: the rows that training reads."""
    keyed = docs.withColumn("key", F.struct("doc_id", "source"))
    coded = piece_table.encode_texts(keyed, tokenizer_model(), "key", memo_words=MEMO_WORDS)
    return coded.select(
        "key.doc_id", "key.source", F.size("ids").cast("long").alias("n_tokens"), "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality", quality),
    ("near duplicates", near_duplicates),
    ("mixing", mixing),
    ("token ids", token_ids),
]

#: The classifier's sums and the tokenizer can't be said in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each one's result is written as Parquet and read back as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
