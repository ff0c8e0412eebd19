"""Whole runs over folders: the given tables are written as shards below the checkpoint folder, run, and read back."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corpusloom.operators.sampling import SPLIT
from corpusloom.plans.embed_run import RECORD_SCHEMA, EmbedSettings, run_all
from corpusloom.plans.preprocess_run import PreprocessSettings, run_preprocess
from corpusloom.plans.reduce_run import ReduceSettings, read_records, read_vectors, run_reduce
from corpusloom.queries import Query, table
from corpusloom.queries.catalog import CATALOG_SQL, EXPORT_SQL, configured, full_catalog
from corpusloom.queries.preprocess import CLEAN_SQL, CONTENT_SQL, ENRICH_COLUMNS_SQL, FIELDS, META_SQL, content, meta
from corpusloom.session import ensure_checkpoint_dir
from corpusloom.sources.catalog import EXPORT_COLUMNS
from corpusloom.sources.shards import count_shards, plain_path, split_path
from corpusloom.sources.sinks import export_catalog, write_csv, write_json, write_parquet
from corpusloom.sources.splits import discover_splits, label_splits, read_sidecars, summarise_splits, with_sidecars


def folder(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark)}/run-{uuid.uuid4().hex}"


def preprocess_folders(spark: SparkSession, d: str) -> DataFrame:
    """The preprocess run; each document comes from some content shard."""
    raw = folder(spark)
    rows = content(spark, d).select("doc_id", "content")
    shards = max(3, rows.rdd.getNumPartitions())  # several, and as many as the scan has tasks
    rows.repartition(shards, "doc_id").write.parquet(f"{raw}/raw/content")
    meta(spark, d).write.parquet(f"{raw}/raw/metadata")
    settings = PreprocessSettings("doc_id", "content", FIELDS)
    done = run_preprocess(spark, f"{raw}/raw", f"{raw}/preprocessed", settings)
    return done.withColumn("from_shard", F.endswith("source_shard", F.lit(".parquet"))).drop("source_shard")


def embed_folders(spark: SparkSession, d: str) -> DataFrame:
    """The embed run over one dataset per language: its records and the vectors it wrote."""
    root = folder(spark)
    docs = table(spark, d, "documents").select("doc_id", "text", "lang")
    docs.write.partitionBy("lang").parquet(f"{root}/in")  # by the tasks of the scan, so no language is one task
    keys = docs.select(F.col("lang").alias("key")).distinct()
    cat = keys.select(
        "key",
        F.concat(F.lit(f"{root}/in/lang="), "key").alias("preprocessed"),
        F.concat(F.lit(f"{root}/out/lang="), "key").alias("embeddings_out"),
        F.lit(1).cast("long").alias("shards"),
    )
    report = run_all(cat, f"{root}/records", EmbedSettings(key="doc_id", dim=16))
    records = read_records(spark, f"{root}/records", RECORD_SCHEMA)
    vectors = spark.read.parquet(f"{root}/out").groupBy(F.col("lang").alias("dataset_key")).agg(
        F.count("*").alias("vectors"), F.max(F.size("embeddings")).alias("width")
    )
    done = report.select(F.col("key").alias("dataset_key"), "ok")
    return (
        records.join(vectors, "dataset_key")
        .join(done, "dataset_key")
        .select("dataset_key", "ok", "model_id", "embedding_dim", "num_documents", "vectors", "width")
    )


def written_and_read(spark: SparkSession, d: str) -> DataFrame:
    """Document keys written per split as Parquet, as CSV and as JSON lines: rows of each split in each form."""
    root = folder(spark)
    rows = table(spark, d, "documents").select("doc_id", "source", "lang", F.col("source").alias("split_key"))
    write_parquet(rows, f"{root}/parquet", partition_by=["split_key"], rows_per_shard=100)
    write_csv(rows.drop("split_key"), f"{root}/csv")
    write_json(rows.drop("split_key"), f"{root}/json")
    kind = "doc_id long, source string, lang string"
    forms = {
        "parquet": spark.read.parquet(f"{root}/parquet").select("doc_id", "source", "lang"),
        "csv": spark.read.schema(kind).option("header", "true").csv(f"{root}/csv"),
        "json": spark.read.schema(kind).json(f"{root}/json"),
    }
    out = None
    for name, read in forms.items():
        counted = read.groupBy("source", "lang").agg(F.count("*").alias("rows"), F.sum("doc_id").alias("ids"))
        counted = counted.withColumn("form", F.lit(name))
        out = counted if out is None else out.unionByName(counted)
    return out


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file where Spark keeps its own."""
    file = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = file.getFileSystem(spark._jsc.hadoopConfiguration()).create(file)
    out.write(bytearray(text.encode()))
    out.close()


def listed(spark: SparkSession, root: str) -> DataFrame:
    """Parquet files below ``root`` with their folder and name."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(root)
    return split_path(files.select(plain_path(F.col("path")).alias("path")))


def corrupt_shard_counts(spark: SparkSession, d: str) -> DataFrame:
    """Rows by folder of documents written by language, beside a file in each folder that isn't Parquet."""
    root = folder(spark)
    docs = table(spark, d, "documents").select("doc_id", "lang")
    docs.repartition(3, "doc_id").write.partitionBy("lang").parquet(root)
    for lang in ("de", "en", "es", "fr"):
        put_text(spark, f"{root}/lang={lang}/part-99999.parquet", "no footer")
    counted = count_shards(spark, listed(spark, root), root, "doc_id long", on_corrupt="zero")
    return counted.groupBy(F.regexp_extract("directory", "lang=(.*)$", 1).alias("lang")).agg(
        F.sum("rows").alias("rows"), F.count_if(F.endswith("path", F.lit("part-99999.parquet")) & (F.col("rows") == 0)).alias("unreadable")
    )


def sidecar_splits(spark: SparkSession, d: str) -> DataFrame:
    """Splits found below a folder with the sidecar beside their shards, above them, broken, or none."""
    root = plain_root(folder(spark))
    rows = table(spark, d, "embeddings").selectExpr("vec_id", "embedding AS embeddings", "label")
    labels = sorted(r[0] for r in rows.select("label").distinct().collect())
    for label in labels:
        place = f"{root}/vectors/{label}/embeddings"
        rows.where(F.col("label") == label).drop("label").coalesce(2).write.parquet(place)
        if label % 4 < 3:
            text = f'{{"dim": {label}, "model": "m{label}"}}' if label % 4 < 2 else "{broken"
            put_text(spark, f"{root}/vectors/{label}/metadata.json", text)
    paths = listed(spark, root).select(F.lit(root).alias("root"), "path")
    splits = with_sidecars(summarise_splits(discover_splits(paths)), read_sidecars(spark, root, StructType.fromDDL("dim long, model string")))
    return splits.select("dataset_key", "sub_label", "metadata.dim", "metadata.model")


def catalog_export(spark: SparkSession, d: str) -> DataFrame:
    """The catalog written as JSON and as TSV, read back, by form; TSV can't tell an empty name from none."""
    root = folder(spark)
    cat = full_catalog(spark, d)
    export_catalog(cat, f"{root}/json", "json")
    export_catalog(cat, f"{root}/tsv", "tsv")
    kind = cat.select(*EXPORT_COLUMNS).schema
    forms = {
        "json": spark.read.schema(kind).json(f"{root}/json"),
        "tsv": spark.read.schema(kind).option("header", "true").option("sep", "\t").csv(f"{root}/tsv"),
    }
    named = [read.withColumn("form", F.lit(form)) for form, read in forms.items()]
    return named[0].unionByName(named[1]).withColumn("hf_name", F.coalesce("hf_name", F.lit("")))


def embed_failures(spark: SparkSession, d: str) -> DataFrame:
    """The embed run where one dataset's folder holds no Parquet: which datasets are done, failed and timed."""
    root = folder(spark)
    docs = table(spark, d, "documents").select("doc_id", "text", "lang")
    docs.where("lang <> 'fr'").write.partitionBy("lang").parquet(f"{root}/in")
    put_text(spark, f"{root}/in/lang=fr/part-00000.parquet", "no footer")
    cat = docs.select(F.col("lang").alias("key")).distinct().select(
        "key",
        F.concat(F.lit(f"{root}/in/lang="), "key").alias("preprocessed"),
        F.concat(F.lit(f"{root}/out/lang="), "key").alias("embeddings_out"),
        F.lit(1).cast("long").alias("shards"),
    )
    report = run_all(cat, f"{root}/records", EmbedSettings(key="doc_id", dim=8))
    timed = read_records(spark, f"{root}/records", RECORD_SCHEMA).select(
        F.col("dataset_key").alias("key"), "num_documents", (F.col("time_taken_s") > 0).alias("timed")
    )
    return report.join(timed, "key", "left").select(
        F.col("key").alias("dataset_key"), "ok", F.col("error").isNotNull().alias("has_error"), "num_documents", "timed"
    )


def quarantined_splits(spark: SparkSession, d: str) -> DataFrame:
    """A reduce run over folders where one split has a shard that can't be read and one a vector that isn't finite."""
    root = plain_root(folder(spark))
    poison = F.expr("if(label = 3 AND vec_id % 7 = 1, transform(embedding, x -> float('NaN')), embedding)")
    rows = table(spark, d, "embeddings").select("vec_id", poison.alias("embeddings"), "label")
    for label in sorted(r[0] for r in rows.select("label").distinct().collect()):
        place = f"{root}/in/vectors/{label}/embeddings"
        rows.where(F.col("label") == label).drop("label").coalesce(2).write.parquet(place)
    put_text(spark, f"{root}/in/vectors/5/embeddings/part-99999.parquet", "no footer")
    paths = listed(spark, f"{root}/in").select(F.lit(f"{root}/in").alias("root"), "path")
    vectors, unread = read_vectors(spark, discover_splits(paths).withColumn("file_name", F.element_at(F.split("path", "/"), -1)),
                                   f"{root}/in", "vec_id long, embeddings array<float>")
    labels = label_splits(vectors.select(*SPLIT).distinct(), configured(spark, d))
    settings = ReduceSettings(iterations=4, epochs=4, tsne_3d=False)
    report = run_reduce(vectors, labels, "vec_id", f"{root}/out", settings, csv=False, unread=unread)
    written = spark.read.parquet(f"{root}/out/reduced").groupBy(*SPLIT).agg(F.count("*").alias("rows"))
    return report.join(written, list(SPLIT), "left").select(
        *SPLIT, "done", F.regexp_replace("error", ": .*", "").alias("error"), "rows"
    )


def plain_root(path: str) -> str:
    return re.sub("^file:/+", "file:/", path if ":" in path else f"file:{path}")


QUERIES = {
    "corrupt_shard_counts": Query(
        corrupt_shard_counts, "SELECT lang, count(*) AS rows, 1 AS unreadable FROM documents GROUP BY lang"
    ),
    "sidecar_splits": Query(
        sidecar_splits,
        """SELECT DISTINCT 'vectors' AS dataset_key, CAST(label AS VARCHAR) AS sub_label,
       CASE WHEN label % 4 < 2 THEN label END AS dim, CASE WHEN label % 4 < 2 THEN 'm' || label END AS model FROM embeddings""",
    ),
    "catalog_export": Query(
        catalog_export,
        f"WITH {CATALOG_SQL} SELECT * REPLACE (coalesce(hf_name, '') AS hf_name) FROM (SELECT {EXPORT_SQL}, form FROM catalog, (VALUES ('json'), ('tsv')) f(form))",
    ),
    "embed_failures": Query(
        embed_failures,
        """SELECT lang AS dataset_key, lang <> 'fr' AS ok, lang = 'fr' AS has_error,
       CASE WHEN lang <> 'fr' THEN count(*) END AS num_documents, CASE WHEN lang <> 'fr' THEN true END AS timed
FROM documents GROUP BY lang""",
    ),
    "quarantined_splits": Query(
        quarantined_splits,
        """SELECT 'vectors' AS dataset_key, CAST(label AS VARCHAR) AS sub_label, label NOT IN (3, 5) AS done,
       CASE label WHEN 3 THEN 'vectors are ragged, empty, null or not finite' WHEN 5 THEN 'a shard can''t be read or is empty' END AS error,
       CASE WHEN label NOT IN (3, 5) THEN count(*) END AS rows
FROM embeddings GROUP BY label""",
    ),
    "preprocess_folders": Query(
        preprocess_folders,
        f"""WITH {CONTENT_SQL}, {META_SQL}, {CLEAN_SQL}
SELECT c.text, c.doc_id, {ENRICH_COLUMNS_SQL}, true AS from_shard
FROM clean c LEFT JOIN meta m ON c.doc_id = m.doc_id""",
    ),
    "embed_folders": Query(
        embed_folders,
        """SELECT lang AS dataset_key, true AS ok, 'hashing' AS model_id, CAST(16 AS INTEGER) AS embedding_dim,
       count(*) AS num_documents, count(*) AS vectors, CAST(16 AS INTEGER) AS width
FROM documents GROUP BY lang""",
    ),
    "written_and_read": Query(
        written_and_read,
        """SELECT source, lang, count(*) AS rows, CAST(sum(doc_id) AS BIGINT) AS ids, form
FROM documents, (VALUES ('parquet'), ('csv'), ('json')) f(form) GROUP BY source, lang, form""",
    ),
}
