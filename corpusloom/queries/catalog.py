"""Catalog queries. Shard paths, datasets and the registry are derived from the
document, label and nation tables, so every listing grows with the data:
a dataset is ``source/lang``, a shard holds the documents of one length class."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import paths as PT
from corpusloom.queries import Query, table
from corpusloom.sources import catalog as C
from corpusloom.sources import registry as R
from corpusloom.sources import shards as S
from corpusloom.sources import splits as SP

ROOT = "/corpus"
CENTRAL = "/vectors"
DIM = 4096


def document_paths(spark: SparkSession, d: str) -> DataFrame:
    """Every document with the path of the shard that holds it."""
    return (
        table(spark, d, "documents")
        .select("source", "lang", "n_chars")
        .selectExpr(
            "concat(source, '/', lang) AS key",
            "concat('/corpus/', source, '/', lang, '/preprocessed') AS directory",
            """CASE WHEN lang = 'en' THEN concat('part-', lpad(cast(n_chars % 9 AS string), 5, '0'), '.parquet')
                    WHEN lang = 'de' THEN concat('part_', cast(n_chars % 9 AS string), '_of_9.parquet')
                    WHEN lang = 'fr' AND n_chars % 9 = 0 THEN '.part-00000.parquet'
                    WHEN lang = 'fr' THEN concat('chunk_', cast(n_chars % 9 AS string), '.parquet')
                    WHEN n_chars % 2 = 0 THEN concat('part-', cast(n_chars % 9 AS string), '-of-9.parquet')
                    ELSE concat('extra_', cast(n_chars % 9 AS string), '.parquet') END AS file_name""",
        )
        .withColumn("path", F.concat_ws("/", "directory", "file_name"))
    )


def listing(spark: SparkSession, d: str) -> DataFrame:
    return document_paths(spark, d).select("key", "directory", "file_name", "path").distinct()


def shard_rows(spark: SparkSession, d: str) -> DataFrame:
    """Listed shards with their row counts: the inventory joined to the listing."""
    counts = S.shard_inventory(document_paths(spark, d), F.col("path"))
    return S.shard_filter(listing(spark, d), "embed").join(counts, "path")


def configured(spark: SparkSession, d: str) -> DataFrame:
    """Registry: datasets with a good-quality document, and one absent dataset per nation."""
    good = table(spark, d, "labels").filter("quality = 1").select("doc_id")
    known = (
        table(spark, d, "documents")
        .select("doc_id", "source", "lang")
        .join(good, "doc_id", "left_semi")
        .selectExpr("concat(source, '/', lang) AS key")
        .distinct()
        .selectExpr(
            "key",
            "concat('hub/', key) AS hf_name",
            "'pretraining' AS category",
            "'parquet' AS format",
            "array('metadata', 'content') AS hf_configs",
            "'doc_id' AS join_key",
            "'text' AS text_field",
            "array('quality', 'toxic') AS metadata_fields",
            """named_struct('fields', array('text', 'lang'), 'template', 'raw_text',
                            'description', '', 'preprocessing', 'strip') AS text_strategy""",
        )
    )
    absent = table(spark, d, "nation").selectExpr(
        "lower(n_name) AS key",
        "cast(NULL AS string) AS hf_name",
        "'post-training' AS category",
        "'jsonl' AS format",
        "cast(NULL AS array<string>) AS hf_configs",
        "cast(NULL AS string) AS join_key",
        "'text' AS text_field",
        "cast(NULL AS array<string>) AS metadata_fields",
        """cast(NULL AS struct<fields: array<string>, template: string, description: string,
                               preprocessing: string>) AS text_strategy""",
    )
    return known.unionByName(absent)


def full_catalog(spark: SparkSession, d: str) -> DataFrame:
    return C.catalog(
        configured(spark, d), C.dataset_inventory(shard_rows(spark, d), F.col("key")), ROOT, central=CENTRAL
    )


PATHS_SQL = """
document_paths AS (
  SELECT source || '/' || lang AS key,
         '/corpus/' || source || '/' || lang || '/preprocessed' AS directory,
         CASE WHEN lang = 'en' THEN 'part-' || lpad(CAST(n_chars % 9 AS VARCHAR), 5, '0') || '.parquet'
              WHEN lang = 'de' THEN 'part_' || CAST(n_chars % 9 AS VARCHAR) || '_of_9.parquet'
              WHEN lang = 'fr' AND n_chars % 9 = 0 THEN '.part-00000.parquet'
              WHEN lang = 'fr' THEN 'chunk_' || CAST(n_chars % 9 AS VARCHAR) || '.parquet'
              WHEN n_chars % 2 = 0 THEN 'part-' || CAST(n_chars % 9 AS VARCHAR) || '-of-9.parquet'
              ELSE 'extra_' || CAST(n_chars % 9 AS VARCHAR) || '.parquet' END AS file_name
  FROM documents
),
inventory AS (
  SELECT key, directory, file_name, directory || '/' || file_name AS path, count(*) AS rows
  FROM document_paths GROUP BY ALL
)"""
LISTED_SQL = (
    PATHS_SQL
    + """,
visible AS (
  SELECT *, (file_name LIKE 'part-%.parquet' OR regexp_matches(file_name, '^part_.*_of_.*\\.parquet$')) AS hit
  FROM inventory WHERE file_name NOT LIKE '.%'
),
listed AS (
  SELECT key, directory, file_name, path, rows
  FROM visible v
  WHERE hit OR NOT EXISTS (SELECT 1 FROM visible o WHERE o.directory = v.directory AND o.hit)
)"""
)
REGISTRY_SQL = """
configured AS (
  SELECT DISTINCT d.source || '/' || d.lang AS key, 'hub/' || d.source || '/' || d.lang AS hf_name,
         'pretraining' AS category, 'parquet' AS format, 'doc_id' AS join_key, 'text' AS text_field,
         'quality,toxic' AS metadata_fields, 'raw_text' AS template, '["text","lang"]' AS fields
  FROM documents d WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality = 1)
  UNION ALL
  SELECT lower(n_name), NULL, 'post-training', 'jsonl', NULL, 'text', NULL, NULL, NULL FROM nation
)"""
CATALOG_SQL = (
    LISTED_SQL
    + ","
    + REGISTRY_SQL
    + """,
datasets AS (
  SELECT key, CAST(sum(rows) AS BIGINT) AS rows, count(*) AS shards FROM listed GROUP BY key
),
catalog AS (
  SELECT coalesce(c.key, s.key) AS key,
         c.key IS NOT NULL AS in_config,
         CASE WHEN s.shards > 0 AND c.key IS NOT NULL THEN 'ready'
              WHEN s.shards > 0 THEN 'disk_only_ready' ELSE 'missing_preprocessed' END AS status,
         coalesce(s.rows, 0) AS rows, coalesce(s.shards, 0) AS shards,
         coalesce(c.hf_name, '') AS hf_name,
         '/corpus/' || coalesce(c.key, s.key) || '/preprocessed' AS preprocessed,
         '/vectors/' || coalesce(c.key, s.key) AS embeddings_out,
         s.key IS NOT NULL AS on_disk
  FROM configured c FULL OUTER JOIN datasets s ON c.key = s.key
)"""
)


def registry_lookup(spark: SparkSession, d: str) -> DataFrame:
    return R.usable_datasets(configured(spark, d)).select(
        "key",
        "hf_name",
        "category",
        "format",
        "join_key",
        "text_field",
        F.array_join("metadata_fields", ",").alias("metadata_fields"),
        F.col("text_strategy.template").alias("template"),
        F.to_json("text_strategy.fields").alias("fields"),
    )


def column_scan(spark: SparkSession, d: str) -> DataFrame:
    return S.scan_shards(spark, f"{d}/documents.parquet", ["doc_id", "text"])


def shard_inventory(spark: SparkSession, d: str) -> DataFrame:
    return S.shard_inventory(document_paths(spark, d), F.col("path"))


def dataset_inventory(spark: SparkSession, d: str) -> DataFrame:
    return C.dataset_inventory(shard_rows(spark, d), F.col("key"))


def shard_listing(spark: SparkSession, d: str) -> DataFrame:
    return S.shard_filter(listing(spark, d), "embed").select("directory", "file_name")


def shard_listing_reduce(spark: SparkSession, d: str) -> DataFrame:
    return S.shard_filter(listing(spark, d), "reduce").select("directory", "file_name")


def first_n_shards(spark: SparkSession, d: str) -> DataFrame:
    return S.limit_shards(S.shard_filter(listing(spark, d), "embed"), 3).select("directory", "file_name")


def canonical_names(spark: SparkSession, d: str) -> DataFrame:
    return S.canonical_names(listing(spark, d))


def dataset_catalog(spark: SparkSession, d: str) -> DataFrame:
    return C.sorted_catalog(full_catalog(spark, d)).select(*C.EXPORT_COLUMNS)


def catalog_summary(spark: SparkSession, d: str) -> DataFrame:
    return C.catalog_summary(full_catalog(spark, d))


def embed_candidates(spark: SparkSession, d: str) -> DataFrame:
    return C.candidates(full_catalog(spark, d)).select("key", "rows", "shards", "status")


def wanted_keys(spark: SparkSession, d: str) -> DataFrame:
    """Every dataset with a toxic document, every nation, and one unknown key per region."""
    toxic = table(spark, d, "labels").filter("toxic = 1").select("doc_id")
    datasets = (
        table(spark, d, "documents")
        .join(toxic, "doc_id", "left_semi")
        .selectExpr("concat(source, '/', lang) AS key")
    )
    nations = table(spark, d, "nation").selectExpr("lower(n_name) AS key")
    unknown = table(spark, d, "region").selectExpr("concat('region/', lower(r_name)) AS key")
    return datasets.union(nations).union(unknown).distinct()


WANTED_SQL = """
wanted AS (
  SELECT d.source || '/' || d.lang AS key FROM documents d
  WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.toxic = 1)
  UNION SELECT lower(n_name) FROM nation
  UNION SELECT 'region/' || lower(r_name) FROM region
)"""


def select_exact(spark: SparkSession, d: str) -> DataFrame:
    return C.select_datasets(full_catalog(spark, d), exact=wanted_keys(spark, d)).select("key", "status")


def select_prefix(spark: SparkSession, d: str) -> DataFrame:
    return C.select_datasets(full_catalog(spark, d), prefix="src1").select("key", "status")


def select_contains(spark: SparkSession, d: str) -> DataFrame:
    return C.select_datasets(full_catalog(spark, d), contains=["RC1/F", "an"]).select("key", "status")


def missing_selection(spark: SparkSession, d: str) -> DataFrame:
    return C.missing_keys(full_catalog(spark, d), wanted_keys(spark, d))


def strict_selection(spark: SparkSession, d: str) -> DataFrame:
    cat = full_catalog(spark, d)
    present = C.candidates(C.select_datasets(cat, exact=wanted_keys(spark, d)))
    return C.select_wanted(cat, present).select("key", "rows")


def split_paths(spark: SparkSession, d: str) -> DataFrame:
    """Nested embedding folders of every dataset, and one flat root per source."""
    nested = document_paths(spark, d).select(
        F.lit("/emb").alias("root"), F.concat_ws("/", F.lit("/emb"), "key", F.lit("embeddings"), "file_name").alias("path")
    )
    stray = document_paths(spark, d).select(
        F.lit("/emb").alias("root"), F.concat_ws("/", F.lit("/emb"), "key", "file_name").alias("path")
    )
    flat_root = F.concat_ws("/", F.lit("/flat"), F.substring_index("key", "/", 1), F.lit("embedding"))
    flat = document_paths(spark, d).select(
        flat_root.alias("root"), F.concat_ws("/", flat_root, "file_name").alias("path")
    )
    return nested.union(stray).union(flat)


SPLITS_SQL = (
    PATHS_SQL
    + """,
split_paths AS (
  SELECT '/emb' AS root, split_part(key, '/', 1) AS dataset_key, split_part(key, '/', 2) AS sub_label,
         '/emb/' || key || '/embeddings' AS embedding_dir, file_name FROM document_paths
  UNION
  SELECT '/flat/' || split_part(key, '/', 1) || '/embedding', split_part(key, '/', 1), 'embedding',
         '/flat/' || split_part(key, '/', 1) || '/embedding', file_name FROM document_paths
),
splits AS (
  SELECT *, embedding_dir || '/' || file_name AS path FROM split_paths
  WHERE file_name LIKE 'part-%.parquet' OR file_name LIKE 'part\\_%.parquet' ESCAPE '\\'
)"""
)


def discover_splits(spark: SparkSession, d: str) -> DataFrame:
    return SP.discover_splits(split_paths(spark, d))


def split_summary(spark: SparkSession, d: str) -> DataFrame:
    return SP.summarise_splits(SP.discover_splits(split_paths(spark, d)))


def label_splits(spark: SparkSession, d: str) -> DataFrame:
    """Splits named after registry keys where one exists: dataset_key = source/lang."""
    splits = SP.summarise_splits(SP.discover_splits(split_paths(spark, d))).withColumn(
        "dataset_key", F.concat_ws("/", "dataset_key", "sub_label")
    )
    return SP.label_splits(splits, configured(spark, d)).drop("embedding_dir")


def url_paths(spark: SparkSession, d: str) -> DataFrame:
    """Half the pages get a repository URL, the others keep their own."""
    repo = F.substring_index(F.substring_index("url", "/", 3), "/", -1)
    rel = F.concat(F.lit("content/"), F.col("page_id").cast("string"), F.lit(".parquet"))
    return (
        table(spark, d, "pages")
        .select("page_id", "url")
        .withColumn("shard_url", PT.shard_url("https://host/datasets", repo, rel))
        .withColumn("rel_path", PT.relative_to_marker(F.col("shard_url")))
        .withColumn("last_piece", PT.relative_to_marker(F.col("url")))
    )


def pending_datasets(spark: SparkSession, d: str) -> DataFrame:
    """Datasets with a toxic document count as finished."""
    return C.pending(C.candidates(full_catalog(spark, d)), wanted_keys(spark, d)).select("key", "rows")


def embed_estimate(spark: SparkSession, d: str) -> DataFrame:
    return C.estimate(C.candidates(full_catalog(spark, d)), DIM)


def output_paths(spark: SparkSession, d: str) -> DataFrame:
    """Routing: English has an override, German a blank one, French a central root, Spanish none."""
    docs = table(spark, d, "documents").select("source", "lang").distinct()
    override = F.when(F.col("lang") == "en", F.lit(" /fast ")).when(F.col("lang") == "de", F.lit("  "))
    central = F.when(F.col("lang").isin("en", "fr"), F.lit("/vectors")).when(F.col("lang") == "de", F.lit(""))
    return docs.select(
        "source", "lang", PT.embedding_path("/corpus", F.col("source"), override, central).alias("embeddings_out")
    )


EXPORT_SQL = "key, in_config, status, rows, shards, hf_name, preprocessed, embeddings_out"

QUERIES = {
    "registry_lookup": Query(
        registry_lookup, f"WITH {REGISTRY_SQL} SELECT * FROM configured WHERE format = 'parquet'"
    ),
    "column_scan": Query(column_scan, "SELECT doc_id, text FROM documents"),
    "shard_inventory": Query(shard_inventory, f"WITH {PATHS_SQL} SELECT path, rows FROM inventory"),
    "dataset_inventory": Query(
        dataset_inventory,
        f"""WITH {LISTED_SQL}
SELECT key, CAST(sum(rows) AS BIGINT) AS rows, count(*) AS shards FROM listed GROUP BY key""",
    ),
    "shard_listing": Query(shard_listing, f"WITH {LISTED_SQL} SELECT directory, file_name FROM listed"),
    "shard_listing_reduce": Query(
        shard_listing_reduce,
        f"""WITH {PATHS_SQL} SELECT directory, file_name FROM inventory
WHERE regexp_matches(file_name, '^part[-_].*\\.parquet$')""",
    ),
    "first_n_shards": Query(
        first_n_shards,
        f"""WITH {LISTED_SQL}
SELECT directory, file_name FROM listed
QUALIFY row_number() OVER (PARTITION BY directory ORDER BY file_name) <= 3""",
    ),
    "canonical_names": Query(
        canonical_names,
        f"""WITH {PATHS_SQL}, ranked AS (
  SELECT directory, file_name AS old_name,
         row_number() OVER (PARTITION BY directory ORDER BY file_name) - 1 AS i,
         count(*) OVER (PARTITION BY directory) AS n
  FROM inventory WHERE file_name NOT LIKE '.%'
)
SELECT directory, old_name, printf('part-%05d-of-%05d.parquet', i, n) AS new_name,
       old_name <> printf('part-%05d-of-%05d.parquet', i, n) AS renamed
FROM ranked""",
    ),
    "dataset_catalog": Query(dataset_catalog, f"WITH {CATALOG_SQL} SELECT {EXPORT_SQL} FROM catalog"),
    "catalog_summary": Query(
        catalog_summary,
        f"""WITH {CATALOG_SQL}
SELECT count(*) AS total, count(*) FILTER (status IN ('ready', 'disk_only_ready')) AS embed_ready,
       count(*) FILTER (status = 'missing_preprocessed') AS missing FROM catalog""",
    ),
    "embed_candidates": Query(
        embed_candidates, f"WITH {CATALOG_SQL} SELECT key, rows, shards, status FROM catalog WHERE shards > 0"
    ),
    "select_exact": Query(
        select_exact,
        f"WITH {CATALOG_SQL}, {WANTED_SQL} SELECT key, status FROM catalog WHERE key IN (SELECT key FROM wanted)",
    ),
    "select_prefix": Query(
        select_prefix,
        f"WITH {CATALOG_SQL} SELECT key, status FROM catalog WHERE key = 'src1' OR key LIKE 'src1/%'",
    ),
    "select_contains": Query(
        select_contains,
        f"""WITH {CATALOG_SQL} SELECT key, status FROM catalog
WHERE contains(lower(key), 'rc1/f') OR contains(lower(key), 'an')""",
    ),
    "missing_selection": Query(
        missing_selection,
        f"""WITH {CATALOG_SQL}, {WANTED_SQL}
SELECT w.key, CASE WHEN NOT coalesce(c.on_disk, false) THEN 'no dataset directory'
                   WHEN c.shards = 0 THEN 'no preprocessed shards' ELSE 'not selectable' END AS reason
FROM wanted w LEFT JOIN catalog c ON w.key = c.key
WHERE w.key NOT IN (SELECT key FROM catalog WHERE shards > 0)""",
    ),
    "strict_selection": Query(
        strict_selection,
        f"""WITH {CATALOG_SQL}, {WANTED_SQL}
SELECT key, rows FROM catalog WHERE shards > 0 AND key IN (SELECT key FROM wanted)""",
    ),
    "discover_splits": Query(
        discover_splits,
        f"WITH {SPLITS_SQL} SELECT root, dataset_key, sub_label, embedding_dir, path FROM splits",
    ),
    "split_summary": Query(
        split_summary,
        f"""WITH {SPLITS_SQL}
SELECT root, dataset_key, sub_label, embedding_dir, count(*) AS files FROM splits GROUP BY ALL""",
    ),
    "label_splits": Query(
        label_splits,
        f"""WITH {SPLITS_SQL}, {REGISTRY_SQL}, s AS (
  SELECT root, dataset_key || '/' || sub_label AS dataset_key, sub_label, count(*) AS files
  FROM splits GROUP BY ALL
)
SELECT s.*, coalesce(c.hf_name, s.dataset_key) AS dataset_name, coalesce(c.category, 'unknown') AS category,
       coalesce(c.template, 'unknown') AS text_strategy_template, coalesce(c.fields, '[]') AS text_strategy_fields
FROM s LEFT JOIN configured c ON s.dataset_key = c.key""",
    ),
    "url_paths": Query(
        url_paths,
        """SELECT page_id, url,
       'https://host/datasets/' || split_part(url, '/', 3) || '/resolve/main/content/' || page_id || '.parquet'
         AS shard_url,
       'content/' || page_id || '.parquet' AS rel_path,
       split_part(url, '/', -1) AS last_piece
FROM pages""",
    ),
    "pending_datasets": Query(
        pending_datasets,
        f"""WITH {CATALOG_SQL}, {WANTED_SQL}
SELECT key, rows FROM catalog WHERE shards > 0 AND key NOT IN (SELECT key FROM wanted)""",
    ),
    "embed_estimate": Query(
        embed_estimate,
        f"""WITH {CATALOG_SQL}
SELECT CAST(sum(rows) AS BIGINT) AS total_rows, CAST(sum(rows) AS BIGINT) * 4096 * 4 / 1e9::DOUBLE AS estimated_gb
FROM catalog WHERE shards > 0""",
    ),
    "output_paths": Query(
        output_paths,
        """SELECT DISTINCT source, lang,
       CASE lang WHEN 'en' THEN '/fast/' || source WHEN 'fr' THEN '/vectors/' || source
                 ELSE '/corpus/' || source || '/embedding' END AS embeddings_out
FROM documents""",
    ),
}
