"""The registered queries of this package: each operator over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_model(name: str = "piece_bpe_32k.model") -> bytes:
    """Content of a public tokenizer's file; half a megabyte, so it may travel with the tasks."""
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as f:
        return f.read()


def op1_chat_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpusloom.llm.chat_layouts import format_chats, loss_texts, parse_chat

    control = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-7, [("user", control), ("assistant", control)])],
        "conv_id long, messages array<struct<role: string, content: string>>",
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    chats = format_chats(rows.unionByName(extra, allowMissingColumns=True))
    turns, loss = parse_chat(F.col("formatted")), F.array_join(loss_texts(F.col("formatted"), F.col("loss_spans")), "")
    read = chats.select("conv_id", "formatted", turns.alias("turns"), loss.alias("loss"))
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op2_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpusloom.llm.suffix_tree import score_documents

    return score_documents(table(spark, sf_dir, "documents"))


def op3_piece_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpusloom.llm.piece_table import encode_texts

    coded = encode_texts(table(spark, sf_dir, "documents"), tokenizer_model())
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


def op4_hash_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpusloom.llm.hash_mix import mix

    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op5_voronoi_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpusloom.llm.voronoi_knn import top_products

    return top_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op6_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpusloom.llm.pu_quality import score_documents

    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_text_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpusloom.llm.text_density import extract_main_text

    return extract_main_text(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op8_chunk_prints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpusloom.llm.chunk_prints import fingerprint_texts, with_successor

    docs = with_successor(table(spark, sf_dir, "documents"))
    n = F.length("text")
    moved = F.floor(n / 4).cast("int")
    docs = docs.select(
        F.struct("doc_id", n.cast("long").alias("n_chars")).alias("key"),
        "text",
        F.concat(F.substring("text", F.lit(1), n - moved), F.substring("next_text", F.lit(1), moved)).alias("edited"),
        F.col("next_text").alias("next"),
    )
    docs = docs.withColumn("key", F.col("key").withField("edited_sha256", F.sha2("edited", 256)))
    printed = fingerprint_texts(docs, "key", "text", ["edited", "next"])
    return printed.select("key.*", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def op9_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpusloom.llm.lsh_forest import similarity_classes

    return similarity_classes(table(spark, sf_dir, "documents"))


URL_RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)


def op10_url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpusloom.llm.url_verdicts import judge_urls

    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op11_swap_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpusloom.llm.swap_packing import pack_documents

    tokenizer = tokenizer_model("word_bpe_49k.json").decode()
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer)


def op12_spelling_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpusloom.llm.spelling_blocks import spelling_groups

    return spelling_groups(table(spark, sf_dir, "documents"))


def op13_bag_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpusloom.llm.bag_search import search

    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_chat_layouts": op1_chat_layouts,
    "op2_suffix_tree": op2_suffix_tree,
    "op3_piece_table": op3_piece_table,
    "op4_hash_mix": op4_hash_mix,
    "op5_voronoi_knn": op5_voronoi_knn,
    "op6_pu_quality": op6_pu_quality,
    "op7_text_density": op7_text_density,
    "op8_chunk_prints": op8_chunk_prints,
    "op9_lsh_forest": op9_lsh_forest,
    "op10_url_verdicts": op10_url_verdicts,
    "op11_swap_packing": op11_swap_packing,
    "op12_spelling_blocks": op12_spelling_blocks,
    "op13_bag_search": op13_bag_search,
}

_WORDS = r"[^\x20\x09-\x0D]+"

ORACLES: dict[str, str] = {
    "op1_chat_layouts": r"""
WITH raw AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
),
t AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n,
         length(text) + (length(text) - length(replace(text, '\', '')))
           + len(regexp_extract_all(text, '\[/?INST\]|</?s>|<</?SYS>>|\[AS\]|\[/?TEXT\]')) AS body,
         CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 9 WHEN 'system' THEN 17 ELSE 21 + length(role) END AS marks
  FROM raw
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(body + marks + 1) - 1 AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
""",
    "op4_hash_mix": rf"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '{_WORDS}')), 0) AS BIGINT) AS size FROM documents
),
h AS (
  SELECT *, CAST('0x' || md5(coalesce(CAST(doc_id AS VARCHAR), '~') || '|' || coalesce(source, '~') || '|' || size)[1:15]
                 AS BIGINT) AS h
  FROM d
),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM h GROUP BY source
),
r AS (
  SELECT *, 2 * source_size AS most, sum(source_size) OVER () * CAST(1.5 AS DOUBLE) AS budget,
         row_number() OVER (ORDER BY CAST(2 * source_size AS DOUBLE) / weight, source NULLS LAST) AS k
  FROM s
),
q AS (
  SELECT *, (budget - coalesce(sum(most) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rate
  FROM r
),
g AS (
  SELECT source, source_size,
         CASE WHEN most <= rate * weight THEN CAST(most AS DOUBLE)
              ELSE least((max(rate) FILTER (most > rate * weight) OVER ()) * weight, CAST(most AS DOUBLE)) END AS target
  FROM q
),
p AS (
  SELECT h.doc_id, h.source, h.h, h.size, source_size, target, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole,
         target - whole * source_size AS budget
  FROM h JOIN g ON h.source IS NOT DISTINCT FROM g.source
),
c AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS reached,
         sum(size) OVER (PARTITION BY source, h) AS tied
  FROM p
)
SELECT doc_id, size, source_size, target,
       CAST(size * (whole + CASE WHEN budget > 0 AND (reached < budget OR (reached - tied < budget AND reached - budget <= budget - reached + tied))
                                 THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM c
""",
    "op5_voronoi_knn": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 5
""",
    "op9_lsh_forest": rf"""
WITH RECURSIVE w AS (SELECT doc_id, coalesce(regexp_extract_all(text, '{_WORDS}'), []) AS ws FROM documents),
g AS (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
         ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END)) AS sh
  FROM w
),
k AS (SELECT min(doc_id) AS rep, count(*) AS copies, sh FROM g GROUP BY sh),
u AS (SELECT rep, len(sh) AS n, unnest(sh) AS s FROM k),
i AS (
  SELECT a.rep AS a, b.rep AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS c
  FROM u a JOIN u b ON a.s = b.s AND a.rep <> b.rep GROUP BY a.rep, b.rep
),
l AS (SELECT a, b FROM i WHERE 9 * c >= 4 * (na + nb)),
reach(a, b) AS (SELECT rep, rep FROM k UNION SELECT reach.a, l.b FROM reach JOIN l ON l.a = reach.b),
cls AS (SELECT a AS rep, min(b) AS class_id FROM reach GROUP BY a),
cnt AS (SELECT a AS rep, sum(k.copies) AS links FROM l JOIN k ON k.rep = l.b GROUP BY a)
SELECT g.doc_id, class_id, CAST(coalesce(links, 0) + copies - 1 AS BIGINT) AS n_links
FROM g JOIN k ON g.sh = k.sh JOIN cls ON cls.rep = k.rep LEFT JOIN cnt ON cnt.rep = k.rep
""",
    "op10_url_verdicts": r"""
WITH RECURSIVE p AS (
  SELECT page_id, url,
         lower(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's')) AS host,
         regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
  FROM pages
),
rules AS (
  SELECT * FROM (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'),
                        ('org', '/fr/', 'allow')) v(rule_host, rule_path, said)
),
nodes AS (
  SELECT url FROM p WHERE url IS NOT NULL UNION SELECT split_part(url, '#', 1) FROM p WHERE url IS NOT NULL
  UNION SELECT regexp_extract(html, 'rel="canonical" href="([^"]+)"', 1) FROM pages WHERE url IS NOT NULL
),
n AS (
  SELECT url, lower(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's')) AS host,
         regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
  FROM nodes
),
j AS (
  SELECT url, max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
         max_by(said, length(rule_host || rule_path)) AS said
  FROM n JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY url
),
e AS (
  SELECT url AS a, split_part(url, '#', 1) AS b FROM p WHERE url IS NOT NULL
  UNION ALL SELECT url, regexp_extract(html, 'rel="canonical" href="([^"]+)"', 1) FROM pages
            WHERE url IS NOT NULL AND regexp_matches(html, 'rel="canonical" href="[^"]')
),
sym AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
reach(url) AS (
  SELECT url FROM j WHERE said = 'block' UNION SELECT sym.b FROM reach JOIN sym ON sym.a = reach.url
)
SELECT page_id, host, path, rule,
       coalesce(said, CASE WHEN url IN (SELECT url FROM reach) THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN j USING (url)
""",
    "op13_bag_search": r"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
),
i AS (
  SELECT DISTINCT item_id,
         unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
),
a AS (SELECT count(*) FILTER (len(terms) > 0) AS nd, CAST(sum(len(terms)) AS BIGINT) AS l FROM d),
t AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(terms) AS term FROM d) GROUP BY ALL),
w AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * nd + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM t, a WHERE term IN (SELECT term FROM i) GROUP BY term, nd
),
v AS (
  SELECT row, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * len(terms) * nd) // l))) AS part
  FROM t JOIN w USING (term) JOIN d USING (row), a
),
s AS (SELECT item_id, doc_id, row, CAST(sum(part) AS BIGINT) AS score FROM i JOIN v USING (term) JOIN d USING (row) GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 50
""",
}
