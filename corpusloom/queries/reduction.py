"""Neighbour graph, edge weight and layout queries over the vector table.

Vectors are scaled by ``1 + vec_id % 7``: the given ones are unit length, which
would hide a mix-up of the two metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators import affinities as A
from corpusloom.operators import neighbors as N
from corpusloom.operators import sampling as SM
from corpusloom.operators.pca import pca_init as pca_start
from corpusloom.operators.pca import principal_axes
from corpusloom.operators.pruned import knn_pruned as pruned
from corpusloom.operators.tsne import no_layout, tsne_layout
from corpusloom.operators.umap import umap_layout
from corpusloom.plans import reduce_run as RR
from corpusloom.queries import Query, table
from corpusloom.session import cut_lineage, join_keys
from corpusloom.sources.splits import label_splits

K = 15
PERPLEXITY = 5


def vectors(spark: SparkSession, d: str, split: str = "'all'") -> DataFrame:
    return table(spark, d, "embeddings").selectExpr(
        f"{split} AS split",
        "vec_id AS row_id",
        "transform(embedding, x -> cast(x AS double) * (1 + vec_id % 7)) AS embeddings",
    )


def one_graph(spark: SparkSession, d: str, metric: str) -> DataFrame:
    return N.knn_exact(vectors(spark, d), K, metric, ("split",))


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.drop("split").withColumns({c: F.round(c, 6) for c in columns})


def knn_cosine(spark: SparkSession, d: str) -> DataFrame:
    return rounded(one_graph(spark, d, "cosine"), "distance")


def knn_euclidean(spark: SparkSession, d: str) -> DataFrame:
    return rounded(one_graph(spark, d, "euclidean"), "distance")


def knn_over_copies(spark: SparkSession, d: str) -> DataFrame:
    """Every vector three times under new ids: the graph of copies."""
    tripled = vectors(spark, d).withColumn("row_id", F.explode(F.expr("array(3 * row_id, 3 * row_id + 1, 3 * row_id + 2)")))
    return rounded(N.knn(tripled, K, "euclidean", split=("split",)), "distance")


def knn_ivf(spark: SparkSession, d: str) -> DataFrame:
    return rounded(N.knn(vectors(spark, d), K, "cosine", "ivf", ("split",)), "distance")


def knn_outlier(spark: SparkSession, d: str) -> DataFrame:
    """One vector a million times as long as the others, which must not blur their distances."""
    far = "CASE WHEN vec_id = 3 THEN 1e6D ELSE double(1 + vec_id % 7) END"
    rows = table(spark, d, "embeddings").selectExpr(
        "'all' AS split", "vec_id AS row_id", f"transform(embedding, x -> cast(x AS double) * {far}) AS embeddings"
    )
    return N.knn(rows, K, "euclidean", split=("split",)).drop("split").withColumn("distance", F.round("distance", 3))


def knn_exact_default(spark: SparkSession, d: str) -> DataFrame:
    """As many neighbours as a t-SNE layout asks for."""
    return rounded(N.knn(vectors(spark, d), SM.MIN_TSNE_NEIGHBORS, "euclidean", split=("split",)), "distance")


def knn_ivf_all_probes(spark: SparkSession, d: str) -> DataFrame:
    return rounded(N.knn_ivf(vectors(spark, d), K, "cosine", ("split",), cells=12, probes=12), "distance")


def knn_ivf_complete(spark: SparkSession, d: str) -> DataFrame:
    """Length of each list of the approximate search, and whether its ranks are 1, 2, ... without a gap."""
    edges = N.knn(vectors(spark, d), SM.MIN_TSNE_NEIGHBORS, "cosine", "ivf", ("split",))
    return edges.groupBy("row_id").agg(
        F.count("*").alias("edges"),
        F.countDistinct("neighbor").alias("neighbors"),
        F.max("rank").cast("long").alias("last_rank"),
    )


# Rows of a cell of the pruned search, small enough to give the given tables several.
CELL_ROWS = 25


def clustered(spark: SparkSession, d: str) -> DataFrame:
    """The vectors drawn together around one corner for each label."""
    return table(spark, d, "embeddings").selectExpr(
        "'all' AS split",
        "vec_id AS row_id",
        "transform(embedding, (x, i) -> cast(x AS double) * 0.25D + if(i = label, 8D, 0D)) AS embeddings",
    )


def knn_pruned(spark: SparkSession, d: str) -> DataFrame:
    """Both metrics, over vectors with clusters and without."""
    tight = pruned(clustered(spark, d), K, "euclidean", ("split",), cell_rows=CELL_ROWS).edges.drop("split")
    loose = pruned(vectors(spark, d), K, "cosine", ("split",), cell_rows=CELL_ROWS).edges.drop("split")
    both = tight.withColumn("metric", F.lit("euclidean")).unionByName(loose.withColumn("metric", F.lit("cosine")))
    return both.withColumn("distance", F.round("distance", 6))


def knn_pruned_compared(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of clustered rows there are, and whether less than a third of them was compared."""
    report = pruned(clustered(spark, d), K, "euclidean", ("split",), cell_rows=CELL_ROWS).report
    return report.select("split", "pairs", (F.col("compared") * 3 < F.col("pairs")).alias("below_a_third"))


def knn_per_split(spark: SparkSession, d: str) -> DataFrame:
    by_label = vectors(spark, d, "cast(label AS string)")
    return N.knn_exact(by_label, K, "cosine", ("split",)).withColumn("distance", F.round("distance", 6))


def tsne_affinities(spark: SparkSession, d: str) -> DataFrame:
    return rounded(A.tsne_affinities(one_graph(spark, d, "euclidean"), PERPLEXITY, ("split",)), "p")


def tsne_symmetric(spark: SparkSession, d: str) -> DataFrame:
    p = A.tsne_affinities(one_graph(spark, d, "euclidean"), PERPLEXITY, ("split",))
    counts = vectors(spark, d).groupBy("split").agg(F.count(F.lit(1)).alias("rows"))
    joint = A.tsne_symmetrise(p, counts, ("split",))
    return joint.select("row_id", "neighbor", F.round("p", 9).alias("p"))


def umap_scales(spark: SparkSession, d: str) -> DataFrame:
    return rounded(A.umap_scales(one_graph(spark, d, "cosine"), ("split",)), "rho", "sigma")


def umap_memberships(spark: SparkSession, d: str) -> DataFrame:
    return rounded(A.umap_memberships(one_graph(spark, d, "cosine"), ("split",)), "w")


def fuzzy_union(spark: SparkSession, d: str) -> DataFrame:
    w = A.umap_memberships(one_graph(spark, d, "cosine"), ("split",))
    return rounded(A.fuzzy_union(w, ("split",)), "w")


# Layout queries run the operators' full rounds.
SETTINGS = RR.ReduceSettings()


def split_vectors(spark: SparkSession, d: str) -> DataFrame:
    """The vector table as ten splits of one dataset."""
    return table(spark, d, "embeddings").selectExpr(
        "'vectors' AS dataset_key", "cast(label AS string) AS sub_label", "vec_id", "embedding AS embeddings"
    )


def split_labels(spark: SparkSession, d: str) -> DataFrame:
    """Labels of the vector splits; the registry knows sources only, so defaults apply."""
    from corpusloom.queries.catalog import configured

    splits = split_vectors(spark, d).select("dataset_key", "sub_label").distinct()
    return label_splits(splits, configured(spark, d))


def points(spark: SparkSession, d: str) -> DataFrame:
    return RR.select_points(split_vectors(spark, d), "vec_id", SETTINGS)


def pca_init(spark: SparkSession, d: str) -> DataFrame:
    return pca_start(points(spark, d), 3)


def pca_axes(spark: SparkSession, d: str) -> DataFrame:
    """For each split and two axes: their product, and by how far their coordinates' covariance misses the axis's variance.

    Each vector is followed by its squares and cubes, so the axes take more than one round.
    """
    wide = F.expr("transform(embeddings, x -> cast(x AS double))")
    powers = [wide, F.transform(wide, lambda x: x * x), F.transform(wide, lambda x: x * x * x)]
    df = split_vectors(spark, d).select(*SM.SPLIT, F.col("vec_id").alias("row_id"), F.concat(*powers).alias("embeddings"))
    df = cut_lineage(df)
    axes = principal_axes(df, 3)
    rows = pca_start(df, 3)
    pairs = [(a, b) for a in range(3) for b in range(a, 3)]
    own = rows.groupBy(*SM.SPLIT).agg(*(F.covar_pop(f"y{a}", f"y{b}").alias(f"c{a}{b}") for a, b in pairs))
    both = join_keys(axes, own, list(SM.SPLIT))

    def line(a: int, b: int) -> Column:
        dot = F.aggregate(F.zip_with(F.col("axes")[a], F.col("axes")[b], lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
        off = (F.col(f"c{a}{b}") - (F.col("variance")[a] if a == b else F.lit(0.0))) / F.col("total")
        return F.struct(
            F.lit(a).alias("a"), F.lit(b).alias("b"),
            *((F.round(x, 6) + F.lit(0.0)).alias(name) for x, name in ((dot, "product"), (off, "missed"))),
        )

    found = both.select("sub_label", F.round("total", 6).alias("total"), F.explode(F.array(*(line(a, b) for a, b in pairs))).alias("p"))
    return found.select("sub_label", "total", "p.*")


def tsne_query(dims: int):
    def build(spark: SparkSession, d: str) -> DataFrame:
        chosen = points(spark, d)
        params = SM.reduction_params(SM.count_splits(chosen))
        near = N.knn(chosen, SM.MIN_TSNE_NEIGHBORS, "euclidean")
        p = A.tsne_affinities(near, F.col("perplexity"), params=params.select(*SM.SPLIT, "perplexity"))
        return tsne_layout(cut_lineage(A.tsne_symmetrise(p, params)), cut_lineage(pca_start(chosen, dims)), dims, SETTINGS.iterations)

    return build


def umap_query(dims: int):
    def build(spark: SparkSession, d: str) -> DataFrame:
        chosen = points(spark, d)
        fuzzy = A.fuzzy_union(A.umap_memberships(N.knn(chosen, SM.NEIGHBORS, "cosine")))
        return umap_layout(cut_lineage(fuzzy), cut_lineage(pca_start(chosen, dims)), dims, SETTINGS.epochs)

    return build


def reduce_full(spark: SparkSession, d: str) -> DataFrame:
    return RR.reduce(split_vectors(spark, d), split_labels(spark, d), "vec_id", SETTINGS)


def reduced_labels(spark: SparkSession, d: str) -> DataFrame:
    """The reduced table with every layout switched off: labels, numbers, NaN coordinates."""
    chosen = points(spark, d)
    bare = chosen.select(*SM.SPLIT, "row_id")
    off = {name: no_layout(bare, 3 if name.endswith("3d") else 2) for name in ("tsne_2d", "umap_2d", "tsne_3d", "umap_3d")}
    table_ = RR.assemble(chosen, split_labels(spark, d), off, extra=["vec_id"])
    all_nan = " AND ".join(f"isnan({c})" for c in RR.COORDINATE_COLUMNS)
    return table_.selectExpr(*RR.LABEL_COLUMNS, "row_id", "vec_id", f"{all_nan} AS no_coordinates")


def sampled_null_split(spark: SparkSession, d: str) -> DataFrame:
    """Sampling and numbering where one split's name is null."""
    rows = table(spark, d, "embeddings").selectExpr("nullif(label, 3) AS label", "vec_id")
    sampled = SM.sample_split(rows, "vec_id", 20, SM.SEED, ("label",))
    return SM.with_row_id(sampled, ("label",), ["vec_id"]).select("label", "vec_id", "row_id")


def reduced_unlabelled(spark: SparkSession, d: str) -> DataFrame:
    """The reduced table's labels where one split is named null and every second split has no label row."""
    rows = split_vectors(spark, d).withColumn("sub_label", F.expr("nullif(sub_label, '3')"))
    chosen = RR.select_points(rows, "vec_id", SETTINGS)
    bare = chosen.select(*SM.SPLIT, "row_id")
    off = {name: no_layout(bare, 3 if name.endswith("3d") else 2) for name in ("tsne_2d", "umap_2d", "tsne_3d", "umap_3d")}
    labels = split_labels(spark, d).filter("int(sub_label) % 2 = 0").withColumn("category", F.lit("even"))
    return RR.assemble(chosen, labels, off, extra=["vec_id"]).select(*RR.LABEL_COLUMNS, "row_id", "vec_id")


def reduction_record(spark: SparkSession, d: str) -> DataFrame:
    """Records of a reduction capped at 20 points per split."""
    capped = RR.ReduceSettings(cap=20)
    available = SM.count_splits(split_vectors(spark, d))
    record = RR.reduction_record(RR.select_points(split_vectors(spark, d), "vec_id", capped), available)
    return record.withColumn("columns_2d_3d", F.array_join("columns_2d_3d", ","))


def pending_splits(spark: SparkSession, d: str) -> DataFrame:
    """Splits of the document table; those of English and German count as done."""
    splits = table(spark, d, "documents").groupBy(
        F.col("source").alias("dataset_key"), F.col("lang").alias("sub_label")
    ).agg(F.count(F.lit(1)).alias("rows"))
    return RR.pending_splits(splits, splits.filter(F.col("sub_label").isin("en", "de")))


VEC_SQL = """
vec AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE) * (1 + vec_id % 7)) AS v FROM embeddings
)"""


def knn_sql(metric: str, per_split: bool = False, k: int = K) -> str:
    dist = "list_cosine_distance(a.v, b.v)" if metric == "cosine" else "list_distance(a.v, b.v)"
    same = "AND a.label = b.label" if per_split else ""
    return f"""{VEC_SQL},
knn AS (
  SELECT a.vec_id AS row_id, a.label, b.vec_id AS neighbor, {dist} AS distance,
         row_number() OVER (PARTITION BY a.vec_id ORDER BY {dist}, b.vec_id) AS rank
  FROM vec a JOIN vec b ON a.vec_id <> b.vec_id {same}
  QUALIFY rank <= {k}
),
near AS (
  SELECT row_id, list(neighbor ORDER BY rank) AS js, list(distance ORDER BY rank) AS ds FROM knn GROUP BY row_id
)"""


AFFINITY_SQL = f"""{knn_sql("euclidean")},
gaps AS (SELECT row_id, js, list_transform(ds, lambda x: x * x - ds[1] * ds[1]) AS g FROM near),
base AS (SELECT *, CASE WHEN list_avg(g) > 0 THEN list_avg(g) ELSE 1 END AS m FROM gaps),
search AS (
  SELECT row_id, 0 AS step, -50.0::DOUBLE AS lo, 50.0::DOUBLE AS hi FROM base
  UNION ALL
  SELECT row_id, step + 1, CASE WHEN high THEN mid ELSE lo END, CASE WHEN high THEN hi ELSE mid END
  FROM (
    SELECT row_id, step, lo, hi, mid, ln(s) + beta * gs / s > ln({PERPLEXITY}) AS high
    FROM (
      SELECT b.row_id, step, lo, hi, (lo + hi) / 2 AS mid, pow(2, (lo + hi) / 2) / m AS beta,
             list_sum(list_transform(g, lambda x: exp(-pow(2, (lo + hi) / 2) / m * x))) AS s,
             list_sum(list_transform(g, lambda x: x * exp(-pow(2, (lo + hi) / 2) / m * x))) AS gs
      FROM search r JOIN base b ON r.row_id = b.row_id WHERE step < {A.STEPS}
    )
  )
),
weighted AS (
  SELECT b.row_id, js, list_transform(g, lambda x: exp(-pow(2, (lo + hi) / 2) / m * x)) AS w
  FROM search r JOIN base b ON r.row_id = b.row_id WHERE step = {A.STEPS}
),
affinity AS (
  SELECT row_id, unnest(js) AS neighbor, unnest(list_transform(w, lambda x: x / list_sum(w))) AS p FROM weighted
)"""

SCALE_SQL = f"""{knn_sql("cosine")},
nearest AS (SELECT row_id, js, ds, coalesce(list_min(list_filter(ds, lambda x: x > 0)), 0) AS rho FROM near),
gaps AS (SELECT row_id, js, ds, rho, list_transform(ds, lambda x: greatest(x - rho, 0)) AS g FROM nearest),
base AS (SELECT *, CASE WHEN list_avg(g) > 0 THEN list_avg(g) ELSE 1 END AS m FROM gaps),
search AS (
  SELECT row_id, 0 AS step, -50.0::DOUBLE AS lo, 50.0::DOUBLE AS hi FROM base
  UNION ALL
  SELECT row_id, step + 1, CASE WHEN low THEN mid ELSE lo END, CASE WHEN low THEN hi ELSE mid END
  FROM (
    SELECT b.row_id, step, lo, hi, (lo + hi) / 2 AS mid,
           list_sum(list_transform(g, lambda x: exp(-x / (m * pow(2, (lo + hi) / 2))))) <= log2(len(g)) AS low
    FROM search r JOIN base b ON r.row_id = b.row_id WHERE step < {A.STEPS}
  )
),
scales AS (
  SELECT b.row_id, js, ds, rho, greatest(m * pow(2, (lo + hi) / 2), {A.MIN_SCALE} * list_avg(ds)) AS sigma
  FROM search r JOIN base b ON r.row_id = b.row_id WHERE step = {A.STEPS}
),
membership AS (
  SELECT row_id, unnest(js) AS neighbor,
         unnest(list_transform(ds, lambda x: CASE WHEN x <= rho THEN 1.0::DOUBLE ELSE exp(-(x - rho) / sigma) END)) AS w
  FROM scales
)"""


TIGHT_SQL = """tight AS (
  SELECT vec_id, list_transform(embedding, lambda x, i: CAST(x AS DOUBLE) * 0.25 + CASE WHEN i - 1 = label THEN 8 ELSE 0 END) AS v
  FROM embeddings
),
close AS (
  SELECT a.vec_id AS row_id, b.vec_id AS neighbor, list_distance(a.v, b.v) AS distance,
         row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.v, b.v), b.vec_id) AS rank
  FROM tight a JOIN tight b ON a.vec_id <> b.vec_id
)"""

QUERIES = {
    "knn_pruned": Query(
        knn_pruned,
        f"""WITH {knn_sql("cosine")}, {TIGHT_SQL}
SELECT row_id, neighbor, round(distance, 6) AS distance, CAST(rank AS INTEGER) AS rank, 'cosine' AS metric FROM knn
UNION ALL SELECT row_id, neighbor, round(distance, 6), CAST(rank AS INTEGER), 'euclidean' FROM close WHERE rank <= {K}""",
    ),
    "knn_pruned_compared": Query(
        knn_pruned_compared,
        "SELECT 'all' AS split, count(*) * (count(*) - 1) // 2 AS pairs, true AS below_a_third FROM embeddings",
    ),
    "knn_cosine": Query(
        knn_cosine,
        f"""WITH {knn_sql("cosine")} SELECT row_id, neighbor, round(distance, 6) AS distance, CAST(rank AS INTEGER) AS rank FROM knn""",
    ),
    "knn_euclidean": Query(
        knn_euclidean,
        f"""WITH {knn_sql("euclidean")} SELECT row_id, neighbor, round(distance, 6) AS distance, CAST(rank AS INTEGER) AS rank FROM knn""",
    ),
    "knn_ivf": Query(knn_ivf),
    "knn_over_copies": Query(
        knn_over_copies,
        f"""WITH tripled AS (
  SELECT 3 * vec_id + unnest([0, 1, 2]) AS id,
         list_transform(embedding, lambda x: CAST(x AS DOUBLE) * (1 + vec_id % 7)) AS v
  FROM embeddings
),
ranked AS (
  SELECT a.id AS row_id, b.id AS neighbor, list_distance(a.v, b.v) AS distance,
         row_number() OVER (PARTITION BY a.id ORDER BY list_distance(a.v, b.v), b.id) AS rank
  FROM tripled a JOIN tripled b ON a.id <> b.id
)
SELECT row_id, neighbor, round(distance, 6) AS distance, CAST(rank AS INTEGER) AS rank FROM ranked WHERE rank <= {K}""",
    ),
    "knn_outlier": Query(
        knn_outlier,
        f"""WITH vec AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CASE WHEN vec_id = 3 THEN 1e6 ELSE 1 + vec_id % 7 END) AS v
  FROM embeddings
),
ranked AS (
  SELECT a.vec_id AS row_id, b.vec_id AS neighbor, list_distance(a.v, b.v) AS distance,
         row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.v, b.v), b.vec_id) AS rank
  FROM vec a JOIN vec b ON a.vec_id <> b.vec_id
)
SELECT row_id, neighbor, round(distance, 3) AS distance, CAST(rank AS INTEGER) AS rank FROM ranked WHERE rank <= {K}""",
    ),
    "knn_exact_default": Query(
        knn_exact_default,
        f"""WITH {knn_sql("euclidean", k=SM.MIN_TSNE_NEIGHBORS)}
SELECT row_id, neighbor, round(distance, 6) AS distance, CAST(rank AS INTEGER) AS rank FROM knn""",
    ),
    "knn_ivf_all_probes": Query(
        knn_ivf_all_probes,
        f"""WITH {knn_sql("cosine")} SELECT row_id, neighbor, round(distance, 6) AS distance, CAST(rank AS INTEGER) AS rank FROM knn""",
    ),
    "knn_ivf_complete": Query(
        knn_ivf_complete,
        f"""SELECT vec_id AS row_id, least({SM.MIN_TSNE_NEIGHBORS}, n - 1) AS edges, least({SM.MIN_TSNE_NEIGHBORS}, n - 1) AS neighbors,
       least({SM.MIN_TSNE_NEIGHBORS}, n - 1) AS last_rank
FROM embeddings, (SELECT count(*) AS n FROM embeddings)""",
    ),
    "sampled_null_split": Query(
        sampled_null_split,
        f"""WITH s AS (
  SELECT nullif(label, 3) AS label, vec_id FROM embeddings
  QUALIFY row_number() OVER (PARTITION BY nullif(label, 3) ORDER BY md5('{SM.SEED}:' || vec_id), vec_id) <= 20
)
SELECT label, vec_id, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS row_id FROM s""",
    ),
    "reduced_unlabelled": Query(
        reduced_unlabelled,
        """WITH v AS (SELECT CAST(nullif(label, 3) AS VARCHAR) AS sub_label, vec_id FROM embeddings)
SELECT 'vectors' AS dataset_key, 'vectors' AS dataset_name, sub_label,
       CASE WHEN CAST(sub_label AS INTEGER) % 2 = 0 THEN 'even' ELSE 'unknown' END AS category,
       'unknown' AS text_strategy_template, '[]' AS text_strategy_fields,
       row_number() OVER (PARTITION BY sub_label ORDER BY vec_id) - 1 AS row_id, vec_id
FROM v QUALIFY count(*) OVER (PARTITION BY sub_label) >= 5""",
    ),
    "knn_per_split": Query(
        knn_per_split,
        f"""WITH {knn_sql("cosine", per_split=True)}
SELECT CAST(label AS VARCHAR) AS split, row_id, neighbor, round(distance, 6) AS distance, CAST(rank AS INTEGER) AS rank
FROM knn""",
    ),
    "tsne_affinities": Query(
        tsne_affinities,
        f"WITH RECURSIVE {AFFINITY_SQL} SELECT row_id, neighbor, round(p, 6) AS p FROM affinity",
    ),
    "tsne_symmetric": Query(
        tsne_symmetric,
        f"""WITH RECURSIVE {AFFINITY_SQL},
both_ways AS (
  SELECT row_id, neighbor, p FROM affinity UNION ALL SELECT neighbor, row_id, p FROM affinity
)
SELECT row_id, neighbor, round(sum(p) / (2 * (SELECT count(*) FROM embeddings)), 9) AS p
FROM both_ways GROUP BY row_id, neighbor""",
    ),
    "umap_scales": Query(
        umap_scales,
        f"WITH RECURSIVE {SCALE_SQL} SELECT row_id, round(rho, 6) AS rho, round(sigma, 6) AS sigma FROM scales",
    ),
    "umap_memberships": Query(
        umap_memberships,
        f"WITH RECURSIVE {SCALE_SQL} SELECT row_id, neighbor, round(w, 6) AS w FROM membership",
    ),
    "fuzzy_union": Query(
        fuzzy_union,
        f"""WITH RECURSIVE {SCALE_SQL}
SELECT coalesce(a.row_id, b.neighbor) AS row_id, coalesce(a.neighbor, b.row_id) AS neighbor,
       round(coalesce(a.w, 0) + coalesce(b.w, 0) - coalesce(a.w, 0) * coalesce(b.w, 0), 6) AS w
FROM membership a FULL OUTER JOIN membership b ON a.row_id = b.neighbor AND a.neighbor = b.row_id""",
    ),
    "pca_init": Query(pca_init),
    "pca_axes": Query(
        pca_axes,
        """WITH component AS (SELECT cast(label AS VARCHAR) AS sub_label, unnest(range(len(embedding))) AS place,
                   cast(unnest(embedding) AS DOUBLE) AS x FROM embeddings),
     varied AS (SELECT sub_label, place, var_pop(x) + var_pop(x ** 2) + var_pop(x ** 3) AS v FROM component GROUP BY sub_label, place),
     whole AS (SELECT sub_label, round(sum(v), 6) AS total FROM varied GROUP BY sub_label)
SELECT sub_label, total, cast(a AS INT) AS a, cast(b AS INT) AS b, CASE WHEN a = b THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS product,
       0.0::DOUBLE AS missed
FROM whole, range(3) AS x(a), range(3) AS y(b) WHERE a <= b""",
    ),
    "tsne_2d": Query(tsne_query(2)),
    "tsne_3d": Query(tsne_query(3)),
    "umap_2d": Query(umap_query(2)),
    "umap_3d": Query(umap_query(3)),
    "reduce_full": Query(reduce_full),
    "reduced_labels": Query(
        reduced_labels,
        """SELECT 'vectors' AS dataset_key, 'vectors' AS dataset_name, CAST(label AS VARCHAR) AS sub_label,
       'unknown' AS category, 'unknown' AS text_strategy_template, '[]' AS text_strategy_fields,
       row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS row_id, vec_id, true AS no_coordinates
FROM embeddings QUALIFY count(*) OVER (PARTITION BY label) >= 5""",
    ),
    "reduction_record": Query(
        reduction_record,
        f"""SELECT 'vectors' AS dataset_key, CAST(label AS VARCHAR) AS sub_label, least(count(*), 20) AS num_rows,
       count(*) AS total_available, 'spark' AS reduction_backend, '{",".join(RR.COORDINATE_COLUMNS)}' AS columns_2d_3d
FROM embeddings GROUP BY label HAVING count(*) >= 5""",
    ),
    "pending_splits": Query(
        pending_splits,
        """SELECT source AS dataset_key, lang AS sub_label, count(*) AS rows FROM documents
WHERE lang NOT IN ('en', 'de') GROUP BY ALL""",
    ),
}
