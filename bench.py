"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from corpusloom.queries import all_queries
from corpusloom.session import build_session

HEADLINE = [
    "preprocess_full",
    "metadata_last_wins",
    "dataset_catalog",
    "missing_selection",
    "discover_splits",
    "hash_embed",
    "batch_embed",
    "mean_pool",
    "sample_split",
    "dense_row_id",
    "vector_check",
    "knn_cosine",
    "knn_euclidean",
    "tsne_symmetric",
    "fuzzy_union",
    "pca_init",
    "umap_2d",
    "tsne_2d",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(
        f"local[{cpus}]", cpus, **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("OFF")
    registered = all_queries()
    spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        registered[name].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
