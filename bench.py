"""Timings of the headline queries at ``$BENCH_SF_DIR``; prints one JSON line.

Every query gets its inputs as written tables and is run once untimed, on the
same tables, to start the JVM's compiler and the Python workers. ``full_run``
starts from the raw tables and reuses nothing.
"""

from __future__ import annotations

import json
import os
import sys
import time

os.environ.setdefault("PYSPARK_PYTHON", sys.executable)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def timed(build) -> float:
    start = time.perf_counter()
    df: DataFrame = build()
    df.write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("chunkwright-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    from chunkwright.operators import bundles, duplicates, evaluation, hybrid, neighbors, validation
    from chunkwright.options import Options
    from chunkwright.plans.testset import build_testset
    from chunkwright.session import settle
    from registry.views import Views

    views, options = Views(spark, FOLDER), Options()
    copied = settle(views.copied)
    cells = Options(block_rows=512)
    wide = Options(broadcast_rows=1, block_rows=512)
    requests, queries = settle(views.requests), settle(views.queries)
    queries_to_time = {
        "token_length_filter": lambda: validation.token_length_filter(views.documents, options),
        "validate": lambda: validation.annotate(copied, options),
        "near_duplicate_pairs": lambda: duplicates.near_duplicate_pairs(copied, options),
        "near_duplicate_pairs_cells": lambda: duplicates.near_duplicate_pairs(copied, cells),
        "dedup_any_earlier": lambda: duplicates.dedup_any_earlier(copied, options),
        "dedup_greedy": lambda: duplicates.dedup_greedy(copied, options),
        "knn_join": lambda: neighbors.knn_join(copied, copied, 3, options),
        "knn_join_cells": lambda: neighbors.knn_join(copied, copied, 3, wide),
        "hybrid_search": lambda: hybrid.hybrid_search(copied, copied, 3, options),
        "extractive_queries": lambda: bundles.extractive_queries(requests, options),
        "bm25_local": lambda: evaluation.evaluate_queries(queries, options),
        "full_run": lambda: build_testset(views.copied, options).ground_truth,
    }
    seconds = {}
    for name, build in queries_to_time.items():
        timed(build)
        seconds[name] = timed(build)
    print(
        json.dumps(
            {
                "metric": "headline queries, total seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
                "rows": {"chunks": copied.count(), "queries": queries.count()},
            }
        )
    )


if __name__ == "__main__":
    main()
