"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the input folder and
BENCH_CPUS (default 8) the local cores. Every query writes to Spark's no-op
sink, so all rows and columns are produced. Each is run twice after the session
has started and the faster run counts; a query that reads the refined or
feature layer finds it written, and writing them is timed as its own entry.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lamina.operators import features, trees
from lamina.plans import stages, testbed
from lamina.plans.catalog import QUERIES
from lamina.session import build_session, fresh_path
from lamina.sources.layers import write_layer


def refined_stage(spark, folder):
    write_layer(testbed.refined_rows(spark, folder), fresh_path(spark, "bench-refined"))


def feature_stage(spark, folder):
    rows, _ = features.build_features(testbed.refined(spark, folder))
    write_layer(rows, fresh_path(spark, "bench-feature"))


def model_stage(spark, folder):
    """Trains both trees on the refined rows and predicts every row."""
    rows = testbed.split_rows(spark, folder)
    scored = stages.score_layer(rows, features.detect_features(rows), (trees.GINI, trees.ENTROPY))
    write_layer(scored.rows, fresh_path(spark, "bench-scored"))


def query(name):
    def run(spark, folder):
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()

    return run


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__driver__memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    work = {"stage_refined": refined_stage, "stage_feature": feature_stage, "stage_model": model_stage}
    work |= {name: query(name) for name in QUERIES}
    chosen = [n for n in os.environ.get("BENCH_ONLY", "").split(",") if n]
    seconds = {}
    for name, run in work.items():
        if chosen and name not in chosen:
            continue
        best = None
        for _ in range(runs):
            start = time.perf_counter()
            run(spark, folder)
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        seconds[name] = round(best, 4)
    total = round(sum(seconds.values()), 4)
    rows = testbed.table(spark, folder, "lineitem").count()
    result = {
        "metric": "total_query_seconds",
        "value": total,
        "unit": "sec",
        "queries": seconds,
        "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
        "lineitem_rows": rows,
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
