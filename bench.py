"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR is the folder of the tables, BENCH_CPUS the number of local threads.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "ratings_latest", "item_stats", "cold_start_cells", "minhash_signatures", "similar_items_lsh",
    "similar_items_exact", "item_pair_similarity", "item_cf_rho25", "item_cf_topk", "item_cf_default_voting",
    "label_encode", "train_features", "test_features", "hybrid_weight", "model_predictions", "hybrid_predictions",
)


def session(cpus: str) -> SparkSession:
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("bench")
             .config("spark.driver.memory", "16g")
             .config("spark.sql.shuffle.partitions", cpus)
             .config("spark.sql.session.timeZone", "UTC")
             # AQE may turn a sort-merge join into a hash join where every measured partition is below this
             .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64MB")
             .config("spark.python.sql.dataFrameDebugging.enabled", "false")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    from affinis.plans.queries import QUERIES

    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark.read.parquet(f"{folder}/region.parquet").count()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {seconds[name]} s", file=sys.stderr)
    spark.stop()
    print(json.dumps({"metric": "total seconds of the headline queries", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
