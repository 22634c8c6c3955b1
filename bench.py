"""Time the headline queries at $BENCH_SF_DIR and print one JSON line.

Every result is consumed in full by Spark's no-op sink. ``train`` and ``draw_index`` store
what the queries after them read, as a model on disk would be reused.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from gramloom import queries as q

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = [
    "vocab_freq", "transitions_o1_o3", "ngrams_window", "zipf", "size", "entropy", "growth", "state_totals",
    "prune_report", "backoff_lookup", "forced_steps", "backoff_stats", "perplexity", "batch_walk", "detokenize",
]


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]").appName("bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", str(2 * int(CPUS)))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.maxConcurrentOutputFileWriters", "16")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1_000_000).selectExpr("sum(id)").collect()  # start the executors
    seconds: dict[str, float] = {}

    def timed(name, work):
        began = time.perf_counter()
        work()
        seconds[name] = round(time.perf_counter() - began, 3)

    registered = {f.__name__: f for f in q.ALL}

    def consumed(name):
        registered[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()

    timed("train", lambda: q._model(spark, SF_DIR))
    timed("train_increment", lambda: q._grown_model(spark, SF_DIR))
    timed("draw_index", lambda: q._index(spark, SF_DIR))
    for name in HEADLINE:
        timed(name, lambda: consumed(name))
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(SF_DIR.rstrip("/")),
    }))


if __name__ == "__main__":
    main()
