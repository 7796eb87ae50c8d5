"""Time every registered query over ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]`` and print one JSON line.

Each query is built, planned and run to the last row into a sink that discards it. An untimed first pass
(``BENCH_WARMUP=0`` leaves it out) takes class loading and code generation out of the figures.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from pyspark.sql import DataFrame, SparkSession

from estate_hygiene.registry import registered


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("estate-hygiene-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.codegen.cache.maxEntries", "5000")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = sys.argv[1:]
    queries = {name: query for name, query in registered().items() if not chosen or name in chosen}
    spark = session(cpus)
    if os.environ.get("BENCH_WARMUP", "1") != "0":
        for query in queries.values():
            run(query(spark, sf_dir))
    seconds = {}
    for name, query in queries.items():
        start = time.perf_counter()
        run(query(spark, sf_dir))
        seconds[name] = round(time.perf_counter() - start, 3)
    scale = re.search(r"sf([\d.]+)", sf_dir)
    result = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(scale.group(1)) if scale else None,
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
