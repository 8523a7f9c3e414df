"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores, ``BENCH_RUNS`` the
timed runs after one warm-up (median), ``BENCH_QUERIES`` a comma-separated choice.
Results go to Spark's noop sink, so every row and column is computed.

The queries make their page files from the star-schema tables, inside the timing. The
``load`` entry times the load alone: page files made before, all value tables decoded.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "table_crosstab", "cohort_grid", "keydate_series", "sync_scoped", "incremental_entities",
    "rle_roundtrip", "ascending_guard", "chain_order", "chain_doubling", "chain_repair",
    "long_text", "delimited_blocks", "decode_floats", "qualified_numbers", "route_values",
    "load_values", "resolve_keys", "index_terms", "index_dedupe", "quality_report",
]


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("eavspark-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def time_load(spark: SparkSession, sf_dir: str, cpus: int) -> dict[str, float]:
    """Values decoded and routed to their tables per second and core, of a system already on disk."""
    from functools import reduce

    from pyspark.sql import functions as F

    from eavspark.plans import values
    from eavspark.plans.catalog_pages import value_system

    system, laps, n = value_system(spark, sf_dir), [], 0
    for _ in range(3):
        start = time.perf_counter()
        tables = values.load_values(system).tables.values()
        # the value is read as well as the key: its hash is summed
        counts = [t.agg(F.count("seq").alias("n"), F.sum(F.xxhash64(t.columns[-1]) % 7).alias("h")) for t in tables]
        n = sum(r["n"] for r in reduce(lambda a, b: a.unionByName(b), counts).collect())
        laps.append(time.perf_counter() - start)
    sec = statistics.median(laps[1:])
    return {"values": n, "sec": round(sec, 3), "values_per_sec_per_core": round(n / sec / cpus)}


def main() -> None:
    from eavspark.plans.catalog import QUERIES

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    chosen = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINE
    spark = session(cpus)
    times: dict[str, float] = {}
    for name in chosen:
        laps = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            laps.append(time.perf_counter() - start)
        times[name] = round(statistics.median(laps[1:]), 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    load = time_load(spark, sf_dir, int(cpus)) if not os.environ.get("BENCH_QUERIES") else None
    spark.stop()
    print(json.dumps({
        "metric": "eav_headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus), "runs": runs, "load": load,
    }))


if __name__ == "__main__":
    main()
