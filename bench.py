"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the cores. Every query is
evaluated in full into a sink that keeps nothing; its time is the best of two
runs, plan building included. With ``BENCH_COMPARE=1`` the ways the library
does not go (a job per metric, a job per month) are timed as well.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks import queries as q  # noqa: E402
from checks.tables import DB, as_text_copy, source  # noqa: E402
from tallymark.operators.profile import all_profiles, profile_table  # noqa: E402

HEADLINES = [
    "profile_count", "profile_sum", "profile_long", "profile_by_partition", "profile_cast_copy",
    "line_encode", "line_decode", "table_list_parse", "master_lookup", "success_latest", "result_latest", "key_validation",
    "content_rows_keyed", "content_rows_all", "content_rows_excluded", "content_rows_special",
    "compare_metrics", "table_status", "table_status_many", "run_summary",
    "export_gzip", "incremental_changed", "incremental_ingest",
]


def lineitem_with_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q._content(spark, sf_dir, "lineitem", "ALL")


def job_per_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = source(spark, sf_dir, "lineitem")
    return all_profiles([profile_table(df, DB, "sales", "lineitem", [m]) for m in q.LINEITEM_METRICS])


def job_per_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = q._orders_by_month(source(spark, sf_dir, "orders"))
    months = sorted(r[0] for r in df.select("table").distinct().collect())
    return all_profiles([profile_table(df.where(F.col("table") == m), DB, "sales", m, q.ORDER_METRICS) for m in months])


def orders_with_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reconcile orders, by month, with its faithful text copy."""
    df = q._orders_by_month(source(spark, sf_dir, "orders"))
    expected, actual = q._both_sides(df, as_text_copy(df), q.ORDER_METRICS, q.ORDER_CASTS)
    types = q.control.metric_types(q.type_map_of(df, "sales"))
    return q.compare.classify_tables(q.compare.compare_profiles(expected, actual, types), types)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    runs = {name: q.QUERIES[name] for name in HEADLINES}
    runs |= {"lineitem_with_content": lineitem_with_content, "orders_with_copy": orders_with_copy}
    if os.environ.get("BENCH_COMPARE"):
        runs |= {"job_per_metric": job_per_metric, "job_per_month": job_per_month}
    seconds = {}
    for name, query in runs.items():
        times = []
        for _ in range(2):
            started = time.perf_counter()
            query(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - started)
        seconds[name] = round(min(times), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    spark.stop()
    total = round(sum(seconds.values()), 3)
    print(json.dumps({
        "metric": "total_query_seconds", "value": total, "unit": "sec", "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
