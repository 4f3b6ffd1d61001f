"""Run queries and their SQL side by side: ``python -m checks.run SF_DIR [NAME...]``."""

from __future__ import annotations

import sys
import time
from decimal import Decimal

import duckdb
from pyspark.sql import SparkSession

from checks.oracle import ORACLE
from checks.queries import QUERIES
from checks.tables import TABLES


SAME_TYPE = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER"}


def _cell(value):
    if isinstance(value, bool):
        return str(int(value))
    if isinstance(value, Decimal):
        return str(value)
    return None if value is None else str(value)


def _sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=lambda r: tuple((v is None, v or "") for v in r))


def compare(spark: SparkSession, sf_dir: str, name: str) -> tuple[str, float]:
    started = time.time()
    df = QUERIES[name](spark, sf_dir)
    got = _sorted_rows(df.columns, df.collect())
    seconds = time.time() - started
    if name not in ORACLE:
        return f"no SQL, {len(got)} rows", seconds
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    answer = con.execute(ORACLE[name])
    names = [d[0] for d in answer.description]
    want = _sorted_rows(names, answer.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"DIFFERENT columns: {sorted(df.columns)} / {sorted(names)}", seconds
    kinds = dict(df.dtypes)
    odd = {n: (kinds[n], str(d[1])) for n, d in zip(names, answer.description) if SAME_TYPE.get(kinds[n]) != str(d[1])}
    if odd:
        return f"DIFFERENT types: {odd}", seconds
    if got != want:
        only = [r for r in got if r not in set(want)][:2], [r for r in want if r not in set(got)][:2]
        return f"DIFFERENT: {len(got)} / {len(want)} rows; query only {only[0]}; SQL only {only[1]}", seconds
    return f"same, {len(got)} rows", seconds


def main(sf_dir: str, *names: str) -> int:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    wrong = 0
    for name in names or QUERIES:
        try:
            verdict, seconds = compare(spark, sf_dir, name)
        except Exception as failure:
            verdict, seconds = f"FAILED: {str(failure)[:1500]}", 0.0
        wrong += not verdict.startswith(("same", "no SQL"))
        print(f"{name:24} {seconds:6.2f} s  {verdict}"[:2500], flush=True)
    print(f"{wrong} wrong")
    return wrong


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
