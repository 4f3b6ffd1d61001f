"""Reconciling offloaded copies with the exported profiles of their sources."""

from __future__ import annotations

import uuid
from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.functions import types
from tallymark.operators import compare, control, lines
from tallymark.operators.control import TABLE_KEY
from tallymark.operators.profile import Metric, filtered, profile_family, profile_table
from tallymark.plans.batches import Outcome, Request, write_profiles
from tallymark.sources.tables import AGGREGATION_FAILED, copy_shape, parquet_copy, parquet_family

OUTCOME_SCHEMA = "db string, schema string, table string, started timestamp_ntz, ended timestamp_ntz, error string"
# The column that names the partition a row came from.
FAMILY_MEMBER = "partition of the family"
# Fixed value: an error text that the failure classes look for.
LINE_MISSING = "Greenplum result file not found"


class Reconciliation(NamedTuple):
    results: DataFrame
    columns: DataFrame
    table_log: DataFrame
    column_log: DataFrame
    summary: DataFrame


def _metrics_to_run(expected: DataFrame, metric_types: DataFrame, exact: bool) -> DataFrame:
    """Per table and metric of the line: the type the copy is read as."""
    to_spark = types.unbounded_cast_type if exact else types.spark_type
    return (
        compare.metric_rows(expected)
        .withColumn("type_key", F.lower("col"))
        .join(metric_types, TABLE_KEY + ["type_key"], "left")
        .select(*TABLE_KEY, "func", "col", "position", to_spark(F.coalesce("source_type", F.lit(types.UNMAPPED))).alias("cast"))
    )


def reconcile(
    spark: SparkSession,
    tables: DataFrame,
    success_log: DataFrame,
    result_lines: DataFrame,
    type_map: DataFrame,
    folder: str,
    execution_id: str | None = None,
    path_from: str | None = None,
    path_to: str | None = None,
    exact: bool = False,
    master: DataFrame | None = None,
    batch_size: int = 50,
    escaped: bool = False,
    **options,
) -> Reconciliation:
    """Profile the copy of every listed table and compare it with its line.

    Partitions of one table with the same metrics and whose copies have the
    same columns are profiled together, in one grouped aggregate over all their
    files. Only the plan passes through the driver: paths, names of columns,
    types. Profiles of the copies are written to a new folder of this run below
    ``folder``, and every result reads them from there. A table listed twice
    counts once. ``options``, such as a collation, go to `profile`. The
    configured predicates were applied to the sources; they are applied to the
    copies too when ``master`` is given. ``escaped`` says that the lines are.
    """
    run_start = datetime.now(timezone.utc).replace(tzinfo=None)
    folder = f"{folder}/{uuid.uuid4().hex}"
    tables = tables.dropDuplicates(TABLE_KEY)
    execution_id = execution_id or spark.sparkContext.applicationId
    located = control.with_copy_path(tables, control.latest_success(success_log, by_time=exact), path_from, path_to)
    parsed = lines.latest_lines(lines.parse_lines(result_lines))
    expected = lines.decode_lines(parsed.join(tables, TABLE_KEY, "left_semi"), escaped)
    metric_types = control.metric_types(type_map, exact)

    metrics = defaultdict(list)
    for row in _metrics_to_run(expected, metric_types, exact).orderBy("position").collect():
        metrics[row.db, row.schema, row.table].append(Metric(row.func, row.col, row.cast))
    plan = (
        located.join(parsed.select(*TABLE_KEY, F.coalesce("reason", F.lit("")).alias("reason")), TABLE_KEY, "left")
        .select(*TABLE_KEY, "base_table", "has_copy", "file_path", F.coalesce("reason", F.lit(LINE_MISSING)).alias("reason"))
        .distinct()
        .collect()
    )
    wheres = {}
    if master is not None:
        chosen = master.join(tables, TABLE_KEY, "left_semi").select(*TABLE_KEY, "where")
        wheres = {(r.db, r.schema, r.table): r.where for r in chosen.collect()}
    readable = {(r.db, r.schema, r.table): r.file_path for r in plan if r.has_copy and not r.reason}
    # Looking at a copy waits for storage. A copy that is not there never gets into a family.
    with ThreadPoolExecutor(16) as pool:
        shapes = dict(zip(readable, pool.map(lambda path: copy_shape(spark, path), readable.values())))
    paths, families, outcomes = {}, defaultdict(list), []
    for row in plan:
        table = (row.db, row.schema, row.table)
        if isinstance(shapes.get(table), str):
            outcomes.append(Outcome(table, run_start, run_start, shapes[table]))
        elif table in readable:
            paths[table] = row.file_path
            families[row.db, row.schema, row.base_table, tuple(metrics[table]), wheres.get(table), shapes[table]].append(table)
        else:
            outcomes.append(Outcome(table, run_start, run_start, row.reason if row.has_copy else None))

    def build(members):
        db, schema, _ = members[0]
        chosen = {"of_copy": True, "whole_seconds": not exact, **options}
        if len(members) == 1:
            copy = filtered(parquet_copy(spark, paths[members[0]]), wheres.get(members[0]))
            return profile_table(copy, *members[0], metrics[members[0]], **chosen)
        family = parquet_family(spark, {table: paths[db, schema, table] for _, _, table in members}, FAMILY_MEMBER, merge_schemas=False)
        family = filtered(family, wheres.get(members[0]))
        return profile_family(family, db, schema, metrics[members[0]], FAMILY_MEMBER, **chosen)

    requests = [Request(tuple(sorted(members)), build) for members in families.values()]
    for outcome in write_profiles(spark, requests, f"{folder}/profiles", batch_size):
        outcomes.append(outcome._replace(error=outcome.error and AGGREGATION_FAILED + outcome.error))
    status = spark.createDataFrame([(*o.table, o.started, o.ended, o.error) for o in outcomes], OUTCOME_SCHEMA)

    profiled = status.where(F.col("error").isNull()).join(located.where("has_copy"), TABLE_KEY, "left_semi")
    compared = compare.compare_profiles(
        expected.join(profiled, TABLE_KEY, "left_semi"), spark.read.parquet(f"{folder}/profiles"), metric_types, exact
    )
    # Kept as a table, for the results, both logs and the summary read it.
    compared.write.parquet(f"{folder}/compared")
    compared = spark.read.parquet(f"{folder}/compared")
    results = compare.classify_tables(compared, metric_types).unionByName(
        compare.without_result(located.select(*TABLE_KEY, "has_copy").distinct().join(status, TABLE_KEY))
    )
    timed = results.join(status.select(*TABLE_KEY, "started", "ended"), TABLE_KEY)
    return Reconciliation(
        results=results,
        columns=compare.metric_rows(compared),
        table_log=compare.table_log(timed, execution_id, F.lit(run_start), F.col("started"), F.col("ended")),
        column_log=compare.column_log(compared, execution_id),
        summary=compare.run_summary(results),
    )
