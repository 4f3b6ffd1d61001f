"""Exporting the row digests of the listed source tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.functions.text import strip
from tallymark.operators import control
from tallymark.operators.compare import run_summary
from tallymark.operators.content import content_rows
from tallymark.operators.control import TABLE_KEY
from tallymark.sinks.export import write_content

# Statuses and the message of a table that went well.
SUCCESS, FAILED, FINE = "SUCCESS", "FAILED", "-"


class ContentRun(NamedTuple):
    """``db, schema, table, path, status, message`` per table, and tables per status."""

    results: DataFrame
    summary: DataFrame


def _plan(tables: DataFrame, type_map: DataFrame, special: DataFrame) -> DataFrame:
    """Per table: the columns in type-map order, the special ones, the error if its keys are none."""
    listed = tables.groupBy(*TABLE_KEY).agg(F.max_by("key_cols", F.struct("path", "ordinal")).alias("key_cols"))
    column = strip(F.coalesce("gp_column", F.lit("")))
    columns = (
        type_map.select(*TABLE_KEY, F.struct("ordinal", column.alias("column")).alias("place"))
        .where("place.column != ''")
        .groupBy(*TABLE_KEY)
        .agg(F.array_sort(F.collect_list("place")).getField("column").alias("columns"))
    )
    resolved = control.with_special_columns(control.resolve_keys(listed, type_map), special)
    return resolved.join(columns, TABLE_KEY, "left").select(*TABLE_KEY, "key_cols", "columns", "special", "error")


def export_content(
    spark: SparkSession,
    tables: DataFrame,
    type_map: DataFrame,
    special: DataFrame,
    read_table: Callable[[str, str, str], DataFrame],
    folder: str,
    form: str = "text",
    gzip: bool = False,
    exclude_content: bool = False,
    exact: bool = False,
    side_by_side: int = 4,
) -> ContentRun:
    """Write the row digests of every listed table below ``folder``, at ``<run>/db/schema/table``.

    ``tables`` comes from a list with keys, ``special`` from
    `tallymark.operators.control.special_columns`. Columns are digested in the
    order of the type map. Each table is a job of its own, as its rows are all
    written; ``side_by_side`` of them run at a time, so that a large table does
    not hold up the others. A table that cannot be read or digested is FAILED
    with its error and does not stop the rest. Of a table listed twice the last
    entry counts. Every run writes to a folder of its own, which the results name, so
    a run that fails leaves the digests of the last one as they are. Only names pass
    through the driver.
    """
    run_folder = f"{folder}/{uuid.uuid4().hex}"

    def run(row) -> tuple:
        path = f"{run_folder}/{row.db}/{row.schema}/{row.table}"
        identity = row.db, row.schema, row.table, path
        if row.error is not None:
            return *identity, FAILED, row.error
        try:
            source = read_table(row.db, row.schema, row.table)
            digests = content_rows(source, row.key_cols, row.columns, row.special, exclude_content, exact, f"{row.schema}.{row.table}")
            write_content(digests, path, form, gzip)
        except Exception as failure:
            return *identity, FAILED, str(failure).replace("\n", " ")
        return *identity, SUCCESS, FINE

    with ThreadPoolExecutor(side_by_side) as pool:
        outcomes = list(pool.map(run, _plan(tables, type_map, special).collect()))
    results = spark.createDataFrame(
        outcomes, "db string, schema string, table string, path string, status string, message string"
    )
    return ContentRun(results, run_summary(results))
