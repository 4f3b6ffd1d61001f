"""Comparing two profiles and classifying the tables they describe."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.functions import rules, text, types
from tallymark.operators.control import TABLE_KEY
from tallymark.operators.lines import STATUS
from tallymark.operators.profile import COUNT

METRIC_KEY = TABLE_KEY + ["func", "col"]


def compare_profiles(
    expected: DataFrame, actual: DataFrame, metric_types: DataFrame, exact: bool = False
) -> DataFrame:
    """Every row of the expected profile beside the copy's value.

    The row count must be equal. Other metrics follow their source type;
    ``exact`` compares decimals to the last digit instead of within a
    tolerance, and takes a SUM over nothing as ``0`` on the copy's side as on
    the source's. Values are shown with the scale of their type, or as they are
    when ``exact``. A metric the copy lacks reads as the empty text. The type map
    is read once: ``has_type_map`` says whether it knows the table at all.
    """
    entries = F.map_from_entries(F.collect_list(F.struct("type_key", "source_type")))
    of_table = metric_types.groupBy(*TABLE_KEY).agg(entries.alias("types"))
    right = actual.select(*METRIC_KEY, F.col("value").alias("copy_value"))
    matches = rules.metric_matches_exactly if exact else rules.metric_matches
    func, source_type = F.col("func"), F.col("source_type")
    expected_text, actual_text = F.col("source_text"), F.col("copy_text")
    as_number = rules.is_compared_as_number(func, source_type, expected_text, actual_text)
    scale = types.number_scale(source_type)
    zero_if_absent = [COUNT, "SUM"] if exact else [COUNT]

    def shown(value):
        if exact:  # a double would lose digits
            return value
        return F.when(as_number & (func != COUNT), rules.shown_number(value, scale)).otherwise(value)

    return (
        expected.withColumn("type_key", F.lower("col"))
        .join(right, METRIC_KEY, "left")
        .join(of_table, TABLE_KEY, "left")
        .select(
            *METRIC_KEY,
            "position",
            F.coalesce(F.try_element_at("types", "type_key"), F.lit(types.UNMAPPED)).alias("source_type"),
            F.col("types").isNotNull().alias("has_type_map"),
            text.strip(F.coalesce("value", F.lit(""))).alias("source_text"),
            # A copy without rows has no group of its own in a family's profile.
            text.strip(F.coalesce("copy_value", F.when(func.isin(zero_if_absent), "0").otherwise(""))).alias("copy_text"),
        )
        .select(
            *METRIC_KEY,
            "position",
            "source_type",
            shown(expected_text).alias("source_value"),
            shown(actual_text).alias("copy_value"),
            F.when(func == COUNT, expected_text == actual_text)
            .when(func == STATUS, True)
            .otherwise(matches(func, source_type, expected_text, actual_text))
            .alias("matched"),
            "has_type_map",
        )
    )


def metric_rows(compared: DataFrame) -> DataFrame:
    """The compared metrics proper: neither the row count nor notes."""
    return compared.where(~F.col("func").isin(COUNT, STATUS))


def classify_tables(compared: DataFrame, metric_types: DataFrame | None = None) -> DataFrame:
    """Counts, mismatches, status and remark per compared table.

    Rows that do not say whether a type map knows their table (``has_type_map``)
    are joined with ``metric_types`` to find out.
    """
    is_count = F.col("func") == COUNT
    is_metric = ~F.col("func").isin(COUNT, STATUS)
    note = F.when(F.col("func") == STATUS, F.concat(F.lit(rules.STATUS_TOKEN + " "), "source_value"))
    if "has_type_map" not in compared.columns:
        mapped = metric_types.select(*TABLE_KEY).distinct().withColumn("has_type_map", F.lit(True))
        compared = compared.join(mapped, TABLE_KEY, "left")
    status = rules.reconcile_status(
        F.col("count_matches"), F.col("mismatch_metrics"), F.col("line_remark"), F.col("has_type_map")
    )
    remark = rules.reconcile_remark(
        F.col("status"), F.col("count_matches"), F.col("mismatch_metrics"), F.col("total_metrics"), F.col("line_remark")
    )
    return (
        compared.groupBy(*TABLE_KEY)
        .agg(
            F.max(F.when(is_count, F.col("source_value"))).try_cast("bigint").alias("source_count"),
            F.max(F.when(is_count, F.col("copy_value"))).try_cast("bigint").alias("copy_count"),
            F.coalesce(F.bool_and(F.when(is_count, F.col("matched"))), F.lit(False)).alias("count_matches"),
            F.count_if(is_metric).alias("total_metrics"),
            F.count_if(is_metric & ~F.col("matched")).alias("mismatch_metrics"),
            F.coalesce(F.max(note), F.lit("")).alias("line_remark"),
            F.coalesce(F.bool_or("has_type_map"), F.lit(False)).alias("has_type_map"),
        )
        .withColumn("status", status)
        .select(
            *TABLE_KEY, "source_count", "copy_count", "total_metrics", "mismatch_metrics", "status", remark.alias("remark")
        )
    )


def without_result(tables: DataFrame) -> DataFrame:
    """Skipped and failed tables with the same columns as `classify_tables`.

    ``tables`` has ``error`` (NULL unless the table failed) and ``has_copy``.
    """
    skipped = ~F.col("has_copy")
    none = [F.lit(0).cast("bigint").alias(c) for c in ("source_count", "copy_count", "total_metrics", "mismatch_metrics")]
    return tables.where(skipped | F.col("error").isNotNull()).select(
        *TABLE_KEY,
        *none,
        F.when(skipped, rules.SKIPPED).otherwise(rules.FAILED).alias("status"),
        F.when(skipped, rules.REMARK_NOT_SUCCEEDED).otherwise(rules.failure_log_remark(F.col("error"))).alias("remark"),
    )


def column_log(compared: DataFrame, execution_id: str) -> DataFrame:
    """Rows for the column-level log."""
    return metric_rows(compared).select(
        F.lit(execution_id).alias("execution_id"),
        F.col("table").alias("partition"),
        "func",
        "col",
        "source_value",
        "copy_value",
        F.when(F.col("matched"), "Matched").otherwise("Mismatch").alias("match"),
        F.lit(rules.REMARK_COMPARED).alias("remark"),
    )


def table_log(results: DataFrame, execution_id: str, run_start, table_start, table_end) -> DataFrame:
    """Rows for the table-level log; times are timestamp columns."""

    def seconds(start):
        elapsed = F.timestamp_diff("MICROSECOND", start, table_end)
        return (elapsed / 1_000_000).cast("decimal(18,2)")

    return results.select(
        F.lit(execution_id).alias("execution_id"),
        "db",
        "schema",
        text.base_table(F.col("table")).alias("table"),
        F.col("table").alias("partition"),
        F.date_trunc("second", table_start).alias("start_ts"),
        F.date_trunc("second", table_end).alias("end_ts"),
        seconds(run_start).alias("duration_exec"),
        seconds(table_start).alias("duration_table"),
        "source_count",
        "copy_count",
        "total_metrics",
        "mismatch_metrics",
        F.lower("status").alias("status"),
        text.without_quotes(F.col("remark")).alias("remark"),
    )


def run_summary(results: DataFrame) -> DataFrame:
    """Tables per status."""
    return results.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
