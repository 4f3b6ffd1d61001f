"""The text form of a profile: one line per table.

``db|schema|table|count|FUNC(col):value,FUNC(col):value``

Values stand there as they are, so one that holds ``|`` or reads like a metric
breaks its line, and blanks at its ends are lost. Escaped lines keep any value and
any column name; both sides must agree on them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.functions import rules
from tallymark.functions.text import escaped, strip, unescaped
from tallymark.operators.control import TABLE_KEY
from tallymark.operators.profile import COUNT, EVERY_ROW

STATUS = "MIN_MAX_STATUS"
# Fixed value: how a metric reads in a line. A value ends where the next metric
# begins, so it may hold commas and colons.
METRIC = r"(?is)(SUM|MIN|MAX)\(([^()]*)\):(.*?)(?=,\s*(?:SUM|MIN|MAX)\([^()]*\):|$)"


def mark_missing_type_map(tables: DataFrame) -> DataFrame:
    """Profile rows that note a missing type map for the given tables."""
    return tables.select(
        *TABLE_KEY,
        F.lit(STATUS).alias("func"),
        F.lit("").alias("col"),
        F.lit(rules.TYPE_MAP_MISSING.removeprefix(rules.STATUS_TOKEN).strip()).alias("value"),
        F.lit(2**31 - 1).alias("position"),
    )


def encode_lines(profile: DataFrame, escape: bool = False) -> DataFrame:
    """Profile rows -> ``db, schema, table, value`` with one line per table."""
    name, text = F.col("col"), F.coalesce("value", F.lit(""))
    if escape:
        name, text = escaped(name), escaped(text)
    shown = F.when(F.col("func") == STATUS, F.concat(F.lit(rules.STATUS_TOKEN + " "), "value")).otherwise(
        F.concat("func", F.lit("("), name, F.lit("):"), text)
    )
    is_count = F.col("func") == COUNT
    metrics = F.array_sort(F.collect_list(F.when(~is_count, F.struct("position", shown.alias("shown")))))
    return (
        profile.groupBy(*TABLE_KEY)
        .agg(F.max(F.when(is_count, F.col("value"))).alias("row_count"), metrics.alias("metrics"))
        .select(
            *TABLE_KEY,
            F.concat_ws("|", *TABLE_KEY, "row_count", F.array_join(F.col("metrics.shown"), ",")).alias("value"),
        )
    )


def parse_lines(lines: DataFrame, whole: bool = False) -> DataFrame:
    """Split lines into identity, count, metric text and remark.

    ``reason`` tells why a line cannot be used: too few fields, or a count
    that is no integer. What follows a fifth ``|`` is cut off, unless ``whole``
    takes it as part of the metrics, whose values may hold one.
    """
    fields = F.split(strip(F.col("value")), r"\|", 5 if whole else -1)
    metric_text = strip(F.coalesce(F.get("fields", F.lit(4)), F.lit("")))
    has_status = F.contains("metric_text", F.lit(rules.STATUS_TOKEN))
    before_status = F.when(
        has_status, F.rtrim(strip(F.substring_index("metric_text", rules.STATUS_TOKEN, 1)), F.lit(","))
    ).otherwise(F.col("metric_text"))
    after_status = strip(F.get(F.split("metric_text", rules.STATUS_TOKEN), F.lit(1)))
    count = F.get("fields", F.lit(3))
    reason = F.when((F.size("fields") < 4) | ~F.coalesce(count.rlike(r"^\s*[+-]?\d+\s*$"), F.lit(False)), F.lit("Failed to parse GP Result"))
    return (
        lines.withColumn("fields", fields)
        .withColumn("metric_text", metric_text)
        .select(
            *lines.columns,
            *[strip(F.get("fields", F.lit(i))).alias(c) for i, c in enumerate(TABLE_KEY)],
            count.try_cast("bigint").alias("row_count"),
            before_status.alias("metric_text"),
            F.coalesce(F.concat(F.lit(rules.STATUS_TOKEN + " "), after_status), F.lit("")).alias("line_remark"),
            reason.alias("reason"),
        )
    )


def newest_lines(parsed: DataFrame) -> DataFrame:
    """The newest of the parsed lines per table, all columns; among equal times the greatest path wins.

    Tables are told apart by the identity inside the line, so that a base
    table and its partitions, or tables of two schemas, do not mix. More lines
    can be merged with the result and asked again.
    """
    kept = [c for c in parsed.columns if c not in TABLE_KEY]
    return (
        parsed.groupBy(*TABLE_KEY)
        .agg(F.max_by(F.struct(*kept), F.struct("modified", "path", "value")).alias("latest"))
        .select(*TABLE_KEY, *[f"latest.{c}" for c in kept])
    )


def latest_lines(parsed: DataFrame) -> DataFrame:
    """The newest line per table, without what only told it from others."""
    return newest_lines(parsed).select(*TABLE_KEY, "row_count", "metric_text", "line_remark", "reason", "path")


def _row(func: Column, col: Column, value: Column, position: Column) -> Column:
    return F.struct(func.alias("func"), col.alias("col"), value.alias("value"), position.alias("position"))


def decode_lines(parsed: DataFrame, escape: bool = False) -> DataFrame:
    """Parsed lines -> profile rows, with the count and any status note; ``escape`` as when they were encoded."""

    def group(i: int):
        return F.regexp_extract_all("metric_text", F.lit(METRIC), F.lit(i))

    found = F.arrays_zip(
        F.transform(group(1), F.upper).alias("func"),
        F.transform(group(2), strip).alias("col"),
        F.transform(group(3), strip).alias("value"),
    )
    # A metric named twice keeps its last value.
    last_of_name = F.filter(
        "found",
        lambda m, i: ~F.exists(
            F.slice(F.col("found"), i + 2, F.size("found")), lambda n: (n["func"] == m["func"]) & (n["col"] == m["col"])
        ),
    )
    plain = unescaped if escape else (lambda text: text)
    metrics = F.transform("kept", lambda m, i: _row(m["func"], plain(m["col"]), plain(m["value"]), i + 1))
    status = strip(F.replace("line_remark", F.lit(rules.STATUS_TOKEN), F.lit("")))
    notes = F.filter(F.array(_row(F.lit(STATUS), F.lit(""), status, F.lit(2**31 - 1))), lambda _: F.col("line_remark") != "")
    count = F.array(_row(F.lit(COUNT), F.lit(EVERY_ROW), F.col("row_count").cast("string"), F.lit(0)))
    return (
        parsed.where(F.col("reason").isNull())
        .withColumn("found", found)
        .withColumn("kept", last_of_name)
        .select(*TABLE_KEY, F.inline(F.concat(count, metrics, notes)))
    )
