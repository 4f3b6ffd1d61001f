"""The tables that steer a run: lists, metric configuration, type maps, logs.

Control lines come in as ``value``, ``path`` and ``ordinal`` (the line's place
in its file), see `tallymark.sources.control`. Latest-record choices are
``max_by`` aggregates over an ordering without ties: they combine before the
shuffle, so a table with very many records is no burden.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.functions import rules, text, types
from tallymark.functions.text import strip

TABLE_KEY = ["db", "schema", "table"]
# Words for "all columns" and "not set" (any case).
ALL_COLUMNS, UNSET = "ALL", "none"
NO_KEYS = "No key columns given"


def is_set(value: Column) -> Column:
    """Neither blank nor the word for "not set"."""
    bare = F.lower(strip(F.coalesce(value, F.lit(""))))
    return (bare != "") & (bare != UNSET)


def name_list(value: Column) -> Column:
    """``"a, b,,c"`` -> ``[a, b, c]``; empty when not set."""
    names = F.filter(F.transform(F.split(value, ","), strip), lambda n: n != "")
    return F.when(is_set(value), names).otherwise(F.array().cast("array<string>"))


# --- table lists -------------------------------------------------------------


def parse_table_list(lines: DataFrame, with_keys: bool = False) -> DataFrame:
    """One row per entry, with a ``reason`` where the entry is malformed.

    Entries read ``DB|Schema.Table``, or ``DB|Schema.Table|KEYS`` with
    ``with_keys``. Blank lines and ``#`` comments are left out.
    """
    parts = F.split("entry", r"\|")
    names = F.split(strip(F.get(parts, F.lit(1))), r"\.")
    enough = F.size(parts) >= 3 if with_keys else F.size(parts) == 2
    expected = "DB|Schema.Table|KEY_COLS" if with_keys else "DB|Schema.Table"
    reason = (
        F.when(~enough, F.lit(f"expected {expected}"))
        .when(F.size(names) != 2, F.lit("expected one dot in Schema.Table"))
    )
    columns = [
        strip(F.get(parts, F.lit(0))).alias("db"),
        strip(F.get(names, F.lit(0))).alias("schema"),
        strip(F.get(names, F.lit(1))).alias("table"),
    ]
    if with_keys:
        columns.append(strip(F.get(parts, F.lit(2))).alias("key_cols"))
    return (
        lines.withColumn("entry", strip(F.col("value")))
        .where((F.col("entry") != "") & ~F.col("entry").startswith("#"))
        .select("path", "ordinal", "entry", *columns, reason.alias("reason"))
    )


def listed_tables(parsed: DataFrame) -> DataFrame:
    """The well-formed entries, with the base table of each partition."""
    return parsed.where(F.col("reason").isNull()).select(
        *[c for c in parsed.columns if c not in ("entry", "reason")],
        text.base_table(F.col("table")).alias("base_table"),
        text.partition_suffix(F.col("table")).alias("part"),
    )


def rejected_entries(parsed: DataFrame) -> DataFrame:
    """The malformed entries and why; nothing is dropped silently."""
    return parsed.where(F.col("reason").isNotNull()).select("path", "ordinal", "entry", "reason")


# --- metric configuration ----------------------------------------------------


def parse_master_config(lines: DataFrame) -> DataFrame:
    """``db|schema|table|sum_cols|where`` per line; a later line replaces an earlier one.

    A field in double quotes may hold ``|``.
    """
    parts = F.transform(text.separated(F.col("value"), "|"), strip)
    fields = [F.get("parts", F.lit(i)).alias(c) for i, c in enumerate(TABLE_KEY + ["sum_cols", "where"])]
    return (
        lines.withColumn("parts", parts)
        .where(F.size("parts") >= 5)
        .select("path", "ordinal", *fields)
        .groupBy(*TABLE_KEY)
        .agg(F.max_by(F.struct("sum_cols", "where"), F.struct("path", "ordinal")).alias("last"))
        .select(*TABLE_KEY, "last.sum_cols", "last.where")
    )


def with_master_config(tables: DataFrame, master: DataFrame) -> DataFrame:
    """Add ``sum_cols``, ``where`` and ``has_config`` to every listed table."""
    return tables.join(master.withColumn("has_config", F.lit(True)), TABLE_KEY, "left").withColumn(
        "has_config", F.coalesce("has_config", F.lit(False))
    )


def without_master_config(tables: DataFrame, master: DataFrame) -> DataFrame:
    return tables.join(master, TABLE_KEY, "left_anti")


# --- type maps ---------------------------------------------------------------


def type_map_presence(type_map: DataFrame) -> DataFrame:
    """Per table with a type map: how many columns it names."""
    named = strip(F.coalesce("gp_column", F.lit(""))) != ""
    return type_map.groupBy(*TABLE_KEY).agg(F.count_if(named).alias("mapped_columns"))


def metric_types(type_map: DataFrame, exact: bool = False) -> DataFrame:
    """Source type per table and column name, for comparing.

    By default the copy's column name is the key, as written. With ``exact``
    it is the source's column name in lower case, which also serves names that
    hold capitals or differ between the sides.
    """
    key = F.lower(strip(F.col("gp_column"))) if exact else strip(F.col("ext_column"))
    source_type = F.lower(strip(F.col("gp_type")))
    return (
        type_map.select(*TABLE_KEY, "ordinal", key.alias("type_key"), source_type.alias("source_type"))
        .where((F.col("type_key") != "") & (F.col("source_type") != ""))
        .groupBy(*TABLE_KEY, "type_key")
        .agg(F.max_by("source_type", "ordinal").alias("source_type"))
    )


def export_metrics(tables: DataFrame, type_map: DataFrame) -> DataFrame:
    """The metrics to export, one row each, for tables with a configuration.

    SUM for the configured columns, then MIN and MAX for every mapped column
    that allows them; ``position`` keeps that order.
    """
    sums = tables.select(*TABLE_KEY, F.posexplode(name_list(F.col("sum_cols"))).alias("place", "col")).select(
        *TABLE_KEY, F.lit("SUM").alias("func"), "col", F.struct(F.lit(0).alias("rank"), F.col("place").cast("bigint").alias("place")).alias("position")
    )
    ordered = type_map.where(
        (strip(F.coalesce("gp_column", F.lit(""))) != "") & types.is_min_max_candidate(F.col("gp_type"), F.col("ext_type"))
    ).select(*TABLE_KEY, strip(F.col("gp_column")).alias("col"), F.col("ordinal").alias("place"))
    extremes = (
        ordered.join(tables, TABLE_KEY, "left_semi")
        .withColumn("f", F.explode(F.array(F.struct(F.lit(1).alias("rank"), F.lit("MIN").alias("func")), F.struct(F.lit(2).alias("rank"), F.lit("MAX").alias("func")))))
        .select(*TABLE_KEY, "f.func", "col", F.struct("f.rank", F.col("place").cast("bigint").alias("place")).alias("position"))
    )
    return sums.unionByName(extremes)


# --- special-encoding columns ------------------------------------------------


def special_columns(config: DataFrame) -> DataFrame:
    """Active special-encoding columns per table, in lower case and sorted."""

    def clean(column: str) -> Column:
        return F.lower(strip(F.col(column)))

    return (
        config.where(F.upper("active_flag") == "Y")
        .select(
            clean("database_name").alias("db_key"),
            clean("original_table_name").alias("table_key"),
            clean("th_column_name").alias("column"),
        )
        .groupBy("db_key", "table_key")
        .agg(F.array_sort(F.collect_set("column")).alias("special"))
    )


def with_special_columns(tables: DataFrame, special: DataFrame) -> DataFrame:
    """Add the special columns of every table; an empty list where there are none."""
    keyed = tables.withColumns(
        {
            "db_key": F.lower("db"),
            "table_key": F.lower(F.concat_ws(".", "schema", "table")),
        }
    )
    return (
        keyed.join(special, ["db_key", "table_key"], "left")
        .drop("db_key", "table_key")
        .withColumn("special", F.coalesce("special", F.array().cast("array<string>")))
    )


# --- success logs ------------------------------------------------------------


def success_records(log: DataFrame, by_time: bool = False) -> DataFrame:
    """The successes in a log by the table they are about: the key, ``file_path, ended`` and the ``order`` that the newest is last in.

    Input: ``db, schema, name, status, ended, file_path, path, ordinal``. A
    table may be logged by its name or as ``schema.table``; the plain name
    wins. End times compare as text, or as times with ``by_time``. Among equal
    times the record in the greatest log path wins, then the earliest in it.
    """
    qualified = F.startswith("name", F.concat("schema", F.lit(".")))
    table = F.when(qualified, F.substring("name", F.length("schema") + 2, F.length("name"))).otherwise(F.col("name"))
    ended = F.coalesce("ended", F.lit(""))
    order = F.struct(
        (~qualified).alias("plain"),
        *([ended.try_cast("timestamp").alias("time")] if by_time else []),
        ended.alias("ended"),
        "path",
        (-F.col("ordinal")).alias("early"),
    )
    return log.where((F.coalesce("name", F.lit("")) != "") & (F.col("status") == "SUCCEEDED")).select(
        "db", "schema", table.alias("table"), "file_path", ended.alias("ended"), order.alias("order")
    )


def newest_success(records: DataFrame) -> DataFrame:
    """The last record per table; more records can be merged with the result and asked again."""
    latest = F.max_by(F.struct("file_path", "ended", "order"), "order").alias("latest")
    return records.groupBy(*TABLE_KEY).agg(latest).select(*TABLE_KEY, "latest.file_path", "latest.ended", "latest.order")


def latest_success(log: DataFrame, by_time: bool = False) -> DataFrame:
    """The newest success per table and the copy's path it names; see `success_records` for the rules."""
    return newest_success(success_records(log, by_time)).drop("order")


def with_copy_path(
    tables: DataFrame, latest: DataFrame, old: str | None = None, new: str | None = None
) -> DataFrame:
    """Add the copy's path, rewritten from one mount to another, and ``has_copy``."""
    found = latest.select(
        *TABLE_KEY, text.rewrite_path(F.col("file_path"), old, new).alias("file_path"), F.lit(True).alias("has_copy")
    )
    return tables.join(found, TABLE_KEY, "left").withColumn("has_copy", F.coalesce("has_copy", F.lit(False)))


# --- key columns -------------------------------------------------------------


def resolve_keys(tables: DataFrame, type_map: DataFrame) -> DataFrame:
    """The key columns of every listed table, or why it cannot be digested.

    ``keys`` is NULL for ``ALL``. A key must be a mapped column, in any case;
    ``error`` names the first that is not.
    """
    wants_all = F.upper("key_cols") == ALL_COLUMNS
    keys = F.filter(F.transform(F.split("key_cols", ","), strip), lambda k: k != "")
    listed = tables.withColumn("keys", F.when(~wants_all, keys))
    mapped = (
        type_map.select(*TABLE_KEY, F.lower(strip(F.col("gp_column"))).alias("key_name"))
        .where(F.col("key_name") != "")
        .distinct()
        .withColumn("known", F.lit(True))
    )
    first_unknown = (
        listed.select(*TABLE_KEY, "key_cols", F.posexplode("keys").alias("place", "key"))
        .withColumn("key_name", F.lower("key"))
        .join(mapped, TABLE_KEY + ["key_name"], "left")
        .where(F.col("known").isNull())
        .groupBy(*TABLE_KEY, "key_cols")
        .agg(F.min_by("key", "place").alias("unknown"))
    )
    error = (
        F.when(F.col("has_columns").isNull(), F.lit("No columns found"))
        .when(~F.coalesce(wants_all, F.lit(False)) & (F.coalesce(F.size("keys"), F.lit(0)) <= 0), F.lit(NO_KEYS))
        .when(
            F.col("unknown").isNotNull(),
            F.concat(
                F.lit("Key column '"), "unknown", F.lit("' not found in table '"), "schema", F.lit("."), "table", F.lit("'")
            ),
        )
    )
    return (
        listed.join(mapped.select(*TABLE_KEY, F.col("known").alias("has_columns")).distinct(), TABLE_KEY, "left")
        .join(first_unknown, TABLE_KEY + ["key_cols"], "left")
        .select(*tables.columns, "keys", error.alias("error"))
    )


# --- export outcome ----------------------------------------------------------


def export_results(tables: DataFrame, type_map: DataFrame, errors: DataFrame | None = None) -> DataFrame:
    """Status and remark per table of an export run.

    ``tables`` comes from `with_master_config`; ``errors`` holds the key and
    an ``error`` text of the tables that failed.
    """
    joined = tables.join(
        type_map.select(*TABLE_KEY).distinct().withColumn("has_type_map", F.lit(True)), TABLE_KEY, "left"
    ).withColumn("has_type_map", F.coalesce("has_type_map", F.lit(False)))
    if errors is None:
        joined = joined.withColumn("error", F.lit(None).cast("string"))
    else:
        joined = joined.join(errors.select(*TABLE_KEY, "error"), TABLE_KEY, "left")
    flags = F.col("has_config"), F.col("has_type_map"), F.col("error")
    return joined.select(
        *TABLE_KEY,
        rules.export_status(*flags).alias("status"),
        rules.export_remark(*flags).alias("remark"),
    )
