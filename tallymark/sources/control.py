"""Readers of the control files that steer a run.

Lists and configurations are written by people, so one file is read as one
record: that keeps every line's place in its file, which decides between
repeated entries. Type maps grow with the columns of a table, and logs with
every run; both are read as splittable lines, and those of a type map are numbered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallymark.functions.text import separated, strip

# Header names of a type map and of a success log.
TYPE_MAP_HEADER = ["gp_column_nm", "gp_datatype", "ext_column_nm", "ext_datatype"]
SUCCESS_LOG_HEADER = ["Greenplum_Tbl", "Run_Status", "End_Timestamp_Script", "File_Path"]


def read_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``path, ordinal, value``: the lines of control files, in order."""
    return spark.read.text(paths, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"),
        F.posexplode(F.split("value", r"\r?\n")).alias("ordinal", "value"),
    )


def _numbered_lines(spark: SparkSession, paths: str) -> DataFrame:
    """``path, ordinal, value, first``: the lines of files as splittable rows, each with its file's first line; an empty file has none."""
    lines = spark.read.text(paths, lineSep="\n").select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        F.regexp_replace("value", r"\r$", "").alias("value"),
    )
    # Within a file rows are ordered by split, and in a split by the row id. The sort of a file spills.
    in_file = Window.partitionBy("path").orderBy("block", "row")
    ordinal = F.row_number().over(in_file) - 1
    return lines.select("path", ordinal.alias("ordinal"), "value", F.first("value").over(in_file).alias("first"))


def read_type_map(spark: SparkSession, root: str) -> DataFrame:
    """All type maps below ``root``, one file per table at ``<db>/<schema>/<table>.csv`` (or a folder of that name with one).

    Columns are found by their header, in any order. Ordinal 0 stands for the
    file itself, with no column names, so a map with a header only is told
    apart from a missing one. A map may have any number of columns: its lines
    are read as rows, and no row holds more of it than the header.
    """

    def cells(line):
        return F.transform(separated(line, "|"), strip)

    def cell(header: str):
        place = F.array_position("header", header)
        return F.when((place > 0) & (F.col("ordinal") > 0), F.get("cells", (place - 1).cast("int")))

    place = r"/([^/]+)/([^/]+)/([^/]+)\.csv(?:/[^/]+)?$"
    names = zip(TYPE_MAP_HEADER, ["gp_column", "gp_type", "ext_column", "ext_type"])
    return (
        _numbered_lines(spark, f"{root}/*/*/*.csv")
        .where((F.col("ordinal") == 0) | (strip(F.col("value")) != ""))
        .withColumn("cells", cells(F.col("value")))
        .withColumn("header", cells(F.col("first")))
        .select(
            *[F.url_decode(F.regexp_extract("path", place, i)).alias(c) for i, c in enumerate(["db", "schema", "table"], 1)],
            "ordinal",
            *[cell(header).alias(column) for header, column in names],
        )
    )


# Why a row of a success log is not used.
NO_HEADER = "The log has no header"
TOO_FEW_FIELDS = "The row ends before the table's name and status"


def _log_rows(
    spark: SparkSession, root: str, positions: Sequence[str] | None, paths: Sequence[str] | None = None
) -> DataFrame:
    """``path, ordinal, value, cells, header, reason`` of all rows of the success logs but headers and blank lines."""
    log = (
        spark.read.text(f"{root}/*/*/offloadgp_stat_succeeded.*.csv" if paths is None else list(paths))
        .withColumn("path", F.col("_metadata.file_path"))
        .withColumn("block", F.col("_metadata.file_block_start"))
    )
    # Within a file rows are ordered by split, and in a split by the row id,
    # whose lower 33 bits count the rows of a task.
    ordinal = F.col("block").cast("decimal(20,0)") * F.lit(1 << 33) + F.monotonically_increasing_id() % F.lit(1 << 33)
    line = F.regexp_replace("value", r"^\x{FEFF}|\r$", "")
    rows = log.select("path", "block", ordinal.alias("ordinal"), line.alias("value")).where(strip(F.col("value")) != "")
    rows = rows.withColumn("cells", separated(F.col("value"), ","))
    names = F.transform("cells", strip)
    table, status = (F.array_contains(names, name) for name in SUCCESS_LOG_HEADER[:2])
    # Only the first line of a file can be its header; of most rows nothing is kept.
    headers = (
        rows.where(F.col("block") == 0)
        .groupBy("path")
        .agg(F.min_by(F.when(table & status, names), F.struct("ordinal")).alias("header"))
    )
    fallback = F.lit(None).cast("array<string>") if positions is None else F.array(*map(F.lit, positions))

    def holds(header: str):
        return F.coalesce(F.array_position("header", header) <= F.size("cells"), F.lit(False))

    reason = (
        F.when(F.col("header").isNull(), NO_HEADER)
        .when(~(holds(SUCCESS_LOG_HEADER[0]) & holds(SUCCESS_LOG_HEADER[1])), TOO_FEW_FIELDS)
    )
    return (
        rows.where(~(table & status))
        .join(headers, "path", "left")
        .withColumn("header", F.coalesce("header", fallback))
        .select("path", "ordinal", "value", "cells", "header", reason.alias("reason"))
    )


def read_success_log(
    spark: SparkSession, root: str, positions: Sequence[str] | None = None, paths: Sequence[str] | None = None
) -> DataFrame:
    """All success logs at ``<db>/<run>/offloadgp_stat_succeeded.<schema>.csv``, a file or a folder of files.

    Every file is read by its own header, its first line, so the columns may come
    in any order, and any but the table's name and the status may be missing. A
    file without a header is read by ``positions``, the names of its columns, if
    they are given. ``paths`` reads only some of the files. Rows that cannot be
    read are in `rejected_log_rows`.
    """
    place = r"/([^/]+)/[^/]+/offloadgp_stat_succeeded\.([^/]+)\.csv(?:/[^/]+)?$"

    def cell(header: str):
        value = F.get("cells", F.nullif(F.array_position("header", header), F.lit(0)).cast("int") - 1)
        return F.when(value != "", value)

    columns = zip(SUCCESS_LOG_HEADER, ["name", "status", "ended", "file_path"])
    return (
        _log_rows(spark, root, positions, paths)
        .where(F.col("reason").isNull())
        .select(
            *[F.url_decode(F.regexp_extract("path", place, i)).alias(c) for i, c in enumerate(["db", "schema"], 1)],
            *[cell(header).alias(column) for header, column in columns],
            "path",
            "ordinal",
        )
    )


def rejected_log_rows(spark: SparkSession, root: str, positions: Sequence[str] | None = None) -> DataFrame:
    """``path, ordinal, value, reason``: the rows of success logs that cannot be used; nothing is dropped silently."""
    rows = _log_rows(spark, root, positions)
    return rows.where(F.col("reason").isNotNull()).select("path", "ordinal", "value", "reason")


def read_result_lines(
    spark: SparkSession, paths: str | list[str], one_per_file: bool = True, line_sep: str = "\n"
) -> DataFrame:
    """``value, path, modified``: exported profile lines.

    A file holds one line, which may hold line breaks inside a value; exports
    written by `tallymark.sinks.export` hold many (``one_per_file=False``),
    each ended by ``line_sep``.
    """
    separator = None if one_per_file else line_sep
    return spark.read.text(paths, wholetext=one_per_file, lineSep=separator).select(
        "value",
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_modification_time").alias("modified"),
    )


def read_line_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``value, path, modified``: the lines that `write_line_files` wrote, one per file, as they were."""
    files = spark.read.option("recursiveFileLookup", True).text(paths, wholetext=True)
    # The writer ends every record with one line feed, which is not the value's.
    return files.select(
        F.regexp_replace("value", r"\n\z", "").alias("value"),
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_modification_time").alias("modified"),
    )
