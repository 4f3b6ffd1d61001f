"""Writers of profile lines, content rows and result logs."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallymark.functions.text import strip

CONTENT = ["hash_key", "key", "hash_content", "content"]


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the shared folder that the session names.

    ``spark.checkpoint.dir`` is a path that every executor sees; without it the
    folder lies in the warehouse, which they share as well.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


#: Folders of a partitioned write that a task keeps open at a time.
FOLDERS_AT_ONCE = 8


def write_unsorted(spark: SparkSession) -> None:
    """Let tasks write to some folders side by side, unless the session asks for another number of them than Spark's own.

    Else Spark sorts all rows of a task by folder before it writes the first. A task
    that meets more folders sorts only what is left.
    """
    name = "spark.sql.maxConcurrentOutputFileWriters"
    if spark.conf.get(name) == "0":
        spark.conf.set(name, str(FOLDERS_AT_ONCE))


def write_lines(
    lines: DataFrame, path: str, run_date: date | str, gzip: bool = False, line_sep: str = "\n"
) -> None:
    """Profile lines as text, one folder per run date; no header.

    A file holds many lines. If values may hold line breaks, give another
    ``line_sep``, here and to the reader. A value that holds the separator
    would come back as two lines, so it raises.
    """
    broken = F.raise_error(F.concat(F.lit("A value holds the line separator: "), F.substring("value", 1, 200)))
    whole = F.when(F.contains("value", F.lit(line_sep)), broken).otherwise(F.col("value"))
    writer = lines.select(whole.alias("value")).write.mode("append").option("lineSep", line_sep)
    writer.option("compression", "gzip" if gzip else "none").text(f"{path}/run_date={run_date}")


def write_line_files(lines: DataFrame, path: str, run_date: date | str, gzip: bool = False) -> None:
    """Profile lines as one file per table, at ``run_date=.../db=.../schema=.../table=...``; no header.

    A file is one record, whatever its value holds, line breaks included, and a
    line that cannot be read later spoils no other table's. The identity is taken
    from the line. Read them with `read_line_files`.
    """
    identity = F.split("value", r"\|")
    named = lines.select(
        "value",
        F.lit(str(run_date)).alias("run_date"),
        *[strip(F.get(identity, F.lit(i))).alias(c) for i, c in enumerate(["db", "schema", "table"])],
    )
    writer = named.write.mode("append").partitionBy("run_date", "db", "schema", "table")
    writer.option("compression", "gzip" if gzip else "none").text(path)


def write_content(rows: DataFrame, path: str, form: str = "text", gzip: bool = False) -> None:
    """Content rows as bare ``|``-separated text, or as Parquet.

    Text is not quoted or escaped, so values that hold ``|`` or line breaks
    cannot be told apart again; Parquet keeps all four columns as they are.
    """
    if form == "parquet":
        rows.select(*CONTENT).write.mode("overwrite").option("compression", "gzip" if gzip else "snappy").parquet(path)
    elif form == "text":
        joined = rows.select(F.concat_ws("|", *CONTENT).alias("value"))
        joined.write.mode("overwrite").option("compression", "gzip" if gzip else "none").text(path)
    else:
        raise ValueError(f"Form '{form}' is neither text nor parquet")


def append_log(rows: DataFrame, table: str | None = None, path: str | None = None) -> None:
    """Append log rows of a whole run to a table or to Parquet files.

    A failed append raises; the run does not go on without its log.
    """
    if (table is None) == (path is None):
        raise ValueError("Give either a table or a path")
    writer = rows.write.mode("append").format("parquet")
    writer.saveAsTable(table) if table else writer.save(path)


def replace_log(rows: DataFrame, path: str) -> None:
    """Write log rows so that those of a run replace what the same run wrote before.

    The log is partitioned by ``execution_id``, and only the partitions of the runs
    in ``rows`` are exchanged; other runs stay as they are, so a run that is started
    again doubles nothing. Read it with `read_log`.
    """
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("execution_id").parquet(path)


def read_log(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A log that `replace_log` wrote, with the columns of ``schema``, so that an id that looks like a number stays text."""
    return spark.read.schema(schema).parquet(path).select(*schema.names)
