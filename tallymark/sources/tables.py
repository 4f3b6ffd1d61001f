"""Readers of source tables and offloaded copies, and incremental ingest."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.sinks.export import write_unsorted


def jdbc_options(
    url: str,
    query: str | None = None,
    table: str | None = None,
    where: str | None = None,
    split_on: str | None = None,
    bounds: tuple[object, object] | None = None,
    splits: int | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Options of Spark's JDBC reader for a source table.

    Without a split column the database sends everything over one connection;
    give ``split_on``, ``bounds`` and ``splits`` for anything large. The
    predicate runs in the database.
    """
    if (query is None) == (table is None):
        raise ValueError("Give either a query or a table")
    options = {"url": url, "fetchsize": str(fetch_size)}
    has_where = where is not None and where.strip().lower() not in ("", "none")
    if table is not None:
        query = f"SELECT * FROM {table}"
        if has_where:
            query += f" WHERE {where}"
    elif has_where:
        raise ValueError("A predicate goes into the query itself")
    if split_on is None:
        return options | {"query": query}
    if bounds is None or splits is None:
        raise ValueError("A split column needs bounds and a number of splits")
    return options | {
        "dbtable": f"({query}) AS source",
        "partitionColumn": split_on,
        "lowerBound": str(bounds[0]),
        "upperBound": str(bounds[1]),
        "numPartitions": str(splits),
    }


def jdbc_source(spark: SparkSession, url: str, properties: Mapping[str, str] | None = None, **choices) -> DataFrame:
    """A source table over JDBC; see `jdbc_options` for the choices."""
    return spark.read.format("jdbc").options(**jdbc_options(url, **choices), **(properties or {})).load()


def parquet_copy(spark: SparkSession, path: str) -> DataFrame:
    """One offloaded table, with the schema of its files."""
    return spark.read.parquet(path)


# Error texts that the failure classes look for.
PATH_MISSING = "Local path not found or inaccessible: "
AGGREGATION_FAILED = "Spark Parquet Aggregation Failed: "


def copy_shape(spark: SparkSession, path: str) -> tuple | str:
    """Names and types of a copy's columns, or the error why it cannot be read."""
    try:
        return tuple(sorted((f.name.lower(), f.dataType.simpleString()) for f in parquet_copy(spark, path).schema))
    except AnalysisException as failure:
        return PATH_MISSING + path if failure.getCondition() == "PATH_NOT_FOUND" else AGGREGATION_FAILED + str(failure)
    except Exception as failure:  # a file that is no Parquet at all
        return AGGREGATION_FAILED + str(failure)


def parquet_family(
    spark: SparkSession, paths: Mapping[str, str], column: str = "table", merge_schemas: bool = True
) -> DataFrame:
    """All physical partitions of a table as one DataFrame.

    ``paths`` gives the directory of each partition, and ``column`` gets the
    name of the partition a row came from, by the last part of the directory.
    Without ``merge_schemas`` all of them must have the same columns.
    """
    names = {directory.rstrip("/").rsplit("/", 1)[-1]: table for table, directory in paths.items()}
    if len(names) < len(paths):
        raise ValueError("Two partitions have the same directory name")
    encoded = F.substring_index(F.substring_index("_metadata.file_path", "/", -2), "/", 1)
    directory = F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))
    family = spark.read.option("mergeSchema", merge_schemas).parquet(*paths.values())
    if all(last == table for last, table in names.items()):
        return family.withColumn(column, directory)
    named = spark.createDataFrame(list(names.items()), ["last directory", column])
    # A row for each path that was given; shuffled, all rows of a partition would meet in one task.
    return family.withColumn("last directory", directory).join(F.broadcast(named), "last directory", "left").drop("last directory")


# --- incremental ingest ------------------------------------------------------


def table_files(spark: SparkSession, directories: str | list[str]) -> DataFrame:
    """``directory, modified`` of every Parquet file; no file content is read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", True)
        .load(directories)
        .select(F.regexp_extract("path", "^(.*)/[^/]+$", 1).alias("directory"), F.col("modificationTime").alias("modified"))
    )


def _bare(path: Column) -> Column:
    """A path without scheme and host, so that one path reads the same everywhere."""
    return F.regexp_replace(path, "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")


def files_below(spark: SparkSession, directories: Sequence[str]) -> DataFrame:
    """``directory, modified`` of every Parquet file below the given directories, at any depth; none of their content is read."""
    if not directories:
        return spark.createDataFrame([], "directory string, modified timestamp")
    listed = spark.createDataFrame([(d,) for d in directories], "directory string").withColumn("bare", _bare(F.col("directory")))
    found = table_files(spark, list(directories))
    parts = F.split(_bare(F.col("directory")), "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    return found.select("modified", F.explode(above).alias("bare")).join(listed, "bare").select("directory", "modified")


def changed_tables(files: DataFrame, manifest: DataFrame, key: str = "directory") -> DataFrame:
    """Tables to ingest: never ingested, newer than last time, or of unknown age.

    ``manifest`` is a log of ``key, modified``, one row per ingest.
    """
    newest = files.groupBy(key).agg(F.max("modified").alias("modified"), F.bool_or(F.col("modified").isNull()).alias("unknown"))
    ingested = manifest.groupBy(key).agg(F.max("modified").alias("ingested"))
    return (
        newest.join(ingested, key, "left")
        .where(F.col("ingested").isNull() | F.col("unknown") | (F.col("modified") > F.col("ingested")))
        .select(key, "modified", F.when(F.col("ingested").isNull(), "new").otherwise("newer").alias("reason"))
    )


def ingest(spark: SparkSession, source: str, target: str) -> None:
    """Copy one table's Parquet files, replacing what is at the target."""
    spark.read.parquet(source).write.mode("overwrite").parquet(target)


def ingest_family(spark: SparkSession, sources: Mapping[str, str], target: str, column: str = "table") -> None:
    """Copy the given physical partitions of a table in one job.

    Each lands in a folder of its own below ``target``, replacing what is
    there; partitions not given stay as they are. Rows are neither shuffled nor sorted.
    """
    write_unsorted(spark)
    writer = parquet_family(spark, sources, column).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(target)
