"""Copying the listed tables that changed, with a manifest of what was copied.

A cycle compares three things: the tables that are listed, the files at their
source, and the manifest, a log of ``db, schema, table, directory, modified, copy,
run, ended`` with one row per copy made. A table is copied when it never was, when
its source is newer than the copy (or of unknown age) or another one, or when the copy is gone.

Copies of a run lie in a folder of their own, ``<root>/<run>/...``, and the
manifest, written last, says which copy of a table counts. So a cycle that fails
or loses its driver leaves every table at its last good copy; what it had written
is not in the manifest and is copied again. Nothing is overwritten or deleted:
`superseded_copies` names the folders that may go.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone
from functools import reduce
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.operators.control import TABLE_KEY
from tallymark.sinks.export import append_log, write_unsorted
from tallymark.sources.tables import copy_shape, files_below, parquet_copy

MANIFEST = "db string, schema string, table string, directory string, modified timestamp, copy string, run string, ended timestamp"
OUTCOME = "db string, schema string, table string, reason string, status string, remark string"
# The column that names the table of a row while it is written.
_MEMBER = "ingest_no"


class Ingest(NamedTuple):
    """``results``: the key and reason (new, newer, moved, missing, current), status (COPIED, CURRENT, FAILED) and remark."""

    results: DataFrame
    run: str


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The manifest; empty before the first cycle."""
    try:
        return spark.read.schema(MANIFEST).parquet(path)
    except AnalysisException as failure:
        if failure.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)


def current_copies(manifest: DataFrame) -> DataFrame:
    """Per table the copy that counts: the last one made."""
    last = F.max_by(F.struct("directory", "modified", "copy", "run"), F.struct("ended", "run")).alias("last")
    return manifest.groupBy(*TABLE_KEY).agg(last).select(*TABLE_KEY, "last.directory", "last.modified", "last.copy", "last.run")


def superseded_copies(manifest: DataFrame) -> DataFrame:
    """Copies that do not count any more."""
    return manifest.join(current_copies(manifest).select("copy"), "copy", "left_anti").select(*TABLE_KEY, "copy")


def tables_to_copy(listed: DataFrame, files: DataFrame, manifest: DataFrame, copies: DataFrame) -> DataFrame:
    """Every listed table with the ``reason`` to copy it, or ``current``; NULL where the source has no files.

    ``listed``: db, schema, table, directory. ``files``: directory, modified, one
    row per file at the source. ``copies``: the column ``copy`` names those that
    are there.
    """
    newest = files.groupBy("directory").agg(F.max("modified").alias("found"), F.bool_or(F.col("modified").isNull()).alias("unknown"))
    there = copies.select("copy").distinct().withColumn("there", F.lit(True))
    last = current_copies(manifest).join(there, "copy", "left").select(*TABLE_KEY, "modified", "copy", "there", F.col("directory").alias("last_directory"))
    joined = listed.join(newest, "directory", "left").join(last, TABLE_KEY, "left")
    reason = (
        F.when(F.col("found").isNull() & F.col("unknown").isNull(), F.lit(None).cast("string"))
        .when(F.col("copy").isNull(), "new")
        .when(F.col("there").isNull(), "missing")
        .when(F.col("directory") != F.col("last_directory"), "moved")
        .when(F.col("unknown") | F.col("modified").isNull() | (F.col("found") > F.col("modified")), "newer")
        .otherwise("current")
    )
    return joined.select(*TABLE_KEY, "directory", F.col("found").alias("modified"), reason.alias("reason"))


def _now() -> datetime:
    return datetime.now(timezone.utc)


def _free(shape: tuple) -> str:
    """A name for the table's column that none of the copy's columns has."""
    taken, name = {column for column, _ in shape}, _MEMBER
    while name in taken:
        name += "_"
    return name


def _copy_together(spark: SparkSession, members: Sequence[tuple], column: str, folder: str) -> None:
    """Copies of tables with the same columns, in one job, each to the folder named by its number."""
    write_unsorted(spark)
    named = [parquet_copy(spark, directory).withColumn(column, F.lit(number)) for number, _, directory, _ in members]
    reduce(DataFrame.unionByName, named).write.partitionBy(column).parquet(folder)


def _copied(spark: SparkSession, members: Sequence[tuple], column: str, folder: str) -> list[tuple[tuple, str | None, str | None]]:
    """The copies made and the errors of the rest; a job that fails is tried again in halves."""
    place = f"{folder}/{uuid.uuid4().hex}"
    try:
        _copy_together(spark, members, column, place)
    except Exception as failure:
        if len(members) == 1:
            return [(members[0], None, str(failure))]
        middle = len(members) // 2
        return _copied(spark, members[:middle], column, folder) + _copied(spark, members[middle:], column, folder)
    for number, _, directory, _ in members:
        # A table without rows leaves no file; its copy still has its columns.
        if isinstance(copy_shape(spark, f"{place}/{column}={number}"), str):
            parquet_copy(spark, directory).write.mode("overwrite").parquet(f"{place}/{column}={number}")
    return [(member, place, None) for member in members]


def ingest_changed(
    spark: SparkSession, listed: DataFrame, root: str, manifest_path: str, batch_size: int = 50, batches_at_once: int = 4
) -> Ingest:
    """One cycle: copy every listed table that needs it, then add the copies to the manifest.

    ``listed`` has db, schema, table and ``directory``, the Parquet source. Tables
    with the same columns are copied together, some batches side by side; one that
    cannot be read or copied fails alone. Only names, paths and column names pass
    through the driver.
    """
    run = uuid.uuid4().hex
    listed = listed.select(*TABLE_KEY, F.regexp_replace("directory", "/+$", "").alias("directory")).dropDuplicates(TABLE_KEY)
    rows = listed.collect()
    # Looking at a source waits for storage.
    with ThreadPoolExecutor(16) as pool:
        shapes = list(pool.map(lambda r: copy_shape(spark, r.directory), rows))
    outcomes = [(r.db, r.schema, r.table, None, "FAILED", s) for r, s in zip(rows, shapes) if isinstance(s, str)]
    readable = {(r.db, r.schema, r.table): s for r, s in zip(rows, shapes) if not isinstance(s, str)}
    directories = sorted({r.directory for r in rows if (r.db, r.schema, r.table) in readable})

    manifest = read_manifest(spark, manifest_path)
    known = [r.copy for r in current_copies(manifest).join(listed, TABLE_KEY, "left_semi").select("copy").collect()]
    copies = spark.createDataFrame([(c,) for c in _there(spark, known)], "copy string")
    plan = tables_to_copy(listed, files_below(spark, directories), manifest, copies)
    plan = plan.withColumn("modified", F.unix_micros("modified")).collect()

    families = defaultdict(list)
    for number, row in enumerate(sorted(plan, key=lambda r: (r.db, r.schema, r.table))):
        table = (row.db, row.schema, row.table)
        if table in readable and row.reason == "current":
            outcomes.append((*table, "current", "CURRENT", ""))
        elif table in readable:
            families[readable[table]].append((number, table, row.directory, row))
    batches = [(shape, members[i : i + batch_size]) for shape, members in families.items() for i in range(0, len(members), batch_size)]
    with ThreadPoolExecutor(batches_at_once) as pool:
        done = list(pool.map(lambda b: (_free(b[0]), _copied(spark, b[1], _free(b[0]), f"{root}/{run}")), batches))

    entries = []
    for column, made in done:
        for (number, table, directory, row), place, error in made:
            outcomes.append((*table, row.reason, "FAILED" if error else "COPIED", error or ""))
            if not error:
                entries.append((*table, directory, row.modified, f"{place}/{column}={number}", run, _now()))
    if entries:
        made_now = spark.createDataFrame(entries, MANIFEST.replace("modified timestamp", "modified long"))
        append_log(made_now.withColumn("modified", F.timestamp_micros("modified")).coalesce(1), path=manifest_path)
    return Ingest(spark.createDataFrame(outcomes, OUTCOME), run)


def _there(spark: SparkSession, copies: Sequence[str]) -> list[str]:
    """The copies of which at least one file is there."""
    with ThreadPoolExecutor(16) as pool:
        found = list(pool.map(lambda c: not isinstance(copy_shape(spark, c), str), copies))
    return [c for c, there in zip(copies, found) if there]
