"""The newest record per table, kept between runs: a run reads only the files that are new.

Logs and exported lines grow by files, and a table's newest record is a maximum
over an order without ties. So the newest of what was kept and of what new files
hold is the newest of all, and files read before need no second look. A state is
a folder of its own with the newest records and the list of files they come from;
the log of states, written last, says which one counts. A run that fails leaves
the state before it. Where a file read before has shrunk or is gone, what it
gave cannot be taken back: then everything is read again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from datetime import datetime, timezone
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.operators import control, lines
from tallymark.sinks.export import append_log
from tallymark.sources.control import read_line_files, read_success_log

STATES = "state string, ended timestamp"


class Refresh(NamedTuple):
    """``latest``: one row per table. ``files``: path, modified, length of the files that this run read."""

    latest: DataFrame
    files: DataFrame


def _listed(spark: SparkSession, paths: str | Sequence[str], recursive: bool) -> DataFrame:
    """path, modified, length of all files; their content is not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).load(paths)
    return found.select("path", F.col("modificationTime").alias("modified"), "length")


def _last_state(spark: SparkSession, folder: str) -> str | None:
    try:
        last = spark.read.schema(STATES).parquet(f"{folder}/states").agg(F.max_by("state", F.struct("ended", "state"))).first()[0]
    except AnalysisException as failure:
        if failure.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return last


def refreshed(
    spark: SparkSession,
    folder: str,
    files: DataFrame,
    read: Callable[[list[str]], DataFrame],
    newest: Callable[[DataFrame], DataFrame],
) -> Refresh:
    """Merge what new files hold into the state below ``folder``.

    ``files``: all files there are now. ``read(paths)`` gives the records of some
    of them, ``newest(records)`` the newest record per table with the same
    columns. The paths of new files pass through the driver.
    """
    state = _last_state(spark, folder)
    known = spark.read.parquet(f"{folder}/{state}/files") if state else None
    if known is not None:
        now = files.select("path", F.col("length").alias("length_now"))
        lost = known.join(now, "path", "left").where(F.coalesce(F.col("length_now") < F.col("length"), F.lit(True)))
        if lost.limit(1).count():
            known = None
    new = files if known is None else files.join(known, ["path", "modified", "length"], "left_anti")
    paths = sorted(r.path for r in new.select("path").collect())
    kept = spark.read.parquet(f"{folder}/{state}/latest") if known is not None else None
    if paths or kept is None:
        place = uuid.uuid4().hex
        records = read(paths) if paths else None
        if records is None:
            raise ValueError("There are no files to read")
        merged = records if kept is None else kept.unionByName(records)
        newest(merged).write.parquet(f"{folder}/{place}/latest")
        files.write.parquet(f"{folder}/{place}/files")
        entry = spark.createDataFrame([(place, datetime.now(timezone.utc))], STATES)
        append_log(entry.coalesce(1), path=f"{folder}/states")
        kept = spark.read.parquet(f"{folder}/{place}/latest")
    listed = spark.createDataFrame([(p,) for p in paths], "path string")
    return Refresh(kept, new.join(listed, "path", "left_semi"))


def refresh_success(
    spark: SparkSession, root: str, folder: str, positions: Sequence[str] | None = None, by_time: bool = False
) -> Refresh:
    """The newest success per table of all logs below ``root``; ``latest`` is as `control.latest_success` gives it, and ``order``."""
    files = _listed(spark, f"{root}/*/*/offloadgp_stat_succeeded.*.csv", recursive=False)

    def read(paths: list[str]) -> DataFrame:
        return control.success_records(read_success_log(spark, root, positions, paths), by_time)

    return refreshed(spark, folder, files, read, control.newest_success)


def refresh_lines(spark: SparkSession, root: str, folder: str) -> Refresh:
    """The newest line per table of all that `write_line_files` wrote below ``root``; ``latest`` goes to `lines.latest_lines`."""

    def read(paths: list[str]) -> DataFrame:
        return lines.parse_lines(read_line_files(spark, paths))

    return refreshed(spark, folder, _listed(spark, root, recursive=True), read, lines.newest_lines)
