"""Exporting the profiles of the listed source tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tallymark.functions import text
from tallymark.operators import control, lines
from tallymark.operators.control import TABLE_KEY
from tallymark.operators.profile import COUNT, EVERY_ROW, Metric, filtered, profile_family, profile_table
from tallymark.plans.batches import Request, write_profiles


class Export(NamedTuple):
    lines: DataFrame
    results: DataFrame


def planned_families(tables: DataFrame, metrics: DataFrame, together: bool = True) -> DataFrame:
    """What to profile in one go: ``db, schema, base_table, metrics, members``.

    ``tables``: the key, base_table and where. ``metrics``: from
    `control.export_metrics`. Partitions of one table with the same metrics are
    one family, its members with their predicates; without ``together`` every
    table is a family of its own. The lists are made where the rows are, so the
    driver sees a row per family and not one per table and metric.
    """
    listed = F.array_sort(F.collect_list(F.struct("position", "func", "col")))
    of_table = metrics.groupBy(*TABLE_KEY).agg(F.transform(listed, lambda m: F.struct(m["func"].alias("func"), m["col"].alias("col"))).alias("metrics"))
    none = F.array().cast("array<struct<func:string,col:string>>")
    rows = tables.join(of_table, TABLE_KEY, "left").withColumn("metrics", F.coalesce("metrics", none))
    apart = [] if together else ["table"]
    return (
        rows.groupBy("db", "schema", "base_table", *apart, "metrics")
        .agg(F.array_sort(F.collect_list(F.struct("table", "where"))).alias("members"))
        .select("db", "schema", "base_table", "metrics", "members")
    )


def kept_of_family(column: str, wheres: dict[str, str | None]):
    """The rows of the given members, each by its own predicate; members with the same one share a condition."""
    by_predicate: dict[str, list[str]] = {}
    for member, where in wheres.items():
        kept = None if where is None or where.strip().lower() in ("", "none") else where
        by_predicate.setdefault(kept, []).append(member)
    conditions = [
        text.name(column).isin(members) & (F.lit(True) if where is None else F.expr(f"(\n{where}\n)"))
        for where, members in by_predicate.items()
    ]
    return reduce(lambda a, b: a | b, conditions)


def _unseen(tables: DataFrame, metrics: DataFrame, profiles: DataFrame) -> DataFrame:
    """Profile rows of the given tables that a grouped aggregate has no group for: they have no rows."""
    empty = tables.select(*TABLE_KEY).distinct().join(profiles.select(*TABLE_KEY).distinct(), TABLE_KEY, "left_anti")
    place = F.struct(F.lit(-1).alias("rank"), F.lit(-1).cast("bigint").alias("place"))
    counts = empty.select(*TABLE_KEY, F.lit(COUNT).alias("func"), F.lit(EVERY_ROW).alias("col"), F.lit("0").alias("value"), place.alias("order"))
    nothing = F.when(F.col("func") == "SUM", "0").otherwise("")
    rows = metrics.join(empty, TABLE_KEY, "left_semi").select(*TABLE_KEY, "func", "col", nothing.alias("value"), F.col("position").alias("order"))
    every = counts.unionByName(rows).groupBy(*TABLE_KEY).agg(F.array_sort(F.collect_list(F.struct("order", "func", "col", "value"))).alias("rows"))
    return every.select(*TABLE_KEY, F.posexplode("rows").alias("position", "row")).select(*TABLE_KEY, "row.func", "row.col", "row.value", "position")


def export_profiles(
    spark: SparkSession,
    tables: DataFrame,
    master: DataFrame,
    type_map: DataFrame,
    read_table: Callable[[str, str, str], DataFrame] | None,
    folder: str,
    batch_size: int = 50,
    aggregate: Callable[..., DataFrame] | None = None,
    read_family: Callable[[str, str, str], DataFrame] | None = None,
    family_column: str = "table",
    escaped: bool = False,
    **options,
) -> Export:
    """Profile every listed table that has a configuration.

    One of three says where profiles come from. ``read_table(db, schema, table)``
    gives the rows of the source table, from JDBC or any other reader, and Spark
    takes the profile. With ``aggregate(db, schema, table, metrics, where)`` the
    source takes it and one row comes back, e.g. ``partial(profile_at_source,
    jdbc_aggregates(spark, url))``; rows are not read then. ``read_family(db,
    schema, base_table)`` gives the rows of all partitions of a table,
    ``family_column`` naming the partition of each: listed partitions with the same
    metrics are one grouped aggregate, whatever their number, each under its own
    predicate.

    Only the plan passes through the driver, a family at a time: names of tables and
    of their columns. The profiles are written to a new folder of this run below
    ``folder``; returned are the lines to export and the status of every table.
    A table listed twice counts once. ``escaped`` goes to `encode_lines`, other
    ``options`` to `profile`.
    """
    if sum(given is not None for given in (read_table, aggregate, read_family)) != 1:
        raise ValueError("Give one of: a reader of rows, an aggregate, a reader of families")
    folder = f"{folder}/{uuid.uuid4().hex}"
    tables = tables.dropDuplicates(TABLE_KEY)
    configured = control.with_master_config(tables, master)
    chosen = configured.where("has_config").select(*TABLE_KEY, "sum_cols", "where", text.base_table(F.col("table")).alias("base_table"))
    metrics = control.export_metrics(chosen, type_map)

    def request(row: Row) -> Request:
        wanted = [Metric(m.func, m.col) for m in row.metrics]
        wheres = {m.table: m.where for m in row.members}

        def build(members):
            if read_family is not None:
                own = kept_of_family(family_column, {table: wheres[table] for _, _, table in members})
                family = read_family(row.db, row.schema, row.base_table).where(own)
                return profile_family(family, row.db, row.schema, wanted, family_column, **options)
            (table,) = members
            if aggregate is not None:
                return aggregate(*table, wanted, wheres[table[2]])
            return profile_table(filtered(read_table(*table), wheres[table[2]]), *table, wanted, **options)

        return Request(tuple((row.db, row.schema, table) for table in wheres), build)

    def requests() -> Iterator[Request]:
        plan = planned_families(chosen, metrics, together=read_family is not None)
        return map(request, plan.orderBy("db", "schema", "base_table").toLocalIterator(prefetchPartitions=True))

    outcomes = write_profiles(spark, requests(), folder, batch_size)
    errors = spark.createDataFrame(
        [(*o.table, o.error) for o in outcomes if o.error], "db string, schema string, table string, error string"
    )
    profiles = spark.read.parquet(folder)
    if read_family is not None:
        profiles = profiles.unionByName(_unseen(chosen.join(errors, TABLE_KEY, "left_anti"), metrics, profiles))
    unmapped = profiles.select(*TABLE_KEY).distinct().join(type_map, TABLE_KEY, "left_anti")
    noted = profiles.unionByName(lines.mark_missing_type_map(unmapped))
    return Export(lines.encode_lines(noted, escaped), control.export_results(configured, type_map, errors))
