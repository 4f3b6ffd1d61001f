"""Whole runs over the test tables: export profiles, reconcile written copies."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.tables import DB, SOURCE_TYPES, TYPE_NAMES, as_text_copy, order_table, read, source, type_map_of
from tallymark.operators import control
from tallymark.operators.lines import decode_lines, encode_lines, parse_lines
from tallymark.operators.profile import Metric, all_profiles, extremes, profile_family, profile_table, sums
from tallymark.plans.content import export_content
from tallymark.plans.export import export_profiles
from tallymark.plans.ingest import current_copies, ingest_changed, read_manifest
from tallymark.plans.latest import refresh_success
from tallymark.plans.reconcile import reconcile
from tallymark.sinks.export import append_log, read_log, replace_log, shared_folder, write_line_files, write_lines, write_unsorted
from tallymark.sources.aggregates import SPARK, profile_at_source, quoted
from tallymark.sources.control import (
    SUCCESS_LOG_HEADER, TYPE_MAP_HEADER, read_line_files, read_result_lines, read_success_log, read_type_map, rejected_log_rows,
)

LIST = """
# the tables of this run
whs|sales.lineitem
whs|sales.events
whs|sales.documents
whs|sales.customer
whs|sales.part
whs|sales.nothing_here
whs|nation
"""
CONFIG = """
whs|sales|lineitem|l_quantity|none
whs|sales|lineitem|l_quantity, l_extendedprice, l_orderkey|
whs|sales|events|value|value > 10
whs|sales|documents|n_chars|none
whs|sales|customer|c_acctbal, no_such_column|none
whs|sales|nothing_here|a|none
"""
CONTENT_LIST = """
whs|sales.orders|no_such_key
whs|sales.orders|O_ORDERKEY, o_custkey
whs|sales.customer|all
whs|sales.documents|doc_id, text
whs|sales.part|p_partkey, no_such_key
whs|sales.supplier| ,
whs|sales.lineitem|l_orderkey
whs|sales.nothing_here|r_regionkey
whs|sales.region|R_NAME
"""
MAPPED = ["lineitem", "events", "documents", "customer", "nothing_here"]
# The same without documents, whose metrics are then the count and the sum.
PARTLY_MAPPED = [t for t in MAPPED if t != "documents"]


def _lines(spark: SparkSession, text: str) -> DataFrame:
    rows = [("inline", i, line) for i, line in enumerate(text.splitlines())]
    return spark.createDataFrame(rows, "path string, ordinal int, value string")


def _type_map(spark: SparkSession, sf_dir: str, tables: dict[str, str]) -> DataFrame:
    """Type maps for ``table -> test table``."""
    rows = []
    for table, origin in tables.items():
        for ordinal, (column, kind) in enumerate(source(spark, sf_dir, origin).dtypes, 1):
            rows.append((DB, "sales", table, ordinal, column, SOURCE_TYPES[kind], column, "string"))
    return spark.createDataFrame(
        rows,
        "db string, schema string, table string, ordinal int, gp_column string, gp_type string, ext_column string, ext_type string",
    )


def _export(spark: SparkSession, sf_dir: str, mapped: list[str] = MAPPED, **options):
    rows = None if "aggregate" in options else lambda db, schema, table: source(spark, sf_dir, table)
    return export_profiles(
        spark,
        control.listed_tables(control.parse_table_list(_lines(spark, LIST))),
        control.parse_master_config(_lines(spark, CONFIG)),
        _type_map(spark, sf_dir, {t: t if t != "nothing_here" else "region" for t in mapped}),
        rows,
        shared_folder(spark),
        **options,
    )


def _split(found: DataFrame, whole: bool = False) -> DataFrame:
    return parse_lines(found, whole).select("db", "schema", "table", "row_count", "metric_text", "line_remark", "reason")


def export_run_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of an export run, written one file per table, read back and split; texts hold line breaks and the separator."""
    folder = shared_folder(spark)
    write_line_files(_export(spark, sf_dir).lines, folder, "2024-01-31")
    return _split(read_line_files(spark, folder), whole=True)


def export_run_unmapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same run where documents have no type map, written as many lines to a file."""
    folder = shared_folder(spark)
    write_lines(_export(spark, sf_dir, PARTLY_MAPPED).lines, folder, "2024-01-31")
    return _split(read_result_lines(spark, folder, one_per_file=False))


def export_run_at_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same run, each table's profile taken by one SQL statement of the source, here Spark's own over views."""
    for table in MAPPED:
        if table != "nothing_here":
            source(spark, sf_dir, table).createOrReplaceTempView(f"sales_{table}")

    def aggregate(db, schema, table, metrics, where):
        return profile_at_source(spark.sql, db, schema, table, metrics, where, quoted(f"{schema}_{table}", SPARK), SPARK)

    folder = shared_folder(spark)
    write_line_files(_export(spark, sf_dir, aggregate=aggregate).lines, folder, "2024-01-31", gzip=True)
    return _split(read_line_files(spark, folder), whole=True)


def export_run_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All months of orders in one grouped aggregate, with predicates by month, and a listed month that has no rows."""
    family = source(spark, sf_dir, "orders").withColumn("table", F.concat(F.lit("orders_1_prt_p"), F.date_format("o_orderdate", "yyyyMM")))
    months = family.select("table").distinct().unionByName(spark.createDataFrame([("orders_1_prt_p190001",)], "table string"))
    entry = F.concat(F.lit(f"{DB}|sales."), "table")
    place = F.substring("table", -6, 6).cast("long")
    listed = months.select(F.lit("list").alias("path"), place.alias("ordinal"), entry.alias("value"))
    where = F.when(F.col("table").endswith("01"), "o_orderstatus <> 'P' -- not pending").when(F.col("table").endswith("12"), "o_totalprice < 0").otherwise("none")
    config = F.concat_ws("|", F.lit(DB), F.lit("sales"), "table", F.lit("o_totalprice,o_orderkey"), where)
    run = export_profiles(
        spark,
        control.listed_tables(control.parse_table_list(listed)),
        control.parse_master_config(months.select(F.lit("cfg").alias("path"), place.alias("ordinal"), config.alias("value"))),
        type_map_of(family.unionByName(months.where(F.col("table").endswith("190001")), allowMissingColumns=True), "sales"),
        None,
        shared_folder(spark),
        read_family=lambda db, schema, base: family,
    )
    return run.lines.select("table", F.col("value").alias("line")).join(run.results.select("table", "status"), "table")


def log_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs over customers, the second started again with other results: rows of each run in the log."""
    folder = shared_folder(spark)
    base = read(spark, sf_dir, "customer").select(
        (F.col("c_custkey") % 3 + 1).cast("string").alias("execution_id"), F.concat(F.lit("cust_"), F.col("c_custkey").cast("string")).alias("table"),
        F.when(F.col("c_acctbal") > 0, "completed").otherwise("failed").alias("status"),
    )
    again = base.where("execution_id = '2'").withColumn("status", F.lit("completed"))
    replace_log(base, folder)
    replace_log(base.where("execution_id <> '3'"), folder)
    replace_log(again, folder)
    return read_log(spark, folder, base.schema)


def export_run_escaped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extremes of texts that hold all that a line gives a meaning, escaped into lines of one file, read back as metrics."""
    folder = shared_folder(spark)
    odd = F.concat(F.col("text"), F.lit(" |,MAX(text):%2C\r\nMIN_MAX_STATUS: "))
    texts = source(spark, sf_dir, "documents").withColumn("text", odd)
    profile = profile_family(texts.withColumnRenamed("source", "table"), DB, "sales", sums("n_chars") + extremes("text", "lang"))
    write_lines(encode_lines(profile, escape=True), folder, "2024-01-31", gzip=True)
    parsed = parse_lines(read_result_lines(spark, folder, one_per_file=False))
    return decode_lines(parsed, escape=True).select("table", "func", "col", "value")


def export_run_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The outcome per table: fine, no type map, missing column or table, no configuration."""
    results = _export(spark, sf_dir, PARTLY_MAPPED).results
    # How Spark words a missing file is not the point.
    remark = F.when(F.contains("remark", F.lit("PATH_NOT_FOUND")), "no such path").otherwise(F.col("remark"))
    return results.select("table", "status", remark.alias("remark"))


def _reconciled(spark: SparkSession, sf_dir: str):
    """Export orders by year and customers, damage some copies, reconcile all."""
    folder = shared_folder(spark)
    year = F.date_format("o_orderdate", "yyyy")
    orders = source(spark, sf_dir, "orders")
    copy = as_text_copy(orders).withColumn("year", F.substring("o_orderdate", 1, 4))
    lost = (F.col("year") == "1996") & (F.col("o_orderpriority") == "5-LOW")
    changed = (F.col("year") == "1997") & (F.col("o_orderstatus") == "P")
    damaged = copy.where(~lost).withColumn(
        "o_totalprice", F.when(changed, (F.col("o_totalprice").cast("decimal(18,2)") * 2).cast("string")).otherwise(F.col("o_totalprice"))
    )
    write_unsorted(spark)
    damaged.write.partitionBy("year").parquet(f"{folder}/copy/orders")
    as_text_copy(source(spark, sf_dir, "customer")).write.parquet(f"{folder}/copy/customer")

    years = [str(y) for y in range(1995, 2002)]
    tables = {f"orders_1_prt_{y}": f"/landing/orders/year={y}" for y in years} | {"customer": "/landing/customer", "gone": "/landing/gone"}
    listed = control.listed_tables(control.parse_table_list(_lines(spark, "\n".join(f"{DB}|sales.{t}" for t in [*tables, "part"]))))
    config = "\n".join(f"{DB}|sales|{t}|o_totalprice, o_orderkey|none" for t in tables if t.startswith("orders"))
    master = control.parse_master_config(_lines(spark, config + f"\n{DB}|sales|customer|c_acctbal|none\n{DB}|sales|gone||none"))
    type_map = _type_map(spark, sf_dir, {t: "orders" for t in tables if t.startswith("orders")} | {"gone": "customer"})

    def read_table(db, schema, table):
        if table.startswith("orders"):
            return orders.where(year == table[-4:])
        return source(spark, sf_dir, "customer")

    exported = export_profiles(spark, listed, master, type_map, read_table, f"{folder}/source")
    write_lines(exported.lines, f"{folder}/lines", "2024-01-31", gzip=True)
    log = [(DB, "sales", f"sales.{t}" if t == "customer" else t, "SUCCEEDED", "2024-01-31", path, "log", i) for i, (t, path) in enumerate(tables.items())]
    log.append((DB, "sales", "part", "FAILED", "2024-01-31", "/landing/part", "log", 99))
    success_log = spark.createDataFrame(
        log, "db string, schema string, name string, status string, ended string, file_path string, path string, ordinal int"
    )
    return folder, reconcile(
        spark, listed, success_log, read_result_lines(spark, f"{folder}/lines", one_per_file=False), type_map,
        f"{folder}/copies", "run-1", path_from="/landing/", path_to=f"{folder}/copy/",
    )


def reconcile_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every table's counts, status and remark after a whole run."""
    folder, run = _reconciled(spark, sf_dir)
    remark = F.replace("remark", F.lit(folder), F.lit(""))
    return run.results.select(
        "table", "source_count", "copy_count", "total_metrics", "mismatch_metrics", "status", remark.alias("remark")
    )


def reconcile_run_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both logs of a run, appended and read back: rows per status and match."""
    folder, run = _reconciled(spark, sf_dir)
    append_log(run.table_log, path=f"{folder}/table_log")
    append_log(run.column_log, path=f"{folder}/column_log")
    tables = spark.read.parquet(f"{folder}/table_log").groupBy("execution_id", F.col("status").alias("outcome"))
    columns = spark.read.parquet(f"{folder}/column_log").groupBy("execution_id", F.col("match").alias("outcome"))
    count = F.count(F.lit(1)).alias("n")
    return tables.agg(count).unionByName(columns.agg(count))


def _content_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest listed tables; customers are mapped in reverse order, texts are reread, region's map has a column more."""
    mapped = {t: t for t in ("orders", "customer", "documents", "part", "supplier", "region")} | {"nothing_here": "region"}
    type_map = _type_map(spark, sf_dir, mapped)
    order = F.when(F.col("table") == "customer", -F.col("ordinal")).otherwise(F.col("ordinal"))
    unknown = spark.createDataFrame([(DB, "sales", "region", 99, "r_gone", "text", "r_gone", "string")], type_map.schema)
    special = spark.createDataFrame(
        [("WHS", "Sales.Documents", "TEXT", "y"), ("whs", "sales.orders", "o_orderstatus", "n")],
        "database_name string, original_table_name string, th_column_name string, active_flag string",
    )
    return export_content(
        spark,
        control.listed_tables(control.parse_table_list(_lines(spark, CONTENT_LIST), with_keys=True)),
        type_map.withColumn("ordinal", order).unionByName(unknown),
        control.special_columns(special),
        lambda db, schema, table: source(spark, sf_dir, table),
        shared_folder(spark),
        form="parquet",
    ).results


def _content_written(spark: SparkSession, results: DataFrame) -> DataFrame:
    done = results.where("status = 'SUCCESS'").collect()
    return reduce(DataFrame.unionByName, [spark.read.parquet(r.path).withColumn("table", F.lit(r.table)) for r in done])


def content_run_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per table: status, message and rows written; bad, empty and unmapped keys, a missing table, a missing column."""
    results = _content_run(spark, sf_dir)
    rows = _content_written(spark, results).groupBy("table").agg(F.count(F.lit(1)).alias("n"))
    # How Spark words a missing file or column is not the point.
    message = (
        F.when(F.contains("message", F.lit("PATH_NOT_FOUND")), "no such path")
        .when(F.contains("message", F.lit("UNRESOLVED_COLUMN")), "no such column")
        .otherwise(F.col("message"))
    )
    n = F.coalesce("n", F.lit(0).cast("bigint")).alias("n")
    return results.join(rows, "table", "left").select("table", "status", message.alias("message"), n)


def content_run_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digests that a run wrote, of all tables."""
    return _content_written(spark, _content_run(spark, sf_dir))


def _write_log(rows: DataFrame, header: str | None, path: str, line_sep: str, buckets: int = 4) -> None:
    """Rows (bucket, place, value) as a log of some files, each with the header, in the order of their places."""
    spark = rows.sparkSession
    if header is not None:
        first = spark.range(buckets).select(F.col("id").alias("bucket"), F.lit(-1).cast("long").alias("place"), F.lit(header).alias("value"))
        rows = rows.unionByName(first)
    sorted_rows = rows.repartition(buckets, "bucket").sortWithinPartitions("bucket", "place")
    sorted_rows.select("value").write.option("lineSep", line_sep).text(path)


def type_map_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Type maps with a column per customer, in two orders of columns, quoted and blank lines; names of which one begins like another.

    Per column: its table, its source type as the comparison knows it, and whether MIN and MAX are taken.
    """
    root = f"{shared_folder(spark)}/maps"
    key = F.col("c_custkey").cast("string")
    kinds = F.array(*[F.lit(t) for t in TYPE_NAMES])
    kind = F.element_at(kinds, (F.col("c_custkey") % len(TYPE_NAMES) + 1).cast("int"))
    fields = {
        "gp_column_nm": F.concat(F.lit("c_"), key),
        "gp_datatype": F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit('"'), kind, F.lit('"'))).otherwise(F.concat(F.lit(" "), kind)),
        "ext_column_nm": F.concat(F.lit("X_"), key),
        "ext_datatype": F.when(F.col("c_acctbal") > 0, "string").otherwise("bytea"),
        "note": F.lit("x"),
    }
    customers = read(spark, sf_dir, "customer")
    orders = [list(TYPE_MAP_HEADER), ["note", *reversed(TYPE_MAP_HEADER)]]
    for n in range(4):
        columns = orders[n % 2]
        line = F.concat_ws("|", *[fields[c] for c in columns])
        rows = customers.where(F.col("c_nationkey") % 4 == n).select(
            F.lit(0).alias("bucket"), F.col("c_custkey").alias("place"), F.when(key.endswith("7"), F.concat(line, F.lit("\n"))).otherwise(line).alias("value")
        )
        # Each map is one file, as its lines are in order.
        _write_log(rows, "|".join(columns), f"{root}/{DB}/sales/cust{'_long' * n}.csv", "\r\n" if n == 3 else "\n", buckets=1)
    found = read_type_map(spark, root)
    known = control.metric_types(found, exact=True).select("table", F.col("type_key").alias("col"), "source_type")
    listed = found.select("db", "schema", "table").distinct().withColumn("sum_cols", F.lit("none"))
    ranked = control.export_metrics(listed, found).where("func = 'MIN'").select("table", F.lower("col").alias("col"), F.lit(1).alias("ordered"))
    return known.join(ranked, ["table", "col"], "left").select("table", "col", "source_type", F.coalesce("ordered", F.lit(0)).alias("ordered"))


def success_log_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logs of orders by status: two orders of columns, one without end times, one without a header, some short rows.

    Each row of the result is the newest success of a table, or the number of rows rejected for a reason.
    """
    root = f"{shared_folder(spark)}/logs"
    key, status = F.col("o_orderkey").cast("string"), F.col("o_orderstatus")
    fields = {
        "Greenplum_Tbl": order_table(),
        "Run_Status": F.when(F.col("o_orderpriority") == "1-URGENT", "FAILED").otherwise("SUCCEEDED"),
        "End_Timestamp_Script": F.concat_ws(" ", F.date_format("o_orderdate", "yyyy-MM-dd"), F.lpad(key, 12, "0")),
        "File_Path": F.concat(F.lit('"/land, all/'), key, F.lit('"')),
        "Id": key,
    }
    logs = {
        "F": (["Id", "Greenplum_Tbl", "Run_Status", "End_Timestamp_Script", "File_Path"], True, "\n"),
        "O": (["File_Path", "Run_Status", "Greenplum_Tbl"], True, "\r\n"),
        "P": (["Id", "Greenplum_Tbl", "Run_Status"], False, "\n"),
    }
    orders = read(spark, sf_dir, "orders")
    for name, (columns, has_header, line_sep) in logs.items():
        row = F.concat_ws(",", *[fields[c] for c in columns])
        if name == "F":
            row = F.when(F.col("o_orderpriority") == "5-LOW", key).otherwise(row)
        rows = orders.where(status == name).select((F.col("o_custkey") % 4).alias("bucket"), F.col("o_orderkey").alias("place"), row.alias("value"))
        path = f"{root}/{DB}/run_{name}/offloadgp_stat_succeeded.sales_{name.lower()}.csv"
        _write_log(rows, ",".join(columns) if has_header else None, path, line_sep)
    nothing = F.lit(None).cast("string")
    newest = control.latest_success(read_success_log(spark, root)).select(
        "schema", "table", "file_path", nothing.alias("reason"), F.lit(1).cast("long").alias("n")
    )
    rejected = rejected_log_rows(spark, root).groupBy("reason").agg(F.count("*").alias("n"))
    return newest.unionByName(rejected.select(nothing.alias("schema"), nothing.alias("table"), nothing.alias("file_path"), "reason", "n"))


def latest_second_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logs of orders by year, the last two years' files added before the second of three runs.

    The newest success per table after the last run, and how many files each run read.
    """
    folder = shared_folder(spark)
    root, kept = f"{folder}/logs", f"{folder}/kept"
    key, year = F.col("o_orderkey").cast("string"), F.date_format("o_orderdate", "yyyy")
    ended = F.concat_ws(" ", F.date_format("o_orderdate", "yyyy-MM-dd"), F.lpad(key, 12, "0"))
    status = F.when(F.col("o_orderstatus") == "P", "FAILED").otherwise("SUCCEEDED")
    orders = read(spark, sf_dir, "orders").select(
        year.alias("year"), F.col("o_orderkey").alias("place"), F.concat_ws(",", order_table(), status, ended, F.concat(F.lit("/land/"), key)).alias("value")
    )
    header = ",".join(SUCCESS_LOG_HEADER)
    years = sorted(r[0] for r in orders.select("year").distinct().collect())
    read_files = []
    for cycle, some in enumerate((years[:-2], years[-2:], []), 1):
        for one in some:
            rows = orders.where(F.col("year") == one).select(F.lit(0).alias("bucket"), "place", "value")
            _write_log(rows, header, f"{root}/{DB}/{one}/offloadgp_stat_succeeded.sales.csv", "\n", buckets=1)
        run = refresh_success(spark, root, kept)
        read_files.append((f"cycle {cycle}", str(run.files.count())))
    files = spark.createDataFrame(read_files, "table string, file_path string")
    return run.latest.select("table", "file_path").unionByName(files)


def incremental_second_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four cycles over lineitem by return flag: all is new; nothing changed; one source newer and one copy gone; a bad table.

    Per cycle and table: reason, status, and rows and sum of the copy that counts.
    """
    folder = shared_folder(spark)
    landing, root, manifest = f"{folder}/landing", f"{folder}/copies", f"{folder}/manifest"
    lineitem = source(spark, sf_dir, "lineitem")
    write_unsorted(spark)
    as_text_copy(lineitem).write.partitionBy("l_returnflag").parquet(landing)
    flags = sorted(r[0] for r in lineitem.select("l_returnflag").distinct().collect())

    def listed(*more):
        rows = [(DB, "sales", f"lineitem_1_prt_{f}", f"{landing}/l_returnflag={f}") for f in flags]
        return spark.createDataFrame([*rows, *more], "db string, schema string, table string, directory string")

    def state(cycle: int, *more) -> DataFrame:
        results = ingest_changed(spark, listed(*more), root, manifest).results
        found = {r.table: r.copy for r in current_copies(read_manifest(spark, manifest)).collect()}
        metrics = [Metric("SUM", "l_extendedprice", "decimal(18,2)")]
        profiles = [profile_table(spark.read.parquet(path), DB, "sales", table, metrics, of_copy=True) for table, path in found.items()]
        wide = all_profiles(profiles).groupBy("table").agg(
            F.max(F.when(F.col("func") == "COUNT", F.col("value"))).alias("n"), F.max(F.when(F.col("func") == "SUM", F.col("value"))).alias("total")
        )
        kept = results.join(wide, "table", "left").select(F.lit(cycle).alias("cycle"), "table", "reason", "status", "n", "total")
        kept.write.mode("append").parquet(f"{folder}/states")
        return kept

    state(1)
    state(2)
    gone = current_copies(read_manifest(spark, manifest)).where(F.col("table") == f"lineitem_1_prt_{flags[0]}").first()["copy"]
    spark.createDataFrame([], "value string").write.mode("overwrite").text(gone)
    # The last flag's source is written anew, with its amounts doubled.
    doubled = lineitem.where(F.col("l_returnflag") == flags[-1]).withColumn("l_extendedprice", (F.col("l_extendedprice") * 2).cast("decimal(18,2)"))
    as_text_copy(doubled.drop("l_returnflag")).write.mode("overwrite").parquet(f"{landing}/l_returnflag={flags[-1]}")
    state(3)
    state(4, (DB, "sales", "nowhere", f"{landing}/nowhere"))
    return spark.read.parquet(f"{folder}/states")


RUNS = {
    run.__name__: run
    for run in (
        content_run_status, content_run_rows, export_run_lines, export_run_unmapped, export_run_at_source, export_run_escaped, export_run_family, log_rerun,
        latest_second_run,
        export_run_status, reconcile_run, reconcile_run_logs, type_map_files, success_log_files, incremental_second_run,
    )
}
