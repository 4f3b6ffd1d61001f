"""One query per operator, over whole test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.runs import RUNS
from checks.tables import (
    DB, TABLES, TYPE_NAMES, as_text_copy, customers, master_lines, order_table, order_type_map, read, source, type_map_of,
)
from tallymark.functions import rules, text, types
from tallymark.operators import compare, content, control, lines
from tallymark.operators.profile import Metric, all_profiles, extremes, filtered, profile_family, profile_table, sums
from tallymark.sinks.export import append_log, shared_folder, write_content, write_lines, write_unsorted
from tallymark.sources import control as control_files
from tallymark.sources import tables as table_files

PROFILE = ["table", "func", "col", "value"]
ORDER_METRICS = sums("o_totalprice", "o_orderkey") + extremes("o_orderdate", "o_orderpriority", "o_totalprice")
CUSTOMER_METRICS = sums("c_acctbal") + extremes("c_name", "c_acctbal")
EVENT_METRICS = sums("value") + extremes("ts", "event_type", "props")
LINEITEM_METRICS = (
    sums("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_orderkey")
    + extremes("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate")
)


def _profile(spark, sf_dir, table, metrics, where=None):
    df = filtered(source(spark, sf_dir, table), where)
    return profile_table(df, DB, "sales", table, metrics).select(*PROFILE)


# --- profiles ----------------------------------------------------------------


def profile_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return all_profiles([profile_table(read(spark, sf_dir, t), DB, "sales", t) for t in TABLES]).select(*PROFILE)


def profile_sum(spark, sf_dir):
    return all_profiles([
        _profile(spark, sf_dir, "lineitem", sums("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_suppkey")),
        _profile(spark, sf_dir, "orders", sums("o_totalprice", "o_orderkey")),
        _profile(spark, sf_dir, "customer", sums("c_acctbal")),
    ])


def profile_min_max(spark, sf_dir):
    return all_profiles([
        _profile(spark, sf_dir, "orders", extremes("o_orderkey", "o_orderdate", "o_orderpriority", "o_totalprice")),
        _profile(spark, sf_dir, "events", extremes("event_id", "ts", "event_type", "value", "props")),
        _profile(spark, sf_dir, "documents", extremes("text", "lang")),
    ])


def profile_long(spark, sf_dir):
    return _profile(spark, sf_dir, "lineitem", LINEITEM_METRICS)


def profile_empty_input(spark, sf_dir):
    """A predicate no row meets: a SUM of ``0``, empty extremes."""
    return _profile(spark, sf_dir, "orders", ORDER_METRICS, "o_totalprice < 0")


def profile_filtered(spark, sf_dir):
    return all_profiles([
        _profile(spark, sf_dir, "orders", ORDER_METRICS, "o_orderdate >= timestamp_ntz'1997-01-01' AND o_orderstatus <> 'P'"),
        _profile(spark, sf_dir, "customer", CUSTOMER_METRICS, " None "),
    ])


def _orders_by_month(df: DataFrame) -> DataFrame:
    month = F.date_format(F.col("o_orderdate").cast("timestamp_ntz"), "yyyyMM")
    return df.withColumn("table", F.concat(F.lit("orders_1_prt_p"), month))


def profile_by_partition(spark, sf_dir):
    family = _orders_by_month(source(spark, sf_dir, "orders"))
    return profile_family(family, DB, "sales", ORDER_METRICS).select(
        text.base_table(F.col("table")).alias("base_table"),
        text.partition_suffix(F.col("table")).alias("part"),
        "func", "col", "value",
    )


def profile_cast_copy(spark, sf_dir):
    """A copy in text, with unreadable amounts and fractions in whole numbers."""
    returned = F.col("l_returnflag") == "R"
    copy = as_text_copy(source(spark, sf_dir, "lineitem")).withColumns({
        "l_quantity": F.when(returned, "n/a").otherwise(F.col("l_quantity")),
        "l_linenumber": F.concat("l_linenumber", F.lit(".7")),
        "l_shipdate": F.when(returned, F.substring("l_shipdate", 1, 10)).otherwise(F.col("l_shipdate")),
    })
    metrics = [
        Metric("SUM", "l_quantity", "decimal(18,2)"),
        Metric("SUM", "l_extendedprice", "decimal(38,4)"),
        Metric("SUM", "l_linenumber", "long"),
        Metric("SUM", "l_orderkey", "long"),
        Metric("MIN", "l_quantity", "decimal(18,2)"),
        Metric("MAX", "l_quantity", "string"),
        Metric("MIN", "l_partkey", "long"),
        Metric("MAX", "l_partkey", "string"),
        Metric("MIN", "l_shipdate", "timestamp"),
        Metric("MAX", "l_shipdate", "date"),
        Metric("MAX", "l_comment_free", "long"),
    ]
    copy = copy.withColumn("l_comment_free", F.lit("none").cast("string"))
    return profile_table(copy, DB, "sales", "lineitem", metrics, of_copy=True).select(*PROFILE)


def profile_many_groups(spark, sf_dir):
    """Events by user and documents by source, text extremes without sorting; props and texts go beyond their codes."""
    users = source(spark, sf_dir, "events").withColumn("table", F.concat(F.lit("user_"), F.col("user_id").cast("string")))
    texts = source(spark, sf_dir, "documents").withColumnRenamed("source", "table")
    return all_profiles([
        profile_family(users, DB, "web", EVENT_METRICS, many_groups=True),
        profile_family(texts, DB, "web", sums("n_chars") + extremes("text", "lang"), many_groups=True),
    ]).select(*PROFILE)


def profile_unbounded(spark, sf_dir):
    """Numbers with 30 digits before the point and 25 after it, some below zero, by priority."""
    key, customer = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    sign = F.when(F.col("o_orderstatus") == "P", "-").otherwise("")
    number = F.concat(sign, F.lpad(key, 10, "1"), F.lpad(customer, 20, "2"), F.lit("."), F.lpad(key, 24, "3"), F.lit("0"))
    orders = read(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("table"), number.alias("n"))
    metrics = [Metric(f, "n", "numeric") for f in ("SUM", "MIN", "MAX")]
    return profile_family(orders, DB, "sales", metrics, of_copy=True).select(*PROFILE)


# --- lines -------------------------------------------------------------------


def _customer_lines(spark, sf_dir):
    family = source(spark, sf_dir, "orders").withColumn("table", order_table("orders_1_prt_c"))
    return lines.encode_lines(profile_family(family, DB, "sales", ORDER_METRICS))


def line_encode(spark, sf_dir):
    return _customer_lines(spark, sf_dir).select("table", F.col("value").alias("line"))


def line_decode(spark, sf_dir):
    """Lines of one table per user, read back; values hold colons and braces."""
    users = source(spark, sf_dir, "events").withColumn("table", F.concat(F.lit("user_"), F.col("user_id").cast("string")))
    encoded = lines.encode_lines(profile_family(users, DB, "web", EVENT_METRICS))
    return lines.decode_lines(lines.parse_lines(encoded.select("value"))).select("schema", *PROFILE)


def line_parse(spark, sf_dir):
    """One line per order: short lines, counts that are no numbers, notes."""
    identity = F.concat(F.lit("whs|sales|t_"), F.col("o_orderkey").cast("string"))
    priority = F.col("o_orderpriority")
    line = (
        F.when(priority == "1-URGENT", F.lit("whs|sales"))
        .when(priority == "2-HIGH", F.concat(identity, F.lit("|n/a|SUM(a):1")))
        .when(priority == "3-MEDIUM", F.concat(identity, F.lit("| 7 |SUM(a):6,MIN_MAX_STATUS: DATA_TYPE_FILE_MISSING\n")))
        .when(priority == "4-NOT SPECIFIED", F.concat(identity, F.lit("|0|")))
        .otherwise(F.concat(identity, F.lit("|5|SUM(a):6,MAX(c):x,y:z")))
    )
    orders = read(spark, sf_dir, "orders").select("o_orderkey", line.alias("value"))
    return lines.parse_lines(orders).select("o_orderkey", "table", "row_count", "metric_text", "line_remark", "reason")


# --- control data ------------------------------------------------------------


def _typed_parts(spark, sf_dir):
    kinds = F.array(*[F.lit(t) for t in TYPE_NAMES])
    held = F.array(*[F.lit(t) for t in ["text", "VARCHAR(30)", "string", "decimal(18,2)", "bytea", "char (1)", "int"]])

    def pick(values, size):
        return F.element_at(values, (F.col("p_partkey") % size + 1).cast("int"))

    return read(spark, sf_dir, "part").select("p_partkey", pick(kinds, len(TYPE_NAMES)).alias("gp_type"), pick(held, 7).alias("ext_type"))


def type_candidates(spark, sf_dir):
    candidate = types.is_min_max_candidate(F.col("gp_type"), F.col("ext_type"))
    return _typed_parts(spark, sf_dir).withColumn("candidate", candidate.cast("int"))


def type_mapping(spark, sf_dir):
    declared = F.col("gp_type")
    return _typed_parts(spark, sf_dir).select(
        "p_partkey",
        types.spark_type(declared).alias("spark_type"),
        types.exact_spark_type(declared).alias("exact_type"),
        types.type_length(declared).alias("length"),
        types.number_scale(F.lower(declared)).alias("scale"),
    )


def _list_lines(spark, sf_dir):
    key, priority = F.col("o_orderkey").cast("string"), F.col("o_orderpriority")
    line = (
        F.when(priority == "1-URGENT", F.concat(F.lit("  whs | sales.orders_1_prt_p"), key, F.lit("  ")))
        .when(priority == "2-HIGH", F.concat(F.lit(" # whs|sales.orders_"), key))
        .when(priority == "3-MEDIUM", F.concat(F.lit("whs|sales.orders_"), key))
        .when(priority == "4-NOT SPECIFIED", F.concat(F.lit("whs|orders_"), key))
        .when(F.col("o_orderstatus") == "F", F.lit("   "))
        .when(F.col("o_orderstatus") == "O", F.concat(F.lit("whs|sales.orders_"), key, F.lit("| o_orderkey, o_custkey|x")))
        .otherwise("whs")
    )
    return read(spark, sf_dir, "orders").select(
        F.lit("list.txt").alias("path"), F.col("o_orderkey").alias("ordinal"), line.alias("value")
    )


def table_list_parse(spark, sf_dir):
    return control.listed_tables(control.parse_table_list(_list_lines(spark, sf_dir))).drop("path")


def table_list_keys(spark, sf_dir):
    return control.listed_tables(control.parse_table_list(_list_lines(spark, sf_dir), with_keys=True)).drop("path")


def table_list_rejects(spark, sf_dir):
    plain = control.rejected_entries(control.parse_table_list(_list_lines(spark, sf_dir))).withColumn("form", F.lit("plain"))
    keyed = control.rejected_entries(control.parse_table_list(_list_lines(spark, sf_dir), with_keys=True))
    return plain.unionByName(keyed.withColumn("form", F.lit("keyed"))).drop("path")


def master_lookup(spark, sf_dir):
    master = control.parse_master_config(master_lines(spark, sf_dir))
    found = control.with_master_config(customers(spark, sf_dir), master)
    return found.select(
        "table",
        F.col("has_config").cast("int").alias("has_config"),
        "sum_cols",
        "where",
        F.array_join(control.name_list(F.col("sum_cols")), "/").alias("sum_list"),
        control.is_set(F.col("where")).cast("int").alias("is_filtered"),
    )


def master_missing(spark, sf_dir):
    master = control.parse_master_config(master_lines(spark, sf_dir))
    return control.without_master_config(customers(spark, sf_dir), master)


def export_metrics(spark, sf_dir):
    """The metrics planned for every customer's table."""
    master = control.parse_master_config(master_lines(spark, sf_dir))
    configured = control.with_master_config(customers(spark, sf_dir), master).where("has_config")
    planned = control.export_metrics(configured, order_type_map(spark, sf_dir))
    return planned.select("table", "func", "col", F.col("position.rank").alias("rank"))


def metric_types(spark, sf_dir):
    return control.metric_types(order_type_map(spark, sf_dir)).select("table", "type_key", "source_type")


def _success_log(spark, sf_dir):
    qualified = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    return read(spark, sf_dir, "orders").select(
        F.lit(DB).alias("db"),
        F.lit("sales").alias("schema"),
        F.when(qualified, F.concat(F.lit("sales."), order_table())).otherwise(order_table()).alias("name"),
        F.when(F.col("o_orderstatus") == "P", "succeeded").otherwise("SUCCEEDED").alias("status"),
        F.date_format("o_orderdate", "yyyy").alias("ended"),
        F.concat(F.lit("/mnt/old/"), F.col("o_orderkey").cast("string")).alias("file_path"),
        F.concat(F.lit("/logs/"), "o_orderpriority").alias("path"),
        F.col("o_orderkey").alias("ordinal"),
    )


def success_latest(spark, sf_dir):
    latest = control.latest_success(_success_log(spark, sf_dir))
    found = control.with_copy_path(customers(spark, sf_dir), latest, "/mnt/old/", "/mnt/new/")
    return found.select("table", F.col("has_copy").cast("int").alias("has_copy"), "file_path")


def result_latest(spark, sf_dir):
    """One line per event, the newest per user; listed users without one fail."""
    number = F.col("event_id").cast("string")
    user = F.concat(F.lit("cust_"), F.col("user_id").cast("string"))
    exported = source(spark, sf_dir, "events").select(
        F.concat(F.lit("whs|sales|"), user, F.lit("|"), number, F.lit("|SUM(value):"), F.col("value").cast("string")).alias("value"),
        F.concat(F.lit("/out/"), "event_type", F.lit("/whs_"), user, F.lit("_"), number, F.lit(".txt")).alias("path"),
        F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("modified"),
    )
    newest = lines.latest_lines(lines.parse_lines(exported))
    missing = rules.failure_remark(F.lit("Greenplum result file not found"))
    return (
        customers(spark, sf_dir)
        .join(newest, control.TABLE_KEY, "left")
        .select("table", "row_count", "metric_text", "path", F.when(F.col("path").isNull(), missing).alias("remark"))
    )


def special_columns(spark, sf_dir):
    parts = read(spark, sf_dir, "part").select(
        F.when(F.col("p_size") > 25, "WHS").otherwise(" whs ").alias("database_name"),
        F.concat(F.lit("Sales."), "p_brand").alias("original_table_name"),
        F.when(F.col("p_size") > 10, F.col("p_type")).otherwise(F.lower("p_type")).alias("th_column_name"),
        F.when(F.col("p_size") > 30, "N").when(F.col("p_size") > 15, "y").otherwise("Y").alias("active_flag"),
    )
    listed = read(spark, sf_dir, "supplier").select(
        "s_suppkey",
        F.lit("Whs").alias("db"),
        F.lit("SALES").alias("schema"),
        F.concat(F.lit("brand#"), F.col("s_nationkey").cast("string")).alias("table"),
    )
    found = control.with_special_columns(listed, control.special_columns(parts))
    return found.select("s_suppkey", "table", F.array_join("special", ",").alias("special"))


def key_validation(spark, sf_dir):
    """Keys of one table per supplier, whose columns are the supplier's line numbers."""
    columns = read(spark, sf_dir, "lineitem").select(
        F.lit(DB).alias("db"),
        F.lit("sales").alias("schema"),
        F.concat(F.lit("sup_"), F.col("l_suppkey").cast("string")).alias("table"),
        F.concat(F.lit("C_"), F.col("l_linenumber").cast("string")).alias("gp_column"),
    )
    nation = F.col("s_nationkey")
    keys = (
        F.when(nation < 5, "all")
        .when(nation < 10, "c_1, C_2,")
        .when(nation < 15, "C_3,no_such, nor_this")
        .when(nation < 20, "c_9")
        .otherwise("C_7")
    )
    listed = read(spark, sf_dir, "supplier").select(
        F.lit(DB).alias("db"),
        F.lit("sales").alias("schema"),
        F.concat(F.lit("sup_"), F.col("s_suppkey").cast("string")).alias("table"),
        keys.alias("key_cols"),
    )
    resolved = control.resolve_keys(listed, columns)
    return resolved.select("table", "key_cols", F.array_join("keys", "/").alias("keys"), "error")


# --- content -----------------------------------------------------------------


def _content(spark, sf_dir, table, keys, **options):
    df = source(spark, sf_dir, table)
    return content.content_rows(df, keys, df.columns, options.pop("special", []), **options)


def content_rows_keyed(spark, sf_dir):
    return _content(spark, sf_dir, "orders", "O_ORDERKEY, o_custkey")


def content_rows_all(spark, sf_dir):
    return _content(spark, sf_dir, "customer", "All")


def content_rows_excluded(spark, sf_dir):
    return _content(spark, sf_dir, "lineitem", "ALL", exclude_content=True)


def content_rows_nulls(spark, sf_dir):
    """NULLs and empty texts digest alike."""
    df = source(spark, sf_dir, "orders").withColumns({
        "o_orderpriority": F.when(F.col("o_orderstatus") == "P", F.lit(None)).when(F.col("o_orderstatus") == "F", "").otherwise(F.col("o_orderpriority")),
        "o_totalprice": F.when(F.col("o_totalprice") > 1000, F.col("o_totalprice")),
    })
    return content.content_rows(df, "o_orderkey,o_orderpriority", df.columns, [])


def content_rows_special(spark, sf_dir):
    """All texts of the documents, reread in another charset."""
    return _content(spark, sf_dir, "documents", "doc_id,text", special=["Text"])


# --- comparison --------------------------------------------------------------


def _months(spark, sf_dir):
    """Orders by month, and a copy in which whole years went wrong in one way each."""
    orders = _orders_by_month(source(spark, sf_dir, "orders"))
    copy = as_text_copy(orders)
    year, status, priority = F.substring("o_orderdate", 1, 4), F.col("o_orderstatus"), F.col("o_orderpriority")
    kept = ~((year == "1997") & (priority == "1-URGENT"))
    amount = (
        F.when((year == "1998") & (status == "P"), (F.col("o_totalprice").cast("decimal(18,2)") + 1).cast("string"))
        .when((year == "2000") & (priority == "2-HIGH"), "n/a")
        .otherwise(F.col("o_totalprice"))
    )
    broken = copy.where(kept).withColumn("o_totalprice", amount)
    repeats = F.when((year == "1996") & (status == "P"), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return orders, broken.withColumn("again", F.explode(repeats)).drop("again")


ORDER_CASTS = {"o_totalprice": "decimal(18,2)", "o_orderkey": "long", "o_orderdate": "timestamp"}
CUSTOMER_CASTS = {"c_acctbal": "decimal(18,2)"}
NO_TYPE_MAP: dict[str, str] = {}
EVENT_CASTS = {"value": "decimal(18,2)", "ts": "timestamp"}
LINEITEM_CASTS = {c: "decimal(18,2)" for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")} | {
    "l_orderkey": "long", "l_linenumber": "long", "l_shipdate": "timestamp"
}


def _both_sides(original, copy, metrics, casts, exact=False):
    """The source's profile by way of its lines, and the copy's, both by ``table``."""
    encoded = lines.encode_lines(profile_family(original, DB, "sales", metrics))
    expected = lines.decode_lines(lines.parse_lines(encoded.select("value")))
    read_as = [m._replace(cast=casts.get(m.col, "string")) for m in metrics]
    return expected, profile_family(copy, DB, "sales", read_as, of_copy=True, whole_seconds=not exact)


def _compared_months(spark, sf_dir):
    orders, copy = _months(spark, sf_dir)
    expected, actual = _both_sides(orders, copy, ORDER_METRICS, ORDER_CASTS)
    metric_types = control.metric_types(type_map_of(orders, "sales"))
    return compare.compare_profiles(expected, actual, metric_types), metric_types


def _compared_tables(spark, sf_dir, exact=False):
    """Customers, events and lineitem beside faithful copies; only ``exact`` maps the customers' types."""
    families = [
        ("customer", "c_nationkey", sums("c_acctbal") + extremes("c_name"), CUSTOMER_CASTS if exact else NO_TYPE_MAP),
        ("events", "event_type", EVENT_METRICS, EVENT_CASTS),
        ("lineitem", "l_suppkey", LINEITEM_METRICS, LINEITEM_CASTS),
    ]
    sources, copies, maps = [], [], []
    for table, by, metrics, casts in families:
        df = source(spark, sf_dir, table)
        df = df.withColumn("table", F.concat(F.lit(f"{table}_1_prt_"), F.col(by).cast("string")))
        expected, actual = _both_sides(df, as_text_copy(df), metrics, casts, exact=exact)
        sources.append(expected)
        copies.append(actual)
        if casts:
            maps.append(type_map_of(df, "sales"))
    metric_types = control.metric_types(all_profiles(maps), exact)
    return compare.compare_profiles(all_profiles(sources), all_profiles(copies), metric_types, exact), metric_types


def compare_metrics(spark, sf_dir):
    compared, _ = _compared_months(spark, sf_dir)
    return compared.select(
        "table", "func", "col", "source_type", "source_value", "copy_value", F.col("matched").cast("int").alias("matched")
    )


def compare_metrics_exact(spark, sf_dir):
    """Whole timestamps and exact decimals: faithful copies match everywhere."""
    compared, _ = _compared_tables(spark, sf_dir, exact=True)
    return compared.select("table", "func", "col", "source_value", "copy_value", F.col("matched").cast("int").alias("matched"))


RESULT = ["table", "source_count", "copy_count", "total_metrics", "mismatch_metrics", "status", "remark"]


def table_status(spark, sf_dir):
    return compare.classify_tables(*_compared_months(spark, sf_dir)).select(*RESULT)


def table_status_many(spark, sf_dir):
    """Families of three tables in one job; events lose sub-seconds, customers lack a type map."""
    return compare.classify_tables(*_compared_tables(spark, sf_dir)).select(*RESULT)


def _failed_customers(spark, sf_dir):
    """Every customer's table as skipped, failed in some way, or fine."""
    error = (
        F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.concat(F.lit("Local path not found or inaccessible: /x/"), "c_name"))
        .when(F.col("c_mktsegment") == "BUILDING", F.concat(F.lit("Spark Parquet Aggregation Failed: Column 'a'\nin "), "c_name"))
        .when(F.col("c_mktsegment") == "FURNITURE", F.concat(F.lit("Greenplum result file not found for pattern: "), "c_name"))
        .when(F.col("c_nationkey") < 8, F.concat(F.lit("Failed to parse GP Result: "), "c_name"))
        .when(F.col("c_nationkey") < 12, F.lit("short"))
        .when(F.col("c_nationkey") < 16, F.concat(F.repeat(F.lit("An error nobody knows. "), F.lit(12)), "c_name"))
    )
    return read(spark, sf_dir, "customer").select(
        F.lit(DB).alias("db"),
        F.lit("sales").alias("schema"),
        F.concat(F.lit("cust_"), F.col("c_custkey").cast("string")).alias("table"),
        (F.col("c_acctbal") > 0).alias("has_copy"),
        error.alias("error"),
    )


def failure_class(spark, sf_dir):
    return compare.without_result(_failed_customers(spark, sf_dir)).select(*RESULT)


def export_status(spark, sf_dir):
    """Customers without configuration, without type map, or failed."""
    master = control.parse_master_config(master_lines(spark, sf_dir))
    configured = control.with_master_config(customers(spark, sf_dir), master)
    mapped = order_type_map(spark, sf_dir).where(F.col("ext_type") == "bytea")
    failed = _failed_customers(spark, sf_dir).where(F.col("error").isNotNull())
    return control.export_results(configured, mapped, failed).select("table", "status", "remark")


def run_summary(spark, sf_dir):
    compared, metric_types = _compared_months(spark, sf_dir)
    results = compare.classify_tables(compared, metric_types)
    return compare.run_summary(results.unionByName(compare.without_result(_failed_customers(spark, sf_dir))))


# --- logs, files, ingest -----------------------------------------------------


def table_log(spark, sf_dir):
    """Two runs appended to one log and read back; clock times left out."""
    log = shared_folder(spark)
    start = F.to_timestamp(F.lit("2024-01-01 00:00:00"))
    compared, metric_types = _compared_months(spark, sf_dir)
    runs = {
        "run-1": compare.classify_tables(compared, metric_types),
        "run-2": compare.without_result(_failed_customers(spark, sf_dir)),
    }
    for execution_id, results in runs.items():
        times = start, start + F.expr("INTERVAL 1 SECOND"), start + F.expr("INTERVAL 3500 MILLISECONDS")
        append_log(compare.table_log(results, execution_id, *times), path=log)
    rows = spark.read.parquet(log).drop("start_ts", "end_ts")
    return rows.withColumns({c: F.col(c).cast("string") for c in ("duration_exec", "duration_table")})


def column_log(spark, sf_dir):
    log = shared_folder(spark)
    compared, _ = _compared_months(spark, sf_dir)
    append_log(compare.column_log(compared, "run-1"), path=log)
    return spark.read.parquet(log)


def export_gzip(spark, sf_dir):
    """Content rows as gzipped text, read back as bare lines."""
    folder = shared_folder(spark)
    write_content(content_rows_keyed(spark, sf_dir), folder, gzip=True)
    return spark.read.text(folder).select("value")


def export_content_parquet(spark, sf_dir):
    """Documents hold the separator and line breaks; Parquet keeps them apart."""
    folder = shared_folder(spark)
    df = source(spark, sf_dir, "documents")
    write_content(content.content_rows(df, "doc_id", df.columns, []), folder, form="parquet")
    return spark.read.parquet(folder)


def export_lines(spark, sf_dir):
    """Profile lines written as gzipped text, read back and split."""
    folder = shared_folder(spark)
    write_lines(_customer_lines(spark, sf_dir), folder, "2024-01-31", gzip=True)
    found = control_files.read_result_lines(spark, folder, one_per_file=False)
    newest = lines.latest_lines(lines.parse_lines(found))
    return newest.select("table", "row_count", "metric_text")


def incremental_changed(spark, sf_dir):
    """Files and ingests of one table per user, taken from the events."""
    events = read(spark, sf_dir, "events").select(
        F.concat(F.lit("/land/user_"), F.col("user_id").cast("string")).alias("directory"),
        "event_type",
        F.col("ts").alias("modified"),
    )
    manifest = events.where(F.col("event_type").isin("view", "click"))
    changed = table_files.changed_tables(events.drop("event_type"), manifest.drop("event_type"))
    return changed.select("directory", F.col("modified").cast("string").alias("modified"), "reason")


def incremental_ingest(spark, sf_dir):
    """Ingest the copies of a family that changed, then profile what arrived.

    The landing area holds lineitem by return flag; the ``A`` directory was
    ingested before and did not change since.
    """
    folder = shared_folder(spark)
    landing, target = f"{folder}/landing", f"{folder}/target"
    copy = as_text_copy(source(spark, sf_dir, "lineitem"))
    write_unsorted(spark)
    copy.withColumn("flag", F.col("l_returnflag")).write.partitionBy("flag").parquet(landing)
    found = table_files.table_files(spark, landing)
    before = found.where(F.col("directory").endswith("flag=A"))
    changed = table_files.changed_tables(found, before).select("directory").collect()
    sources = {"lineitem_1_prt_" + row.directory.rsplit("=", 1)[-1]: row.directory for row in changed}
    table_files.ingest_family(spark, sources, target)
    family = spark.read.parquet(target)
    metrics = [m._replace(cast=LINEITEM_CASTS.get(m.col, "string")) for m in LINEITEM_METRICS]
    return profile_family(family, DB, "sales", metrics, of_copy=True).select(*PROFILE)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        profile_count, profile_sum, profile_min_max, profile_long, profile_empty_input, profile_filtered,
        profile_by_partition, profile_cast_copy, profile_many_groups, profile_unbounded,
        line_encode, line_decode, line_parse,
        type_candidates, type_mapping, table_list_parse, table_list_keys, table_list_rejects,
        master_lookup, master_missing, export_metrics, metric_types, success_latest, result_latest,
        special_columns, key_validation,
        content_rows_keyed, content_rows_all, content_rows_excluded, content_rows_nulls, content_rows_special,
        compare_metrics, compare_metrics_exact, table_status, table_status_many, failure_class, export_status, run_summary,
        table_log, column_log, export_gzip, export_content_parquet, export_lines, incremental_changed, incremental_ingest,
    )
} | RUNS
