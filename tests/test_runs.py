"""Whole runs on small tables: failures kept apart, predicates, exactness."""

import datetime

import pytest
from pyspark.sql import functions as F

from tallymark.operators import control
from tallymark.operators.lines import mark_missing_type_map
from tallymark.operators.profile import profile_table, sums
from tallymark.plans.batches import Request, write_profiles
from tallymark.plans.reconcile import reconcile

TYPE_MAP = "db string, schema string, table string, ordinal int, gp_column string, gp_type string, ext_column string, ext_type string"
LOG = "db string, schema string, name string, status string, ended string, file_path string, path string, ordinal int"


def _tables(spark, *names):
    rows = [("list", i, f"d|s.{n}") for i, n in enumerate(names)]
    return control.listed_tables(control.parse_table_list(spark.createDataFrame(rows, "path string, ordinal int, value string")))


def _lines(spark, *texts):
    now = datetime.datetime(2024, 1, 1)
    return spark.createDataFrame([(t, f"/f{i}", now) for i, t in enumerate(texts)], "value string, path string, modified timestamp")


def test_failures_stay_apart(spark, tmp_path):
    good = spark.range(3)
    broken = spark.range(3).select(F.raise_error(F.lit("boom")).cast("bigint").alias("id"))

    def build(tables):
        frames = {"a": good, "b": broken, "c": good}
        if "d" in tables:
            raise ValueError("no plan")
        return profile_table(frames[tables[0]], "d", "s", tables[0], sums("id"))

    requests = [Request((t,), build) for t in "abc"] + [Request(("d", "a"), build)]
    outcomes = write_profiles(spark, requests, f"{tmp_path}/profiles", batch_size=3)
    errors = [(o.table, o.error is None) for o in outcomes]
    assert sorted(errors) == [("a", True), ("a", True), ("b", False), ("c", True), ("d", False)]
    assert next(o.error for o in outcomes if o.table == "d") == "no plan"
    assert "boom" in next(o.error for o in outcomes if o.table == "b")
    assert spark.read.parquet(f"{tmp_path}/profiles").where("func = 'SUM'").count() == 3


@pytest.fixture(scope="module")
def copies(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("copies")
    for name, rows in {"t_1_prt_p1": [("1", "10.00")], "t_1_prt_p2": [("2", "5"), ("3", "6.0004")], "empty_1_prt_p1": [], "empty_1_prt_p2": [("1", "1")], "odd": [("x", "y")]}.items():
        spark.createDataFrame(rows, "a string, b string").write.parquet(f"{root}/{name}")
    return root


def _reconcile(spark, copies, folder, names, lines, **options):
    types = [("d", "s", n, i, c, t, c, "string") for n in names for i, (c, t) in enumerate([("a", "bigint"), ("b", "numeric(18,4)")], 1) if n != "odd"]
    log = [("d", "s", n, "SUCCEEDED", "2024", f"/old/{n}", "log", i) for i, n in enumerate(names) if n != "never"]
    run = reconcile(
        spark, _tables(spark, *names), spark.createDataFrame(log, LOG), _lines(spark, *lines),
        spark.createDataFrame(types, TYPE_MAP), str(folder), "x", path_from="/old", path_to=str(copies), **options,
    )
    return run, {r.table: (r.source_count, r.copy_count, r.total_metrics, r.mismatch_metrics, r.status, r.remark.split(" | ")[0]) for r in run.results.collect()}


def test_reconcile(spark, copies, tmp_path):
    names = ["t_1_prt_p1", "t_1_prt_p2", "empty_1_prt_p1", "empty_1_prt_p2", "odd", "never", "lost", "unlined", "garbled", "short"]
    run, found = _reconcile(spark, copies, tmp_path / "run", names, [
        "d|s|t_1_prt_p1|1|SUM(a):1,SUM(b):10.0000,MAX(a):1",
        "d|s|t_1_prt_p2|2|SUM(a):5,SUM(b):11.0000,MAX(a):3",
        "d|s|empty_1_prt_p1|0|SUM(b):0,MIN(a):",
        "d|s|empty_1_prt_p2|1|SUM(b):1.0000,MIN(a):1",
        "d|s|odd|1|MAX(a):x",
        "d|s|lost|1|SUM(a):1",
        "d|s|garbled|many|",
        "d|other|t_1_prt_p1|99|",
        "d|s|short|1|SUM(missing):1",
    ])
    assert found == {
        "t_1_prt_p1": (1, 1, 3, 0, "COMPLETED", "Success"),
        "t_1_prt_p2": (2, 2, 3, 0, "COMPLETED", "Success"),
        # A SUM over nothing is 0 in the line and nothing in the copy.
        "empty_1_prt_p1": (0, 0, 2, 1, "FAILED", "Data Mismatch (1/2)"),
        "empty_1_prt_p2": (1, 1, 2, 0, "COMPLETED", "Success"),
        "odd": (1, 1, 1, 0, "WARNING", "Success"),
        "never": (0, 0, 0, 0, "SKIPPED", "SKIPPED: Status is not SUCCEEDED in any log files"),
        "lost": (0, 0, 0, 0, "FAILED", "Source Parquet Not Found (Check Mount/Path)"),
        "unlined": (0, 0, 0, 0, "FAILED", "GP Result File Missing"),
        "garbled": (0, 0, 0, 0, "FAILED", "Invalid GP Result Format"),
        "short": (0, 0, 0, 0, "FAILED", "Source Parquet Not Found (Check Mount/Path)"),
    }
    log = {r.partition: r for r in run.table_log.collect()}
    assert log["t_1_prt_p1"].table == "t" and log["odd"].status == "warning" and log["t_1_prt_p1"].duration_table >= 0
    assert {(r.partition, r.func, r.col, r.source_value, r.copy_value, r.match) for r in run.column_log.collect() if r.partition == "t_1_prt_p2"} == {
        ("t_1_prt_p2", "SUM", "a", "5", "5", "Matched"),
        ("t_1_prt_p2", "SUM", "b", "11.0000", "11.0004", "Matched"),
        ("t_1_prt_p2", "MAX", "a", "3", "3", "Matched"),
    }
    assert {r.status: r.n for r in run.summary.collect()} == {"COMPLETED": 3, "FAILED": 5, "WARNING": 1, "SKIPPED": 1}


def test_reconcile_exactly_with_predicates(spark, copies, tmp_path):
    master = spark.createDataFrame([("d", "s", "t_1_prt_p2", "b", "a = 2")], "db string, schema string, table string, sum_cols string, where string")
    lines = ["d|s|t_1_prt_p1|1|SUM(b):10.0004", "d|s|t_1_prt_p2|1|SUM(b):5", "d|s|empty_1_prt_p1|0|SUM(b):0"]
    _, found = _reconcile(spark, copies, tmp_path / "run", ["t_1_prt_p1", "t_1_prt_p2", "empty_1_prt_p1"], lines, exact=True, master=master)
    assert {t: r[3:5] for t, r in found.items()} == {
        "t_1_prt_p1": (1, "FAILED"), "t_1_prt_p2": (0, "COMPLETED"), "empty_1_prt_p1": (0, "COMPLETED")
    }


def test_missing_type_map_is_noted(spark):
    noted = mark_missing_type_map(_tables(spark, "t")).collect()
    assert [(r.func, r.value) for r in noted] == [("MIN_MAX_STATUS", "DATA_TYPE_FILE_MISSING")]


def test_special_columns_default_to_none(spark):
    config = spark.createDataFrame([("D", "S.T", "C2", "y"), ("d", " s.t", "c1 ", "Y"), ("d", "s.t", "c3", "N")], "database_name string, original_table_name string, th_column_name string, active_flag string")
    found = control.with_special_columns(_tables(spark, "t", "u"), control.special_columns(config))
    assert {r.table: r.special for r in found.collect()} == {"t": ["c1", "c2"], "u": []}
