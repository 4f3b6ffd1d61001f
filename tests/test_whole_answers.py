"""Answers that must not depend on file order, on neighbours, on digits cut off or on characters in values."""

import pytest
from pyspark.sql import functions as F

from tallymark.functions import rules, types
from tallymark.operators import control
from tallymark.operators.content import key_columns
from tallymark.operators.profile import Metric, profile_table, sums
from tallymark.plans import batches
from tallymark.plans.batches import Request, write_profiles
from tallymark.plans.export import export_profiles
from tallymark.plans.reconcile import reconcile
from tallymark.sinks.export import write_lines
from tallymark.sources import control as files

TYPE_MAP = "db string, schema string, table string, ordinal int, gp_column string, gp_type string, ext_column string, ext_type string"
LOG = "db string, schema string, name string, status string, ended string, file_path string, path string, ordinal int"


def _tables(spark, *names):
    return control.listed_tables(control.parse_table_list(_control(spark, *[f"d|s.{n}" for n in names])))


def _control(spark, *lines):
    return spark.createDataFrame([("f", i, v) for i, v in enumerate(lines)], "path string, ordinal int, value string")


def test_success_logs_are_read_by_their_own_headers(spark, tmp_path):
    for run, text in {
        "r1": 'Id,Greenplum_Tbl,Run_Status,End_Timestamp_Script,File_Path\n1,t,SUCCEEDED,2024-01-01,"/a,b"\n',
        "r2": "File_Path,Run_Status,Greenplum_Tbl,End_Timestamp_Script\r\n/u,SUCCEEDED,u,2024-01-02\r\n,SUCCEEDED,v,\r\n",
        "r3": "no,header,here\n",
    }.items():
        (tmp_path / "d" / run).mkdir(parents=True)
        (tmp_path / "d" / run / "offloadgp_stat_succeeded.s.csv").write_bytes(text.encode())
    found = {r.name: (r.db, r.schema, r.status, r.ended, r.file_path) for r in files.read_success_log(spark, str(tmp_path)).collect()}
    assert found == {
        "t": ("d", "s", "SUCCEEDED", "2024-01-01", "/a,b"), "u": ("d", "s", "SUCCEEDED", "2024-01-02", "/u"),
        "v": ("d", "s", "SUCCEEDED", None, None),
    }


@pytest.mark.parametrize("left, right, same", [
    ("0.00000000001", "0", False), ("90071992547409930.01", "90071992547409930.02", False), ("1.50", "+01.5", True),
    ("1e3", "1000", True), ("-0.0", "0", True), ("-1", "1", False), ("1" * 60 + ".1", "1" * 60 + ".10", True),
    ("1" * 60 + ".1", "1" * 60 + ".2", False), (".5", "5e-1", True), ("x", "x", True), ("", "0", False), ("100", "10", False),
])
def test_exact_numbers(spark, left, right, same):
    row = spark.createDataFrame([(left, right)], "a string, b string")
    assert row.select(rules.metric_matches_exactly(F.lit("SUM"), F.lit("numeric"), F.col("a"), F.col("b"))).first()[0] is same


def test_exact_plain_numbers_keep_their_digits(spark):
    kinds = spark.createDataFrame([("numeric",), ("numeric(9,3)",), ("int",), ("numeric[]",)], "t string").select(types.exact_cast_type(F.col("t")))
    assert [r[0] for r in kinds.collect()] == ["decimal(38,18)", "decimal(9,3)", "long", "string"]


def test_a_value_with_the_line_separator_raises(spark, tmp_path):
    rows = spark.createDataFrame([("d|s|t|1|MIN(a):x\ny,MAX(a):z",)], "value string")
    with pytest.raises(Exception, match="line separator"):
        write_lines(rows, str(tmp_path / "a"), "2024-01-31")
    write_lines(rows, str(tmp_path / "b"), "2024-01-31", line_sep="\x1e")
    assert files.read_result_lines(spark, str(tmp_path / "b"), one_per_file=False, line_sep="\x1e").first().value == rows.first().value


def test_empty_key_lists_are_errors(spark):
    for keys in ("", " , ", []):
        with pytest.raises(ValueError, match="No key columns"):
            key_columns(keys, ["a"])
    listed = control.listed_tables(control.parse_table_list(_control(spark, "d|s.t| , ", "d|s.u|", "d|s.v|ALL", "d|s.w|a"), with_keys=True))
    types_ = spark.createDataFrame([("d", "s", t, 1, "a", "int", "a", "string") for t in "tuvw"], TYPE_MAP)
    assert {r.table: r.error for r in control.resolve_keys(listed, types_).collect()} == {
        "t": control.NO_KEYS, "u": control.NO_KEYS, "v": None, "w": None
    }


def test_quoted_configuration(spark):
    lines = ['''d|s|t|a|"x || y = 'ab'"''', 'd|s|u|"a,b"|"q"" = 1', 'd|s|v||"x" = "y"', "|s|w||none", "d|s|short|a"]
    found = {r.table: (r.db, r.sum_cols, r.where) for r in control.parse_master_config(_control(spark, *lines)).collect()}
    assert found == {"t": ("d", "a", "x || y = 'ab'"), "u": ("d", "a,b", '"q"" = 1'), "v": ("d", "", '"x" = "y"'), "w": ("", "", "none")}


def test_a_table_listed_twice_counts_once_and_runs_do_not_mix(spark, tmp_path):
    types_ = spark.createDataFrame([("d", "s", "t", 1, "a", "int", "a", "string")], TYPE_MAP)
    master = control.parse_master_config(_control(spark, "d|s|t|a|none"))
    for _ in range(2):
        run = export_profiles(spark, _tables(spark, "t", "t"), master, types_, lambda *_: spark.range(1, 3).selectExpr("id AS a"), str(tmp_path))
        assert [r.value for r in run.lines.collect()] == ["d|s|t|2|SUM(a):3,MIN(a):1,MAX(a):2"]


def test_a_copy_that_lost_a_column_fails_beside_its_family_as_alone(spark, tmp_path, monkeypatch):
    names = [f"t_1_prt_p{i}" for i in range(5)]
    for i, name in enumerate(names[:4]):
        columns = ["a"] if i == 1 else ["a", "b"]
        spark.createDataFrame([("1",) * len(columns)], ", ".join(f"{c} string" for c in columns)).write.parquet(f"{tmp_path}/c/{name}")
    log = spark.createDataFrame([("d", "s", n, "SUCCEEDED", "2024", f"{tmp_path}/c/{n}", "log", i) for i, n in enumerate(names)], LOG)
    types_ = spark.createDataFrame([("d", "s", n, i, c, "text", c, "string") for n in names for i, c in enumerate("ab", 1)], TYPE_MAP)
    lines = [(f"d|s|{n}|1|MIN(a):1,MIN(b):{'' if n.endswith('p1') else 1}", n) for n in names]
    lines = spark.createDataFrame(lines, "value string, path string").withColumn("modified", F.current_timestamp())
    planned = []
    monkeypatch.setattr("tallymark.plans.reconcile.write_profiles", lambda s, r, *x: planned.extend(r) or write_profiles(s, r, *x))
    run = reconcile(spark, _tables(spark, *names), log, lines, types_, str(tmp_path / "run"), "x")
    assert {r.table[-2:]: (r.status, r.remark.split(" | ")[0]) for r in run.results.collect()} == {
        "p0": ("COMPLETED", "Success"), "p2": ("COMPLETED", "Success"), "p3": ("COMPLETED", "Success"),
        "p1": ("FAILED", "PySpark Aggregation Failed (Check Data/Schema)"),
        "p4": ("FAILED", "Source Parquet Not Found (Check Mount/Path)"),
    }
    assert sorted(len(r.tables) for r in planned) == [1, 3]


def test_a_failing_batch_runs_again_in_halves(spark, tmp_path, monkeypatch):
    good, bad = spark.range(3), spark.range(3).select(F.raise_error(F.lit("boom")).cast("bigint").alias("id"))
    sizes = []
    write = batches._write
    monkeypatch.setattr(batches, "_write", lambda profiles, folder: sizes.append(len(profiles)) or write(profiles, folder))
    names = [f"t{i}" for i in range(8)]
    requests = [Request((t,), lambda ts: profile_table(bad if ts[0] == "t5" else good, "d", "s", ts[0], sums("id"))) for t in names]
    outcomes = write_profiles(spark, requests, str(tmp_path / "p"))
    assert sizes == [8, 4, 4, 2, 1, 1, 2]
    assert [o.table for o in outcomes if o.error] == ["t5"] and sorted(o.table for o in outcomes) == names
    assert spark.read.parquet(str(tmp_path / "p")).where("func = 'SUM'").count() == 7


def test_one_scan_at_any_width(spark, tmp_path):
    wide = spark.range(4).select(*[(F.col("id") + i).alias(f"c{i}") for i in range(60)])
    wide.write.parquet(str(tmp_path / "wide"))
    profile = profile_table(spark.read.parquet(str(tmp_path / "wide")), "d", "s", "t", [Metric("MAX", f"c{i}") for i in range(60)])
    assert profile._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert {r.value for r in profile.where("col = 'c59'").collect()} == {"62"}
