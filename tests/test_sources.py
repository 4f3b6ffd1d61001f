"""Profiles taken by the source's own SQL, lines that any value survives, success logs of any shape, the ingest cycle."""

from functools import partial

import duckdb
import pytest
from pyspark.sql import functions as F

from checks.tables import TYPE_NAMES
from tallymark.functions.text import escaped, unescaped
from tallymark.operators import control, lines
from tallymark.operators.profile import Metric, extremes, profile_family, profile_table, sums
from tallymark.plans import ingest
from tallymark.plans.export import export_profiles
from tallymark.sinks.export import write_line_files, write_lines
from tallymark.sources import aggregates
from tallymark.sources import control as files
from tallymark.sources.tables import files_below

# --- aggregates at the source ------------------------------------------------


def test_statement():
    found = aggregates.profile_statements('"s"."t"', [Metric("SUM", "A b"), Metric("MIN", "Order"), Metric("MAX", 'x"y')], "a > 1 -- why")
    assert found == [
        "SELECT CAST(COUNT(*) AS text) AS metric_0, CAST(COALESCE(SUM(\"A b\"), 0) AS text) AS metric_1, "
        "COALESCE(CAST(MIN(\"order\") AS text), '') AS metric_2, COALESCE(CAST(MAX(\"x\"\"y\") AS text), '') AS metric_3 "
        'FROM "s"."t" WHERE (\na > 1 -- why\n)'
    ]
    for nothing in (None, "", " NONE "):
        assert aggregates.profile_statements("t", [], nothing) == ["SELECT CAST(COUNT(*) AS text) AS metric_0 FROM t"]
    with pytest.raises(ValueError):
        aggregates.profile_statements("t", [Metric("AVG", "a")])
    with pytest.raises(ValueError):
        export_profiles(None, None, None, None, None, "")


def test_a_statement_has_no_more_columns_than_a_select_list(spark):
    metrics = sums(*[f"c{i}" for i in range(4000)])
    found = aggregates.profile_statements("t", metrics)
    assert [s.count(" AS metric_") for s in found] == [1600, 1600, 801]
    row = spark.range(1).selectExpr(*[f"'{i}' AS metric_{i}" for i in range(1600, 1603)])
    assert [(r.func, r.col, r.value, r.position) for r in aggregates.as_profile(row, metrics).collect()] == [
        ("SUM", f"c{i - 1}", str(i), i) for i in range(1600, 1603)
    ]


# Values of each source type in DuckDB, whose SQL is that of the warehouse in all that a statement uses.
VALUES = {
    "numeric(18,2)": ["1.50", "-7.25", None], "decimal(10, 4)": ["1.5", "2.25", None], "numeric (12)": ["12", "-3", None],
    "NUMERIC": ["1.5", "99.125", None], "decimal": ["3.25", "0.5", None],
    "character varying(20)": ["b", "B", "é|,", "", None], "varchar": ["x\ny", "x", None], "char(3)": ["abc", None], "TEXT": ["a", None], "string": ["a", "b"],
    "int": ["2147483647", "2147483647", None], "integer": ["-5", "3"], "bigint": ["9223372036854775807", "9223372036854775807"], "smallint": ["7", None],
    "date": ["2024-02-29", "1999-12-31", None], "timestamp with time zone": None, "time without time zone": ["01:02:03", "23:59:59.5", None],
    " Timestamp ": ["2024-01-01 00:00:00.25", "2023-01-01 00:00:00", None],
    "float": ["1.5", "-2.5"], "real": ["1.5", "0.25"], "double precision": ["1.25", "1e3", None],
}


def test_statements_of_every_type(spark):
    """For all types that rules allow, the statement is SQL that gives the metrics as text."""
    mapped = spark.createDataFrame([("d", "s", "t", i, f"C{i}", t, f"C{i}", "string") for i, t in enumerate(TYPE_NAMES)], "db string, schema string, table string, ordinal int, gp_column string, gp_type string, ext_column string, ext_type string")
    listed = spark.createDataFrame([("d", "s", "t", "C0, C10")], "db string, schema string, table string, sum_cols string")
    planned = [Metric(r.func, r.col) for r in control.export_metrics(listed, mapped).orderBy("position").collect()]
    allowed = {TYPE_NAMES[int(m.col[1:])] for m in planned}
    assert set(VALUES) <= allowed and not allowed & {"json", "point", "boolean", "uuid"}
    con = duckdb.connect()
    con.execute("CREATE SCHEMA s")
    for metric in planned:
        kind = TYPE_NAMES[int(metric.col[1:])]
        if not VALUES.get(kind):
            continue
        con.execute(f"CREATE OR REPLACE TABLE s.t ({metric.col} {kind.replace(' (', '(')})")
        for value in VALUES[kind]:
            con.execute("INSERT INTO s.t VALUES (?)", [value])
        (sql,) = aggregates.profile_statements('"s"."t"', [metric])
        count, text = con.execute(sql).fetchone()
        assert count == str(len(VALUES[kind])) and isinstance(text, str)
        kept = [v for v in VALUES[kind] if v is not None]
        if metric.func != "SUM" and kind in ("character varying(20)", "varchar", "date", "string"):
            assert text == (min if metric.func == "MIN" else max)(kept)
    con.execute("CREATE OR REPLACE TABLE s.t (c bigint, d date)")
    (sql,) = aggregates.profile_statements('"s"."t"', sums("C") + extremes("D"))
    assert con.execute(sql).fetchone() == ("0", "0", "", "")
    con.execute("INSERT INTO s.t VALUES (9223372036854775807, NULL), (9223372036854775807, DATE '2024-01-01')")
    assert con.execute(sql).fetchone() == ("2", "18446744073709551614", "2024-01-01", "2024-01-01")


def test_an_export_takes_rows_or_aggregates(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a,b"), (2, None), (3, "x\ny")], "n int, t string")
    rows.createOrReplaceTempView("s_t")
    lists = [("f", i, v) for i, v in enumerate(["d|s.t", "d|s.gone"])]
    listed = control.listed_tables(control.parse_table_list(spark.createDataFrame(lists, "path string, ordinal int, value string")))
    master = control.parse_master_config(spark.createDataFrame([("f", 0, "d|s|t|n|n < 3 -- few"), ("f", 1, "d|s|gone|n|")], "path string, ordinal int, value string"))
    mapped = spark.createDataFrame([("d", "s", "t", 1, "t", "text", "t", "string"), ("d", "s", "gone", 1, "t", "text", "t", "string")], "db string, schema string, table string, ordinal int, gp_column string, gp_type string, ext_column string, ext_type string")

    def aggregate(db, schema, table, metrics, where):
        return aggregates.profile_at_source(spark.sql, db, schema, table, metrics, where, f"`{schema}_{table}`", aggregates.SPARK)

    by_rows = export_profiles(spark, listed, master, mapped, lambda d, s, t: spark.table(f"{s}_{t}"), f"{tmp_path}/rows")
    by_source = export_profiles(spark, listed, master, mapped, None, f"{tmp_path}/source", aggregate=aggregate)
    wanted = [("d", "s", "t", "d|s|t|2|SUM(n):3,MIN(t):a,b,MAX(t):a,b")]
    assert [tuple(r) for r in by_rows.lines.collect()] == [tuple(r) for r in by_source.lines.collect()] == wanted
    assert {r.table: r.status for r in by_source.results.collect()} == {"t": "SUCCESS", "gone": "FAILED"}
    assert "s_gone" in by_source.results.where("table = 'gone'").first().remark
    asked = []
    run = partial(aggregates.profile_at_source, lambda sql: asked.append(sql) or spark.range(1).selectExpr("'0' AS metric_0"))
    assert [tuple(r) for r in run("d", "s", "T", [], "none").collect()] == [("d", "s", "T", "COUNT", "*", "0", 0)]
    assert asked == ['SELECT CAST(COUNT(*) AS text) AS metric_0 FROM "s"."t"']


# --- lines -------------------------------------------------------------------

ODD = ["", " ", "\t a\n", "a|b", "a,MAX(x):1", "%", "%2C", "%_", "%25%_%", "x\ny\r\nz", "(c)", "MIN_MAX_STATUS: no", "日本 é\x00", "\\n", "a" * 5000 + "\n"]


def test_escapes(spark):
    rows = spark.createDataFrame([(v,) for v in ODD], "v string").select("v", escaped(F.col("v")).alias("e")).withColumn("u", unescaped(F.col("e")))
    found = rows.collect()
    assert all(r.u == r.v and not set(r.e) & set("|,()\n\r") and r.e.strip(" \t\n\r\x0b\x0c") == r.e for r in found)
    assert {r.v: r.e for r in found}["a|b"] == "a%7Cb"


def test_any_value_survives_a_line(spark, tmp_path):
    """Many tables in one file, one metric per odd value and column name."""
    rows = [("d", "s", f"t{i}", "COUNT", "*", "1", 0) for i in range(len(ODD))]
    rows += [("d", "s", f"t{i}", f, c, v, p) for i, v in enumerate(ODD) for p, (f, c) in enumerate([("MIN", "a"), ("MAX", "odd (|,%) name")], 1)]
    profile = spark.createDataFrame(rows, "db string, schema string, table string, func string, col string, value string, position int")
    write_lines(lines.encode_lines(profile, escape=True), f"{tmp_path}/lines", "2024-01-31")
    found = lines.parse_lines(files.read_result_lines(spark, f"{tmp_path}/lines", one_per_file=False))
    assert sorted(lines.decode_lines(found, escape=True).collect()) == sorted(profile.collect())


@pytest.mark.parametrize("gzip", [False, True])
def test_one_file_per_table(spark, tmp_path, gzip):
    values = ["d|s|t|1|MAX(a):x\ny", "d|s|t_1_prt_p1|2|MIN(a):x\n\n", "d|s2|t|3|", "no line at all\n|", "d=/|s|%41 é|4|SUM(a):1"]
    rows = spark.createDataFrame([(v,) for v in values], "value string")
    write_line_files(rows, str(tmp_path), "2024-01-31", gzip=gzip)
    found = files.read_line_files(spark, str(tmp_path))
    assert sorted(r.value for r in found.collect()) == sorted(values)
    parsed = {(r.db, r.schema, r.table): (r.row_count, r.reason) for r in lines.parse_lines(found).collect()}
    assert parsed["d", "s", "t"] == (1, None) and parsed["d=/", "s", "%41 é"] == (4, None)
    assert sum(reason is not None for _, reason in parsed.values()) == 1
    assert {r.metric_text for r in lines.parse_lines(rows.limit(1).selectExpr("value || '|b|c' AS value"), whole=True).collect()} == {"MAX(a):x\ny|b|c"}
    write_line_files(rows.limit(1), str(tmp_path), "2024-02-01")
    assert lines.latest_lines(lines.parse_lines(files.read_line_files(spark, str(tmp_path)))).count() == 5


# --- success logs ------------------------------------------------------------


def _log(tmp_path, run, text, schema="s"):
    path = tmp_path / "d" / run / f"offloadgp_stat_succeeded.{schema}.csv"
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode())


def test_logs_of_any_shape(spark, tmp_path):
    _log(tmp_path, "r1", "\n\nGreenplum_Tbl,Run_Status\na,SUCCEEDED\nb\n\nGreenplum_Tbl,Run_Status\n,SUCCEEDED\n")
    _log(tmp_path, "r2", "1,c,SUCCEEDED,2024-01-01,/c\n2,a,SUCCEEDED,2024-01-02,/a\n3\n")
    _log(tmp_path, "r3", "﻿Run_Status,x y,Greenplum_Tbl\r\nFAILED,1,e,more,cells\r\n")
    _log(tmp_path, "r4", "")
    found = {(r.name, r.status, r.ended, r.file_path) for r in files.read_success_log(spark, str(tmp_path)).collect()}
    assert found == {("a", "SUCCEEDED", None, None), (None, "SUCCEEDED", None, None), ("e", "FAILED", None, None)}
    rejected = [(r.value, r.reason) for r in files.rejected_log_rows(spark, str(tmp_path)).collect()]
    assert sorted(rejected) == sorted(
        [("b", files.TOO_FEW_FIELDS)] + [(v, files.NO_HEADER) for v in ("1,c,SUCCEEDED,2024-01-01,/c", "2,a,SUCCEEDED,2024-01-02,/a", "3")]
    )
    positions = ["Id", "Greenplum_Tbl", "Run_Status", "End_Timestamp_Script", "File_Path"]
    latest = control.latest_success(files.read_success_log(spark, str(tmp_path), positions))
    assert {r.table: r.file_path for r in latest.collect()} == {"a": "/a", "c": "/c"}
    assert sorted(r.reason for r in files.rejected_log_rows(spark, str(tmp_path), positions).collect()) == [files.TOO_FEW_FIELDS] * 2


# --- ingest ------------------------------------------------------------------


def _listed(spark, tmp_path, *tables):
    return spark.createDataFrame([("d", "s", t, f"{tmp_path}/land/{t}/") for t in tables], "db string, schema string, table string, directory string")


def _states(run):
    return {r.table: (r.reason, r.status) for r in run.results.collect()}


def test_ingest_cycle(spark, tmp_path):
    root, manifest = f"{tmp_path}/copies", f"{tmp_path}/manifest"
    frames = {
        "plain": spark.range(5).selectExpr("id", "'a' AS ingest_no"), "other": spark.range(3).selectExpr("cast(id AS string) AS Id", "'b' AS ingest_no"),
        "nested": spark.range(4).selectExpr("id", "id % 2 AS part"), "empty": spark.range(0).selectExpr("id", "'x' AS ingest_no"),
    }
    for name, df in frames.items():
        writer = df.write.partitionBy("part") if name == "nested" else df.write
        writer.parquet(f"{tmp_path}/land/{name}")
    (tmp_path / "land" / "broken").mkdir()
    (tmp_path / "land" / "broken" / "a.parquet").write_bytes(b"no parquet")
    listed = _listed(spark, tmp_path, *frames, "broken", "nowhere", "plain")

    def cycle():
        return _states(ingest.ingest_changed(spark, listed, root, manifest, batch_size=2))

    def copies():
        return {r.table: r.copy for r in ingest.current_copies(ingest.read_manifest(spark, manifest)).collect()}

    good = dict.fromkeys(frames, ("new", "COPIED"))
    bad = {"broken": (None, "FAILED"), "nowhere": (None, "FAILED")}
    assert cycle() == good | bad
    for name, df in frames.items():
        back = spark.read.parquet(copies()[name])
        assert sorted(map(str, back.select(*df.columns).collect())) == sorted(map(str, df.collect()))
    first = copies()
    current = dict.fromkeys(frames, ("current", "CURRENT"))
    assert cycle() == current | bad and copies() == first
    # A source that changed, a copy that is gone, one of which only markers are left, a table of another place.
    frames["plain"].write.mode("append").parquet(f"{tmp_path}/land/plain")
    spark.createDataFrame([], "value string").write.mode("overwrite").text(first["other"])
    assert cycle() == current | bad | {"plain": ("newer", "COPIED"), "other": ("missing", "COPIED")}
    assert spark.read.parquet(copies()["plain"]).count() == 10 and spark.read.parquet(first["plain"]).count() == 5
    assert spark.read.parquet(copies()["other"]).count() == 3
    gone = {r.copy for r in ingest.superseded_copies(ingest.read_manifest(spark, manifest)).collect()}
    assert gone == {first["plain"], first["other"]}
    frames["plain"].write.parquet(f"{tmp_path}/elsewhere")
    listed = spark.createDataFrame([("d", "s", "plain", f"{tmp_path}/elsewhere")], listed.schema)
    assert cycle() == {"plain": ("moved", "COPIED")} and cycle() == {"plain": ("current", "CURRENT")}
    assert _states(ingest.ingest_changed(spark, listed.where("false"), root, manifest)) == {}


def test_a_copy_that_fails_leaves_the_last_one(spark, tmp_path, monkeypatch):
    root, manifest = f"{tmp_path}/copies", f"{tmp_path}/manifest"
    for name in ("a", "b", "c"):
        spark.range(2).write.parquet(f"{tmp_path}/land/{name}")
    listed = _listed(spark, tmp_path, "a", "b", "c")
    ingest.ingest_changed(spark, listed, root, manifest)
    before = {r.table: r.copy for r in ingest.current_copies(ingest.read_manifest(spark, manifest)).collect()}
    for name in ("a", "b", "c"):
        spark.range(9).write.mode("overwrite").parquet(f"{tmp_path}/land/{name}")
    together = ingest._copy_together

    def failing(spark, members, column, folder):
        if any(table[2] == "b" for _, table, _, _ in members):
            raise RuntimeError("disk full")
        together(spark, members, column, folder)

    monkeypatch.setattr(ingest, "_copy_together", failing)
    run = ingest.ingest_changed(spark, listed, root, manifest)
    assert _states(run) == {"a": ("newer", "COPIED"), "b": ("newer", "FAILED"), "c": ("newer", "COPIED")}
    after = {r.table: r.copy for r in ingest.current_copies(ingest.read_manifest(spark, manifest)).collect()}
    assert after["b"] == before["b"] and after["a"] != before["a"] and spark.read.parquet(after["c"]).count() == 9


def test_files_below(spark, tmp_path):
    spark.range(1).selectExpr("id", "1 AS p").write.partitionBy("p").parquet(f"{tmp_path}/t é")
    spark.range(1).write.parquet(f"{tmp_path}/t2")
    found = files_below(spark, [f"{tmp_path}/t é", f"file:{tmp_path}/t2"])
    assert {r.directory for r in found.collect()} == {f"{tmp_path}/t é", f"file:{tmp_path}/t2"}
    assert files_below(spark, []).count() == 0


def test_profiles_of_either_side_agree(spark):
    rows = spark.createDataFrame([(1, "b", 1.5), (2, None, None)], "n int, t string, x double")
    rows.createOrReplaceTempView("agreeing")
    metrics = sums("n") + extremes("t", "n")
    here = profile_table(rows, "d", "s", "agreeing", metrics).collect()
    there = aggregates.profile_at_source(spark.sql, "d", "s", "agreeing", metrics, relation="agreeing", dialect=aggregates.SPARK).collect()
    assert sorted(map(tuple, here)) == sorted(map(tuple, there))
    assert profile_family(rows.withColumn("table", F.lit("p")), "d", "s", metrics).count() == len(here)
