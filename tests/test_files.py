"""Control files, copies, sinks and ingest on disk."""

import gzip
import os
import time

import pytest
from pyspark.sql import functions as F

from tallymark.operators import control, lines
from tallymark.operators.content import content_rows
from tallymark.operators.profile import Metric, profile_family
from tallymark.sinks.export import FOLDERS_AT_ONCE, append_log, write_content, write_lines
from tallymark.sources import control as files
from tallymark.sources import tables


def _write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_type_maps(spark, tmp_path):
    header = "gp_column_nm|gp_datatype|ext_column_nm|ext_datatype\n"
    _write(tmp_path / "db1/s/t.csv", header + "b|numeric(18,2)|b|string\n\na| varchar(3) |a|text\n")
    _write(tmp_path / "db1/s/t_long.csv", "extra|ext_datatype|gp_datatype|gp_column_nm|ext_column_nm\r\n1|string|int|c|C\r\n")
    _write(tmp_path / "db1/s/only_header.csv", header)
    found = files.read_type_map(spark, str(tmp_path))
    rows = {(r.table, r.ordinal): (r.db, r.schema, r.gp_column, r.gp_type, r.ext_column, r.ext_type) for r in found.collect()}
    assert rows[("t", 1)] == ("db1", "s", "b", "numeric(18,2)", "b", "string")
    assert rows[("t", 3)] == ("db1", "s", "a", "varchar(3)", "a", "text")
    assert rows[("t_long", 1)] == ("db1", "s", "c", "int", "C", "string")
    assert rows[("only_header", 0)] == ("db1", "s", None, None, None, None)
    presence = {r.table: r.mapped_columns for r in control.type_map_presence(found).collect()}
    assert presence == {"t": 2, "t_long": 1, "only_header": 0}
    types = {(r.table, r.type_key): r.source_type for r in control.metric_types(found).collect()}
    assert types == {("t", "b"): "numeric(18,2)", ("t", "a"): "varchar(3)", ("t_long", "C"): "int"}
    assert ("t_long", "c") in {(r.table, r.type_key) for r in control.metric_types(found, exact=True).collect()}


def test_a_type_map_is_read_in_lines(spark, tmp_path):
    """A map of many columns was one row, all of which went along with each of its lines: 22,500 lines ended a heap of 3 GB."""
    header = "gp_column_nm|gp_datatype|ext_column_nm|ext_datatype"
    _write(tmp_path / "db/s/wide.csv", "\r\n".join([header, "", *(f"c{i}|int|X{i}|string" for i in range(200)), ""]))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100")
    try:
        found = files.read_type_map(spark, str(tmp_path))
        rows = {(r.table, r.ordinal): (r.gp_column, r.ext_column) for r in found.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert rows == {("wide", 0): (None, None)} | {("wide", i + 2): (f"c{i}", f"X{i}") for i in range(200)}
    assert "Generate" not in found._jdf.queryExecution().toString()


def test_lists_and_master_config(spark, tmp_path):
    path = _write(tmp_path / "list.txt", "# comment\n\nd|s.t_1_prt_p1\n d | s.u \nd|s.u.v\nd|t\nd\n")
    parsed = control.parse_table_list(files.read_lines(spark, path))
    listed = [(r.db, r.schema, r.table, r.base_table, r.part) for r in control.listed_tables(parsed).orderBy("ordinal").collect()]
    assert listed == [("d", "s", "t_1_prt_p1", "t", "p1"), ("d", "s", "u", "u", None)]
    assert control.rejected_entries(parsed).count() == 3
    keyed = control.parse_table_list(files.read_lines(spark, path), with_keys=True)
    assert control.listed_tables(keyed).count() == 0 and control.rejected_entries(keyed).count() == 5
    config = _write(tmp_path / "master.txt", "d|s|u|a,b|none\nshort|line\nd|s|u| c |x > 1|extra\n")
    master = control.parse_master_config(files.read_lines(spark, config))
    assert [tuple(r) for r in master.collect()] == [("d", "s", "u", "c", "x > 1")]


def test_success_logs(spark, tmp_path):
    header = "Id,Greenplum_Tbl,Run_Status,End_Timestamp_Script,File_Path\n"
    _write(tmp_path / "d/run1/offloadgp_stat_succeeded.s.csv", header + "1,t,SUCCEEDED,2024-02-01,/a\n2,t,SUCCEEDED,2024-02-01,/late\n3,s.u,SUCCEEDED,2024-09-01,/u1\n")
    _write(tmp_path / "d/run2/offloadgp_stat_succeeded.s.csv", header + "1,t,SUCCEEDED,2024-02-01,/b\n2,t,SUCCEEDED,2024-02-01,/c\n3,t,FAILED,2024-12-01,/f\n4,u,SUCCEEDED,2024-01-01,/u2\n5,s.v,SUCCEEDED,2024-1-01,/v\n")
    latest = control.latest_success(files.read_success_log(spark, str(tmp_path)))
    assert {r.table: r.file_path for r in latest.collect()} == {"t": "/b", "u": "/u2", "v": "/v"}


def test_result_lines(spark, tmp_path):
    old, new = tmp_path / "r1/d_t_1.txt", tmp_path / "r2/d_t_2.txt"
    _write(old, "d|s|t|1|MAX(a):x\ny\n")
    _write(new, "d|s|t|2|\n")
    _write(tmp_path / "r2/d_t_1_prt_p1_2.txt", "d|s|t_1_prt_p1|9|\n")
    os.utime(new, (time.time() - 5000,) * 2)
    found = lines.latest_lines(lines.parse_lines(files.read_result_lines(spark, f"{tmp_path}/*/d_t_*.txt")))
    assert {r.table: (r.row_count, r.metric_text) for r in found.collect()} == {"t": (1, "MAX(a):x\ny"), "t_1_prt_p1": (9, "")}


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("a|b", 1), (None, 2)], "x string, y int")
    content = content_rows(rows, "y", ["x", "y"], [])
    write_content(content, f"{tmp_path}/text", gzip=True)
    texts = [gzip.open(p, "rt").read() for p in (tmp_path / "text").glob("*.txt.gz")]
    assert sorted("".join(texts).splitlines()) == sorted(
        f"{r.hash_key}|{r.key}|{r.hash_content}|{r.content}" for r in content.collect()
    )
    write_content(content, f"{tmp_path}/parquet", form="parquet")
    assert sorted(spark.read.parquet(f"{tmp_path}/parquet").collect()) == sorted(content.collect())
    with pytest.raises(ValueError):
        write_content(content, f"{tmp_path}/x", form="csv")
    write_lines(spark.createDataFrame([("d|s|t|1|",)], "value string"), f"{tmp_path}/lines", "2024-01-31")
    assert "".join(p.read_text() for p in (tmp_path / "lines/run_date=2024-01-31").glob("*.txt")) == "d|s|t|1|\n"
    broken = spark.createDataFrame([("d|s|t|1|MAX(a):x\ny",), ("d|s|u|2|",)], "value string")
    write_lines(broken, f"{tmp_path}/broken", "2024-01-31", gzip=True, line_sep="\x1e\n")
    found = files.read_result_lines(spark, f"{tmp_path}/broken", one_per_file=False, line_sep="\x1e\n")
    assert sorted(found.select("value").collect()) == sorted(broken.collect())
    for _ in range(2):
        append_log(rows, path=f"{tmp_path}/log")
        append_log(rows, table="result_log")
    assert spark.read.parquet(f"{tmp_path}/log").count() == spark.table("result_log").count() == 4
    with pytest.raises(ValueError):
        append_log(rows)


def test_families_and_ingest(spark, tmp_path):
    for part, values in (("p1", ["1", "2"]), ("p2", ["x"])):
        spark.createDataFrame([(v,) for v in values], "a string").write.parquet(f"{tmp_path}/in/t_{part}")
    paths = {f"t_1_prt_{p}": f"{tmp_path}/in/t_{p}" for p in ("p1", "p2")}
    family = tables.parquet_family(spark, paths)
    found = profile_family(family, "d", "s", [Metric("SUM", "a", "long")], of_copy=True)
    assert {(r.table, r.func): r.value for r in found.collect()} == {
        ("t_1_prt_p1", "COUNT"): "2", ("t_1_prt_p1", "SUM"): "3", ("t_1_prt_p2", "COUNT"): "1", ("t_1_prt_p2", "SUM"): None
    }
    landed = tables.table_files(spark, f"{tmp_path}/in")
    nothing = spark.createDataFrame([], landed.schema)
    assert tables.changed_tables(landed, nothing).count() == 2
    assert tables.changed_tables(landed, landed).count() == 0
    aged = landed.withColumn("modified", F.when(F.col("directory").endswith("p1"), F.col("modified") - F.expr("INTERVAL 1 SECOND")).otherwise(F.col("modified")))
    assert [r.reason for r in tables.changed_tables(landed, aged).collect()] == ["newer"]
    unknown = landed.withColumn("modified", F.when(F.col("directory").endswith("p2"), F.col("modified")))
    assert tables.changed_tables(unknown, landed).count() == 1
    target = f"{tmp_path}/out"
    tables.ingest_family(spark, paths, target)
    tables.ingest_family(spark, {"t_1_prt_p1": paths["t_1_prt_p1"]}, target)
    assert spark.read.parquet(target).groupBy("table").count().orderBy("table").collect() == [("t_1_prt_p1", 2), ("t_1_prt_p2", 1)]
    tables.ingest(spark, paths["t_1_prt_p1"], f"{tmp_path}/single")
    tables.ingest(spark, paths["t_1_prt_p2"], f"{tmp_path}/single")
    assert spark.read.parquet(f"{tmp_path}/single").count() == 1


def test_a_family_is_ingested_without_shuffle_or_sort(spark, tmp_path):
    """All rows of a partition met in one task, to find its name, and were sorted there."""
    for part in range(FOLDERS_AT_ONCE + 2):
        spark.range(part, 40, 1, 4).select(F.col("id").cast("string").alias("a")).write.parquet(f"{tmp_path}/in/t_{part}")
    paths = {f"t_1_prt_{p}": f"{tmp_path}/in/t_{p}" for p in range(FOLDERS_AT_ONCE + 2)}
    plan = tables.parquet_family(spark, paths)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    name = "spark.sql.maxConcurrentOutputFileWriters"
    spark.conf.unset(name)
    for writers in (None, "2"):
        if writers:
            spark.conf.set(name, writers)
        target = f"{tmp_path}/out{writers}"
        tables.ingest_family(spark, paths, target)
        assert spark.conf.get(name) == (writers or str(FOLDERS_AT_ONCE))
        found = spark.read.parquet(target).groupBy("table").agg(F.count("*"), F.sum(F.col("a").cast("int"))).collect()
        assert {tuple(r) for r in found} == {(f"t_1_prt_{p}", 40 - p, sum(range(p, 40))) for p in range(FOLDERS_AT_ONCE + 2)}
    spark.conf.unset(name)


def test_jdbc_options():
    assert tables.jdbc_options("jdbc:x", table="s.t", where="none") == {
        "url": "jdbc:x", "fetchsize": "10000", "query": "SELECT * FROM s.t"
    }
    split = tables.jdbc_options("jdbc:x", table="s.t", where="a > 1", split_on="id", bounds=(0, 99), splits=4)
    assert split["dbtable"] == "(SELECT * FROM s.t WHERE a > 1) AS source"
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"], split["numPartitions"]) == ("id", "0", "99", "4")
    for wrong in ({}, {"query": "q", "table": "t"}, {"query": "q", "where": "a"}, {"table": "t", "split_on": "id"}):
        with pytest.raises(ValueError):
            tables.jdbc_options("jdbc:x", **wrong)
