"""Families exported in one aggregate, logs that a rerun does not double, records kept between runs, guarded casts."""

import os

import pytest
from pyspark.sql import functions as F

from tallymark.operators import control, lines
from tallymark.operators.profile import Metric, extremes, profile_table, sums
from tallymark.plans import batches
from tallymark.plans.export import export_profiles, planned_families
from tallymark.plans.latest import refresh_lines, refresh_success
from tallymark.sinks.export import read_log, replace_log, write_line_files
from tallymark.sources.control import read_success_log

TYPE_MAP = "db string, schema string, table string, ordinal int, gp_column string, gp_type string, ext_column string, ext_type string"


def _control(spark, *rows):
    return spark.createDataFrame([("f", i, v) for i, v in enumerate(rows)], "path string, ordinal int, value string")


def _listed(spark, *names):
    return control.listed_tables(control.parse_table_list(_control(spark, *[f"d|s.{n}" for n in names])))


# --- families ----------------------------------------------------------------


def test_a_family_is_one_request(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([("t_1_prt_a", 1, "x"), ("t_1_prt_a", 5, "y|z"), ("t_1_prt_b", 2, None), ("t_1_prt_c", 9, "c"), ("unlisted", 7, "u")], "part string, n int, t string")
    listed = _listed(spark, "t_1_prt_a", "t_1_prt_b", "t_1_prt_c", "t_1_prt_empty", "t_1_prt_wrong", "t_1_prt_other", "no_config")
    master = control.parse_master_config(_control(
        spark, "d|s|t_1_prt_a|n|n > 1 -- not one", "d|s|t_1_prt_b|n|none", "d|s|t_1_prt_c|n|n < 0 OR 1 = 0", "d|s|t_1_prt_empty|n|",
        "d|s|t_1_prt_wrong|n|no_such > 1", "d|s|t_1_prt_other|gone|",
    ))
    mapped = spark.createDataFrame([("d", "s", f"t_1_prt_{p}", 1, "t", "text", "t", "string") for p in ("a", "b", "c", "empty", "wrong")], TYPE_MAP)
    asked, sizes = [], []
    run = batches._run
    monkeypatch.setattr(batches, "_run", lambda parts, folder: sizes.append([len(t) for t, _, _ in parts]) or run(parts, folder))

    def family(db, schema, base):
        asked.append(base)
        return rows

    found = export_profiles(spark, listed, master, mapped, None, str(tmp_path), read_family=family, family_column="part")
    got = {r.table: r.value for r in found.lines.collect()}
    assert got == {
        "t_1_prt_a": "d|s|t_1_prt_a|1|SUM(n):5,MIN(t):y|z,MAX(t):y|z", "t_1_prt_b": "d|s|t_1_prt_b|1|SUM(n):2,MIN(t):,MAX(t):",
        "t_1_prt_c": "d|s|t_1_prt_c|0|SUM(n):0,MIN(t):,MAX(t):", "t_1_prt_empty": "d|s|t_1_prt_empty|0|SUM(n):0,MIN(t):,MAX(t):",
    }
    status = {r.table: r.status for r in found.results.collect()}
    assert status == dict.fromkeys(got, "SUCCESS") | {"t_1_prt_wrong": "FAILED", "t_1_prt_other": "FAILED", "no_config": "SKIPPED"}
    right = listed.where("table not like '%wrong' and table not like '%other'")
    sizes.clear()
    export_profiles(spark, right, master, mapped, None, str(tmp_path), read_family=family, family_column="part")
    assert sizes == [[4]] and asked[-1] == "t"


def test_planned_families(spark):
    tables = spark.createDataFrame([("d", "s", "a_1_prt_1", "a", "x > 1"), ("d", "s", "a_1_prt_2", "a", None), ("d", "s", "a_1_prt_3", "a", None), ("d", "s", "b", "b", None)], "db string, schema string, table string, base_table string, where string")
    place = "struct(0 AS rank, 1L AS place)"
    metrics = spark.createDataFrame([("d", "s", "a_1_prt_1", "SUM", "x"), ("d", "s", "a_1_prt_2", "SUM", "x"), ("d", "s", "a_1_prt_3", "MIN", "y")], "db string, schema string, table string, func string, col string").withColumn("position", F.expr(place))
    families = {tuple(m.table for m in r.members): [(m.func, m.col) for m in r.metrics] for r in planned_families(tables, metrics).collect()}
    assert families == {("a_1_prt_1", "a_1_prt_2"): [("SUM", "x")], ("a_1_prt_3",): [("MIN", "y")], ("b",): []}
    assert planned_families(tables, metrics, together=False).count() == 4


def test_a_family_that_cannot_be_planned_is_halved(spark, tmp_path):
    planned = []

    def build(members):
        if "bad" in members:
            raise ValueError("no such column")
        planned.append(members)
        return profile_table(spark.range(len(members)), "d", "s", members[0], sums("id"))

    outcomes = batches.write_profiles(spark, [batches.Request(("a", "b", "c", "d", "bad", "f", "g", "h"), build)], str(tmp_path))
    assert {o.table for o in outcomes if o.error} == {"bad"} and len(outcomes) == 8
    assert sorted(map(len, planned)) == [1, 2, 4]


def test_requests_may_come_as_a_stream(spark, tmp_path):
    def requests():
        for name in "abcde":
            yield batches.Request((name,), lambda members: profile_table(spark.range(3), "d", "s", members[0], sums("id")))

    outcomes = batches.write_profiles(spark, requests(), str(tmp_path), batch_size=2)
    assert sorted(o.table for o in outcomes) == list("abcde") and all(o.error is None for o in outcomes)
    assert spark.read.parquet(str(tmp_path)).count() == 10


# --- logs --------------------------------------------------------------------


def test_a_rerun_replaces_its_own_rows(spark, tmp_path):
    def rows(*found):
        return spark.createDataFrame(found, "execution_id string, table string, n int")

    path, schema = str(tmp_path / "log"), rows(("1", "a", 1)).schema
    replace_log(rows(("001", "a", 1), ("001", "b", 2), ("2024", "a", 3), ("x/y=%z", "c", 4)), path)
    replace_log(rows(("001", "b", 5)), path)
    replace_log(rows(("001", "b", 5)), path)
    assert sorted(map(tuple, read_log(spark, path, schema).collect())) == [("001", "b", 5), ("2024", "a", 3), ("x/y=%z", "c", 4)]
    replace_log(rows(("1", "a", 1)).where("false"), path)
    assert read_log(spark, path, schema).count() == 3


# --- kept records ------------------------------------------------------------


def _log(tmp_path, run, *rows):
    path = tmp_path / "logs" / "d" / run / "offloadgp_stat_succeeded.s.csv"
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(["Greenplum_Tbl,Run_Status,End_Timestamp_Script,File_Path", *rows]) + "\n")
    return path


def test_successes_are_kept_between_runs(spark, tmp_path):
    root, folder = f"{tmp_path}/logs", f"{tmp_path}/kept"

    def run():
        found = refresh_success(spark, root, folder)
        whole = control.latest_success(read_success_log(spark, root))
        kept = sorted(map(tuple, found.latest.drop("order").collect()))
        assert kept == sorted(map(tuple, whole.collect()))
        return {r.table: r.file_path for r in found.latest.collect()}, sorted(r.path.split("/")[-2] for r in found.files.collect())

    first = _log(tmp_path, "r1", "a,SUCCEEDED,2024-01-02,/a1", "b,SUCCEEDED,2024-01-02,/b1", "s.c,SUCCEEDED,2024-01-09,/c1")
    assert run() == ({"a": "/a1", "b": "/b1", "c": "/c1"}, ["r1"])
    assert run() == ({"a": "/a1", "b": "/b1", "c": "/c1"}, [])
    _log(tmp_path, "r2", "a,SUCCEEDED,2024-01-01,/a2", "b,SUCCEEDED,2024-01-02,/b2", "c,SUCCEEDED,2024-01-01,/c2", "d,FAILED,2025-01-01,/d2")
    assert run() == ({"a": "/a1", "b": "/b2", "c": "/c2"}, ["r2"])
    # A log that grew is read again, the others are not.
    with first.open("a") as log:
        log.write("a,SUCCEEDED,2024-02-01,/a3\n")
    assert run() == ({"a": "/a3", "b": "/b2", "c": "/c2"}, ["r1"])
    # What a log that is gone had given goes as well.
    os.remove(first)
    assert run() == ({"a": "/a2", "b": "/b2", "c": "/c2"}, ["r2"])
    _log(tmp_path, "r2", "a,SUCCEEDED,2024-01-01,/a9")
    assert run() == ({"a": "/a9"}, ["r2"])


def test_lines_are_kept_between_runs(spark, tmp_path):
    root, folder = f"{tmp_path}/lines", f"{tmp_path}/kept"

    def write(date, *values):
        write_line_files(spark.createDataFrame([(v,) for v in values], "value string"), root, date)

    write("2024-01-01", "d|s|t|1|MIN(a):x\ny", "d|s|u|2|")
    assert refresh_lines(spark, root, folder).files.count() == 2
    write("2024-01-02", "d|s|t|3|")
    run = refresh_lines(spark, root, folder)
    assert run.files.count() == 1 and {r.table: r.row_count for r in run.latest.collect()} == {"t": 3, "u": 2}
    assert lines.decode_lines(lines.latest_lines(run.latest)).count() == 2
    assert refresh_lines(spark, root, folder).files.count() == 0


# --- casts -------------------------------------------------------------------

TEXTS = [
    "1", "-1.5", "+.5", "5.", " 7 ", "\t8\n", "1e3", "1E-2", "1e400", "9" * 40, "1." + "9" * 60, "", " ", ".", "-", "e5", "1e", "1 2", "n/a", "NaN", "-nan", "Infinity", "-inf", "+INF", "infinit",
    "1d", "1.5F", "0x1p3", "1,5", "１", "1_0", "--1", "0", "-0", "00012.50", None,
]


@pytest.mark.parametrize("cast", ["double", "decimal(18,2)", "decimal(38,4)"])
def test_guarded_casts_read_what_a_cast_reads(spark, cast):
    for text in TEXTS:
        rows = spark.createDataFrame([(text,)], "c string")
        plain = rows.selectExpr(f"cast(max(try_cast(c AS {cast})) AS string) AS v").first().v
        found = profile_table(rows, "d", "s", "t", [Metric("MAX", "c", cast)], of_copy=True).where("func = 'MAX'").first().value
        assert found == plain, repr(text)


def test_sums_of_text(spark):
    rows = spark.createDataFrame([(t,) for t in ("1", "2.5", "x", None, "")], "c string")
    assert {r.func: r.value for r in profile_table(rows, "d", "s", "t", sums("c") + extremes("c")).collect()} == {"COUNT": "5", "SUM": "3.5", "MIN": "", "MAX": "x"}


# --- numbers of any precision ------------------------------------------------


@pytest.mark.parametrize("seed", range(4))
def test_numbers_of_any_precision(spark, seed):
    import random
    from decimal import Decimal, localcontext

    draw = random.Random(seed)
    digits = lambda n: "".join(draw.choices("0123456789", k=n))
    texts = [f"{draw.choice(['', '-', '+'] if seed != 1 else ['-'])}{digits(draw.randint(0, 40))}.{digits(draw.randint(1, 60))}" for _ in range(60)]
    texts += ["9" * 72, "-" + "9" * 72 + "." + "9" * 72] if seed == 2 else ["1e3", "-1.5E-3", " 7 ", "00", "-0.0", "+.5", "5."]
    odd = [None, "", " ", ".", "-", "x", "1,5", "9" * 73, "1." + "1" * 73, "--1"]
    rows = spark.createDataFrame([(t,) for t in texts + odd], "c string").repartition(3)
    metrics = [Metric(f, "c", "numeric") for f in ("SUM", "MIN", "MAX")]
    found = {r.func: r.value for r in profile_table(rows, "d", "s", "t", metrics, of_copy=True).collect()}
    with localcontext() as context:
        context.prec = 400
        values = [Decimal(t.strip()) for t in texts]
        assert (Decimal(found["SUM"]), Decimal(found["MIN"]), Decimal(found["MAX"])) == (sum(values), min(values), max(values))
        assert not any(found[f].endswith((".", "0")) and "." in found[f] for f in found)
    nothing = {r.func: r.value for r in profile_table(rows.where("c = 'x'"), "d", "s", "t", metrics, of_copy=True).collect()}
    assert nothing == {"COUNT": "1", "SUM": None, "MIN": None, "MAX": None}


def test_sums_that_end_at_zero(spark):
    for texts, total in ((["1.5", "-1.5"], "0"), (["-0"], "0"), (["-0.001", "0.0009"], "-0.0001"), (["1" + "0" * 18, "-1"], "9" * 18), (["-1" + "0" * 36, "1"], "-" + "9" * 36)):
        rows = spark.createDataFrame([(t,) for t in texts], "c string")
        assert {r.func: r.value for r in profile_table(rows, "d", "s", "t", [Metric("SUM", "c", "numeric")], of_copy=True).collect()}["SUM"] == total


def test_unbounded_types(spark):
    from tallymark.functions import types

    kinds = ["numeric", "NUMERIC (50, 10)", "decimal(38,2)", "numeric(9)", "numeric[]", "bigint", "text"]
    found = spark.createDataFrame([(k,) for k in kinds], "t string").select(types.unbounded_cast_type(F.col("t"))).collect()
    assert [r[0] for r in found] == ["numeric", "numeric", "decimal(38,2)", "decimal(9)", "string", "long", "string"]


# --- extremes of texts in many groups ----------------------------------------


def test_many_groups(spark):
    import random

    from tallymark.operators.profile import profile

    draw = random.Random(3)
    pieces = ["", "a", "ab", "é", "日本", "\x00", "\x00\x00", "x" * 14, "x" * 15, "x" * 16, "x" * 15 + "a", "y" * 40, "y" * 40 + "z", "\U0001f600", "~", "ÿ" * 8]
    rows = [(draw.choice([None, "g", "h"]), draw.randrange(40), draw.choice([None, *pieces]) if draw.random() < 0.6 else "".join(draw.choices(["x", "y", "é", "\x00"], k=draw.randrange(40))), draw.random()) for _ in range(3000)]
    df = spark.createDataFrame(rows, "p string, q int, `t.x` string, v double").repartition(3)
    metrics = sums("v") + extremes("t.x", "v", "p")
    for of_copy in (False, True):
        plain = profile(df, metrics, by=["p", "q"], of_copy=of_copy)
        many = profile(df, metrics, by=["p", "q"], of_copy=of_copy, many_groups=True)
        assert sorted(map(str, many.where("col <> 'v'").collect())) == sorted(map(str, plain.where("col <> 'v'").collect()))
    assert profile(df.where("false"), metrics, by=["p"], many_groups=True).count() == 0


def test_many_groups_are_not_sorted(spark):
    from tallymark.operators.profile import profile

    df = spark.range(20000).selectExpr("id % 10000 AS g", "concat('text ', id) AS t", "concat('a long text that goes beyond its code ', id) AS u")
    found = profile(df, extremes("t"), by=["g"], many_groups=True)
    plan = found._jdf.queryExecution().executedPlan().toString()
    below = [line for line in plan.splitlines() if "SortAggregate" in line or "partial_min(t" in line]
    assert below == [] and "HashAggregate" in plan
    values = {(r.g, r.func): r.value for r in profile(df, extremes("t", "u"), by=["g"], many_groups=True).where("g = 7").collect() if r.col == "u"}
    assert values[7, "MIN"].endswith(" 10007") and values[7, "MAX"].endswith(" 7")


# --- digests -----------------------------------------------------------------


def test_a_failed_digest_keeps_the_last_one(spark, tmp_path):
    from tallymark.plans.content import export_content

    listed = control.listed_tables(control.parse_table_list(_control(spark, "d|s.t|a"), with_keys=True))
    mapped = spark.createDataFrame([("d", "s", "t", 1, "a", "int", "a", "string")], TYPE_MAP)
    special = control.special_columns(spark.createDataFrame([], "database_name string, original_table_name string, th_column_name string, active_flag string"))
    good = spark.range(3).selectExpr("id AS a")
    bad = good.selectExpr("raise_error('gone wrong') AS a")

    def run(df):
        return export_content(spark, listed, mapped, special, lambda *_: df, str(tmp_path), form="parquet").results.first()

    first, second = run(good), run(bad)
    assert (first.status, second.status) == ("SUCCESS", "FAILED") and first.path != second.path
    assert spark.read.parquet(first.path).count() == 3
