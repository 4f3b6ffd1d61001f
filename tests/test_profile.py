"""Profiles and lines: values, plans, round trips."""

from decimal import Decimal
from random import Random

import pytest
from pyspark.sql import functions as F

from tallymark.operators import lines
from tallymark.operators.content import content_rows, key_columns
from tallymark.operators.profile import Metric, extremes, filtered, profile, profile_family, profile_table, sums

SF = "/root/testdata/sf0.001"


def _values(df):
    return {(r.func, r.col): r.value for r in df.collect()}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_nothing_to_aggregate(spark):
    empty = spark.createDataFrame([], "a decimal(18,2), b string")
    metrics = sums("a") + extremes("b")
    assert _values(profile(empty, metrics)) == {("COUNT", "*"): "0", ("SUM", "a"): "0", ("MIN", "b"): "", ("MAX", "b"): ""}
    copied = _values(profile(empty, metrics, of_copy=True))
    assert copied == {("COUNT", "*"): "0", ("SUM", "a"): None, ("MIN", "b"): None, ("MAX", "b"): None}
    nulls = spark.createDataFrame([(None, None)], "a decimal(18,2), b string")
    assert _values(profile(nulls, metrics)) == {("COUNT", "*"): "1", ("SUM", "a"): "0", ("MIN", "b"): "", ("MAX", "b"): ""}
    assert _values(profile(empty)) == {("COUNT", "*"): "0"}


def test_large_sums_do_not_overflow(spark):
    big = spark.createDataFrame([(2**63 - 1, Decimal(10) ** 33)] * 3, "a bigint, b decimal(38,4)")
    assert _values(profile(big, sums("a")))["SUM", "a"] == str(3 * (2**63 - 1))
    huge = big.select((F.col("b") * 0 + F.expr("cast('9999999999999999999999999999999999.0' as decimal(38,4))")).cast("decimal(38,4)").alias("b"))
    assert _values(profile(huge, sums("b"), of_copy=True))["SUM", "b"] is None


def test_reading_a_text_copy(spark):
    texts = ["12", "12.7", " -3. ", "+4", "x", "", None, "99999999999999999999", "1e3"]
    copy = spark.createDataFrame([(t,) for t in texts], "c string")
    assert _values(profile(copy, [Metric("SUM", "c", "long")], of_copy=True))["SUM", "c"] == "25"
    for metric, value in [
        (Metric("MAX", "c", "decimal(10,2)"), "1000.00"), (Metric("MIN", "c", "string"), ""), (Metric("MAX", "c", "date"), None),
    ]:
        assert _values(profile(copy, [metric], of_copy=True))[metric.func, "c"] == value
    times = spark.createDataFrame([("2024-01-01 10:00:00.25",), ("bad",)], "c string")
    assert _values(profile(times, [Metric("MIN", "c", "timestamp")], of_copy=True))["MIN", "c"] == "2024-01-01 10:00:00"
    exact = profile(times, [Metric("MIN", "c", "timestamp")], of_copy=True, whole_seconds=False)
    assert _values(exact)["MIN", "c"] == "2024-01-01 10:00:00.25"
    words = spark.createDataFrame([("1.5",), ("n/a",)], "c string")
    assert _values(profile(words, [Metric("SUM", "c", "string")], of_copy=True))["SUM", "c"] == "1.5"


def test_only_known_columns_and_types(spark):
    df = spark.range(1)
    for metric in (Metric("SUM", "id + 1"), Metric("AVG", "id"), Metric("SUM", "nope"), Metric("SUM", "id", "decimal(point)")):
        with pytest.raises(ValueError):
            profile(df, [metric])


def test_odd_column_names(spark):
    df = spark.createDataFrame([(1, "x")], "`a.b` int, `it's` string")
    assert _values(profile(df, sums("a.b") + extremes("it's"))) == {
        ("COUNT", "*"): "1", ("SUM", "a.b"): "1", ("MIN", "it's"): "x", ("MAX", "it's"): "x"
    }


def test_predicate(spark):
    df = spark.range(10)
    assert filtered(df, " NONE ").count() == filtered(df, None).count() == filtered(df, " ").count() == 10
    assert filtered(df, "id > 6").count() == 3


def test_collation(spark):
    df = spark.createDataFrame([("a",), ("B",)], "t string")
    assert _values(profile(df, extremes("t")))["MIN", "t"] == "B"
    assert _values(profile(df, extremes("t"), collation="UNICODE"))["MIN", "t"] == "a"


def test_one_scan_reads_only_what_it_needs(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    plan = _plan(profile(filtered(orders, "o_orderkey > 5"), sums("o_custkey") + extremes("o_orderstatus")))
    assert plan.count("FileScan") == 1
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string>" in plan
    assert "GreaterThan(o_orderkey,5)" in plan


def test_wide_tables_take_passes_of_their_own_columns(spark):
    df = spark.read.parquet(f"{SF}/lineitem.parquet")
    metrics = sums(*[c for c, kind in df.dtypes if kind in ("bigint", "int")]) + extremes(*df.columns)
    one = profile(df, metrics, columns_per_pass=None)
    some = profile(df, metrics, columns_per_pass=4)
    assert (_plan(one).count("FileScan"), _plan(some).count("FileScan")) == (1, 3)
    assert sorted(one.collect()) == sorted(some.collect())
    by = ["l_returnflag"]
    assert sorted(profile(df, metrics, by=by, columns_per_pass=2).collect()) == sorted(profile(df, metrics, by=by).collect())


def test_family_equals_its_tables(spark):
    df = spark.read.parquet(f"{SF}/lineitem.parquet").withColumn("table", F.col("l_returnflag"))
    metrics = sums("l_orderkey") + extremes("l_shipdate", "l_linestatus")
    family = profile_family(df, "d", "s", metrics)
    assert _plan(family).count("Exchange hashpartitioning") == 1
    singly = [profile_table(df.where(F.col("table") == f), "d", "s", f, metrics) for f in "ANR"]
    assert sorted(family.collect()) == sorted(r for one in singly for r in one.collect())


def test_content_is_a_projection(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    plan = _plan(content_rows(df, "doc_id", df.columns, ["text"]))
    assert "Exchange" not in plan and "Python" not in plan and "*(1) Project" in plan


def test_keys():
    assert key_columns("all", ["a", "b"]) == ["a", "b"]
    assert key_columns(" A, b,", ["a", "b"]) == ["A", "b"]
    with pytest.raises(ValueError, match="Key column 'c' not found in table 's.t'"):
        key_columns("a,c", ["a", "b"], "s.t")


def test_lines_round_trip(spark):
    """Many generated tables in one job; values hold commas, colons and halves of metrics."""
    random = Random(7)
    pieces = ["x", ",", ":", "MIN(", ")", "SUM", "10:00", " ", "é", "(", "{}", "'", '"', ""]
    names = [(f, c) for f in ("SUM", "MIN", "MAX") for c in ("a", "b", "c_d")]
    rows = []
    for i in range(300):
        rows.append(("d", "s", f"t{i}", "COUNT", "*", str(i), 0))
        for position, (func, col) in enumerate(random.sample(names, random.randrange(len(names))), 1):
            value = "".join(random.choices(pieces, k=random.randrange(6))).strip()
            rows.append(("d", "s", f"t{i}", func, col, value, position))
    profiles = spark.createDataFrame(rows, "db string, schema string, table string, func string, col string, value string, position int")
    encoded = lines.encode_lines(profiles).select("value")
    assert sorted(map(tuple, lines.decode_lines(lines.parse_lines(encoded)).collect())) == sorted(rows)


def test_line_notes(spark):
    texts = ["d|s|t|3|SUM(a):6,MIN_MAX_STATUS: DATA_TYPE_FILE_MISSING\n", "d|s|u|0|", "d|s", "d|s|v|abc|", "d|s|w|1|sum(a):1,SUM(a):2"]
    parsed = lines.parse_lines(spark.createDataFrame([(t,) for t in texts], "value string"))
    assert parsed.where("reason IS NOT NULL").count() == 2
    found = {(r.table, r.func, r.col): r.value for r in lines.decode_lines(parsed).collect()}
    assert found == {
        ("t", "COUNT", "*"): "3", ("t", "SUM", "a"): "6", ("t", "MIN_MAX_STATUS", ""): "DATA_TYPE_FILE_MISSING",
        ("u", "COUNT", "*"): "0", ("w", "COUNT", "*"): "1", ("w", "SUM", "a"): "2",
    }


@pytest.mark.parametrize("collation", [None, "UNICODE"])
def test_a_family_with_text_extremes_sorts_no_rows(spark, collation):
    rows = [("p1", "bé", 1), ("p1", "a", 2), ("p2", None, 3), ("p2", "", None), ("p3", None, None)] * 50
    df = spark.createDataFrame(rows, "table string, name string, n int")
    family = profile_family(df, "d", "s", sums("n") + extremes("name", "n"), collation=collation)
    plan = family._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" in plan and "Sort" not in plan
    got = {(r.table, r.func, r.col): r.value for r in family.collect()}
    assert got["p1", "MIN", "name"] == "a" and got["p1", "MAX", "name"] == "bé" and got["p1", "SUM", "n"] == "150"
    assert got["p2", "MIN", "name"] == "" and got["p3", "MAX", "name"] == "" and got["p3", "SUM", "n"] == "0"
    assert got["p1", "COUNT", "*"] == "100" and got["p3", "COUNT", "*"] == "50"


def test_more_groups_than_the_hash_map_of_objects_holds(spark):
    df = spark.range(2000).selectExpr("concat('p', id % 500) AS table", "cast(id AS string) AS name")
    got = profile_family(df, "d", "s", extremes("name")).where("func = 'MAX'").collect()
    want = {f"p{k}": max(str(i) for i in range(k, 2000, 500)) for k in range(500)}
    assert {r.table: r.value for r in got} == want
