"""Truth tables of the rules."""

import pytest
from pyspark.sql import functions as F

from checks.oracle import TYPES
from tallymark.functions import rules, text, types


def _one(spark, **columns):
    row = spark.range(1).select(*[F.lit(v).cast("string").alias(k) for k, v in columns.items()])
    return lambda column: row.select(column.alias("x")).first().x


def test_types(spark):
    rows = spark.createDataFrame([(t[0],) for t in TYPES], "declared string")
    declared = F.col("declared")
    found = rows.select(
        declared,
        types.is_min_max_candidate(declared, F.lit("varchar")).cast("int"),
        types.spark_type(declared),
        types.exact_spark_type(declared),
        types.type_length(declared),
        types.number_scale(F.lower(declared)),
    ).collect()
    assert [tuple(r) for r in found] == TYPES


@pytest.mark.parametrize("copy_type, allowed", [("text", True), ("CHAR(3)", True), ("decimal(18,2)", False), ("", False), (None, False)])
def test_extremes_need_text_in_the_copy(spark, copy_type, allowed):
    ask = _one(spark, source="numeric(18,2)", copy=copy_type)
    assert ask(types.is_min_max_candidate(F.col("source"), F.col("copy"))) is allowed


COMPARED = [
    # func, source type, expected, actual, within tolerance, exactly
    ("MAX", "string", "", "", True, True),
    ("MAX", "numeric(18,2)", "", "", True, True),
    ("SUM", "numeric(18,2)", "0", "", False, False),
    ("MIN", "bigint", "5", "", False, False),
    ("SUM", "string", "1.0000", "1.0009", True, False),
    ("MAX", "numeric", "1.0", "1.002", False, False),
    ("MAX", "numeric", "1.10", "1.1", True, True),
    ("MAX", "string", "1.10", "1.1", False, False),
    ("MAX", "numeric", "NaN", "NaN", False, True),
    ("MAX", "numeric", "inf", "inf", False, True),
    ("MAX", "numeric", "n/a", "n/a", True, True),
    ("MAX", "numeric", "n/a", "1", False, False),
    ("MAX", "numeric", "1d", "1", False, False),
    ("MAX", "numeric", "1e3", "1000", True, True),
    ("SUM", "numeric(38,2)", "90071992547409930.01", "90071992547409930.02", True, False),
    ("MAX", "timestamp", "2024-01-01 00:00:00.5", "2024-01-01 00:00:00", False, False),
]


@pytest.mark.parametrize("func, kind, expected, actual, near, exact", COMPARED)
def test_compare(spark, func, kind, expected, actual, near, exact):
    ask = _one(spark, f=func, k=kind, e=expected, a=actual)
    columns = F.col("f"), F.col("k"), F.col("e"), F.col("a")
    assert ask(rules.metric_matches(*columns)) is near
    assert ask(rules.metric_matches_exactly(*columns)) is exact


@pytest.mark.parametrize("value, scale, shown", [("1.005e2", 2, "100.50"), ("12", 0, "12"), ("-0.12345", 4, "-0.1235"), ("NaN", 2, "nan"), ("-inf", 2, "-inf")])
def test_shown_number(spark, value, scale, shown):
    ask = _one(spark, v=value)
    assert ask(rules.shown_number(F.col("v"), F.lit(scale))) == shown


@pytest.mark.parametrize("count, wrong, note, mapped, status, remark", [
    (True, 0, "", True, "COMPLETED", "Success"),
    (True, 0, "", False, "WARNING", "Success"),
    (True, 0, rules.TYPE_MAP_MISSING, True, "WARNING", "Success | MIN_MAX_STATUS: DATA_TYPE_FILE_MISSING"),
    (False, 0, "", True, "FAILED", "Count Mismatch"),
    (False, 2, "", False, "FAILED", "Count Mismatch"),
    (True, 2, "", False, "FAILED", "Data Mismatch (2/5)"),
    (True, 1, rules.TYPE_MAP_MISSING, True, "FAILED", "Data Mismatch (1/5) | MIN_MAX_STATUS: DATA_TYPE_FILE_MISSING"),
])
def test_status(spark, count, wrong, note, mapped, status, remark):
    got = spark.range(1).select(
        rules.reconcile_status(F.lit(count), F.lit(wrong), F.lit(note), F.lit(mapped)).alias("status"),
        rules.reconcile_remark(F.lit(status), F.lit(count), F.lit(wrong), F.lit(5), F.lit(note)).alias("remark"),
    ).first()
    assert tuple(got) == (status, remark)


@pytest.mark.parametrize("error, remark", [
    ("java.io: No such file or directory: /x", "Source Parquet Not Found (Check Mount/Path)"),
    ("Spark Parquet Aggregation Failed: No such file or directory", "Source Parquet Not Found (Check Mount/Path)"),
    ("Spark Parquet Aggregation Failed: bad", "PySpark Aggregation Failed (Check Data/Schema)"),
    ("Failed to parse GP Result: x", "Invalid GP Result Format"),
    ("x" * 40, "Error: " + "x" * 40),
    ("x" * 41, "Error: " + "x" * 40 + "..."),
])
def test_failure(spark, error, remark):
    assert _one(spark, e=error)(rules.failure_remark(F.col("e"))) == remark


def test_windows_874(spark):
    for value in ("plain | ~|~", "ก ข ๛", "€…", "naïve", "漢字🙂"):
        want = "".join(
            bytes([b]).decode("cp874", errors="replace") for b in value.encode()
        )
        assert _one(spark, v=value)(text.reread_as_windows_874(F.col("v"))) == want


def test_names(spark):
    ask = _one(spark, t="a_b_1_prt_p202512", u="plain", q="s.t")
    assert ask(text.base_table(F.col("t"))) == "a_b" and ask(text.partition_suffix(F.col("t"))) == "p202512"
    assert ask(text.base_table(F.col("u"))) == "plain" and ask(text.partition_suffix(F.col("u"))) is None
    assert ask(text.last_name_part(F.col("q"))) == "t" and ask(text.last_name_part(F.col("u"))) == "plain"
    assert ask(text.rewrite_path(F.lit("/a/b"), "/a", None)) == "/a/b"
    assert ask(text.rewrite_path(F.lit("/a/b/a"), "/a", "/c")) == "/c/b/c"


def test_exact_row_text_does_not_collide(spark):
    rows = spark.createDataFrame([("a~|~b", "c"), ("a", "b~|~c"), (None, "x"), ("", "x")], "p string, q string")
    columns = [F.col("p"), F.col("q")]
    assert rows.select(text.row_text(columns)).distinct().count() == 2
    assert rows.select(text.exact_row_text(columns)).distinct().count() == 4
