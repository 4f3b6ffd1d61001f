"""Decision rules as column expressions: matching, statuses, remarks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallymark.functions import text, types

# Numbers closer than this are equal.
TOLERANCE = 0.001
# Statuses.
COMPLETED, SUCCESS, WARNING, FAILED, SKIPPED = "COMPLETED", "SUCCESS", "WARNING", "FAILED", "SKIPPED"
# The note on a line whose table has no type map.
STATUS_TOKEN = "MIN_MAX_STATUS:"
TYPE_MAP_MISSING = "MIN_MAX_STATUS: DATA_TYPE_FILE_MISSING"
# Remarks.
REMARK_SUCCESS = "Success"
REMARK_COUNT = "Count Mismatch"
REMARK_DATA = "Data Mismatch"
REMARK_COMPARED = "Data Comparison"
REMARK_NO_CONFIG = "No Config"
REMARK_EXPORTED = "-"
REMARK_NO_TYPE_MAP = (
    "Count/Sum successful, unable to process min/max because the data type mapping file was not found."
)
REMARK_NOT_SUCCEEDED = "SKIPPED: Status is not SUCCEEDED in any log files"
# Texts in an error, in the order they are looked for, and the
# remark each gives.
FAILURE_CLASSES = [
    (["No such file or directory", "Local path not found"], "Source Parquet Not Found (Check Mount/Path)"),
    (["Spark Parquet Aggregation Failed"], "PySpark Aggregation Failed (Check Data/Schema)"),
    (["Greenplum result file not found"], "GP Result File Missing"),
    (["Failed to parse GP Result"], "Invalid GP Result Format"),
]
# Characters of an unknown error kept in the remark, and of any
# error in the log.
ERROR_IN_REMARK, ERROR_IN_LOG = 40, 200

_NUMBER = r"(?i)^\s*[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|inf|infinity|nan)\s*$"

_DIGITS = r"(?i)^\s*([+-]?)(?=\.?\d)(\d*)\.?(\d*)(?:e([+-]?\d+))?\s*$"


def as_number(value: Column) -> Column:
    """The text as a double; NULL when it is not a number."""
    return F.when(value.rlike(_NUMBER), value.try_cast("double"))


def exact_number(value: Column) -> Column:
    """A number's text in one form for each value, of any length; NULL when it is not a number.

    Sign, digits without zeros around them, and the power of ten of the last.
    """
    sign, whole, fraction, power = (F.regexp_extract(value, _DIGITS, i) for i in range(1, 5))
    significant = F.regexp_replace(F.concat(whole, fraction), "^0+", "")
    digits = F.regexp_replace(significant, "0+$", "")
    last = F.coalesce(power.try_cast("bigint"), F.lit(0)) - F.length(fraction) + F.length(significant) - F.length(digits)
    form = F.concat(F.when(sign == "-", "-").otherwise(""), digits, F.lit("e"), last.cast("string"))
    return F.when(value.rlike(_DIGITS), F.when(digits == "", "0").otherwise(form))


def is_compared_as_number(func: Column, source_type: Column, expected: Column, actual: Column) -> Column:
    """Numbers are compared as numbers only when both texts are there and read as one."""
    wanted = types.is_numeric_type(source_type) | (func == "SUM")
    return wanted & as_number(expected).isNotNull() & as_number(actual).isNotNull()


def metric_matches(func: Column, source_type: Column, expected: Column, actual: Column) -> Column:
    """Equal within the tolerance for numbers, equal as text for the rest.

    NaN and infinities never match, not even themselves.
    """
    distance = F.abs(as_number(expected) - as_number(actual))
    near = ~F.isnan(distance) & (distance < TOLERANCE)
    return F.when(is_compared_as_number(func, source_type, expected, actual), near).otherwise(expected == actual)


def metric_matches_exactly(func: Column, source_type: Column, expected: Column, actual: Column) -> Column:
    """Decimals must be equal to the last digit; no tolerance."""
    wanted = types.is_numeric_type(source_type) | (func == "SUM")
    left, right = exact_number(expected), exact_number(actual)
    return F.when(wanted & left.isNotNull() & right.isNotNull(), left == right).otherwise(expected == actual)


def shown_number(value: Column, scale: Column) -> Column:
    """A number with a fixed count of digits after the point."""
    number = as_number(value)
    return (
        F.when(F.isnan(number), F.lit("nan"))
        .when(number == float("inf"), F.lit("inf"))
        .when(number == float("-inf"), F.lit("-inf"))
        .otherwise(F.call_function("format_string", F.concat(F.lit("%."), scale.cast("string"), F.lit("f")), number))
    )


def reconcile_status(
    count_matches: Column, mismatches: Column, line_remark: Column, has_type_map: Column
) -> Column:
    """COMPLETED only if the count and every metric match.

    A completed table whose type map is missing is a WARNING.
    """
    unsure = F.contains(F.coalesce(line_remark, F.lit("")), F.lit("MISSING")) | ~has_type_map
    return F.when(~count_matches | (mismatches > 0), FAILED).when(unsure, WARNING).otherwise(COMPLETED)


def reconcile_remark(
    status: Column, count_matches: Column, mismatches: Column, total: Column, line_remark: Column
) -> Column:
    verdict = (
        F.when(status.isin(COMPLETED, WARNING), F.lit(REMARK_SUCCESS))
        .when(~count_matches, F.lit(REMARK_COUNT))
        .otherwise(
            F.concat(F.lit(REMARK_DATA + " ("), mismatches.cast("string"), F.lit("/"), total.cast("string"), F.lit(")"))
        )
    )
    return F.concat_ws(" | ", verdict, F.when(line_remark != "", line_remark))


def failure_remark(error: Column) -> Column:
    """A readable reason for an error text; the first class that fits wins."""
    remark = None
    for needles, reason in FAILURE_CLASSES:
        hit = F.lit(False)
        for needle in needles:
            hit = hit | F.contains(error, F.lit(needle))
        remark = F.when(hit, reason) if remark is None else remark.when(hit, reason)
    return remark.otherwise(F.concat(F.lit("Error: "), text.shortened(error, ERROR_IN_REMARK)))


def failure_log_remark(error: Column) -> Column:
    """The reason and the start of the error itself, as logged."""
    start = F.substring(text.on_one_line(error), 1, ERROR_IN_LOG)
    return text.without_quotes(F.concat_ws(" | ", failure_remark(error), start))


def export_status(has_config: Column, has_type_map: Column, error: Column) -> Column:
    return (
        F.when(~has_config, SKIPPED)
        .when(error.isNotNull(), FAILED)
        .when(~has_type_map, WARNING)
        .otherwise(SUCCESS)
    )


def export_remark(has_config: Column, has_type_map: Column, error: Column) -> Column:
    return (
        F.when(~has_config, F.lit(REMARK_NO_CONFIG))
        .when(error.isNotNull(), text.on_one_line(error))
        .when(~has_type_map, F.lit(REMARK_NO_TYPE_MAP))
        .otherwise(REMARK_EXPORTED)
    )
