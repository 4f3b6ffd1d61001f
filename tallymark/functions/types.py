"""Rules over source type names, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallymark.functions.text import strip

# Words in a source type that rule MIN and MAX out.
NOT_ORDERED = [
    "json", "xml",
    "geometry", "geography", "box", "point", "line", "lseg", "path", "polygon", "circle",
]
# Words in a source type that allow MIN and MAX.
ORDERED = [
    "character varying", "varchar", "char", "text", "string",
    "date", "time", "timestamp",
    "int", "integer", "bigint", "smallint",
    "numeric", "decimal", "float", "real", "double precision",
]
# Words in a type of the copy that mean text.
TEXT_LIKE = ["text", "character varying", "varchar", "string", "char"]

# Fixed value: the type of a number declared without precision.
PLAIN_NUMBER = "decimal(38,4)"
# The same without rounding: as many digits after the point as sums leave room for.
EXACT_PLAIN_NUMBER = "decimal(38,18)"
# Fixed value: the type assumed for a column the type map does not name.
UNMAPPED = "string"


def type_name(declared: Column) -> Column:
    """``Numeric(18,2)`` -> ``numeric``."""
    return F.lower(strip(F.substring_index(declared, "(", 1)))


def type_length(declared: Column) -> Column:
    """``numeric(18,2)`` -> ``(18,2)``; empty without a length."""
    return F.regexp_extract(declared, r"\(.*?\)", 0)


def _holds_any(text: Column, words: list[str]) -> Column:
    return text.rlike("|".join(words))


def is_min_max_candidate(source_type: Column, copy_type: Column) -> Column:
    """Whether MIN and MAX are taken: an ordered source type held as text."""
    source = type_name(F.coalesce(source_type, F.lit("")))
    copy = type_name(F.coalesce(copy_type, F.lit("")))
    return ~_holds_any(source, NOT_ORDERED) & _holds_any(source, ORDERED) & _holds_any(copy, TEXT_LIKE)


def spark_type(source_type: Column) -> Column:
    """The Spark type that the copy's text is cast to before aggregating.

    The tests look for parts of words and their order matters: ``interval``
    holds ``int`` and becomes ``long``.
    """
    declared = F.lower(strip(source_type))
    length = type_length(declared)

    def has(*words: str) -> Column:
        return _holds_any(declared, list(words))

    return (
        F.when(has("num", "dec"), F.when(length != "", F.concat(F.lit("decimal"), length)).otherwise(PLAIN_NUMBER))
        .when(has("char", "text"), "string")
        .when(has("int"), "long")
        .when(has("date"), "date")
        .when(has("time"), "timestamp")
        .otherwise("string")
    )


def exact_spark_type(source_type: Column) -> Column:
    """`spark_type` that reads whole type names instead of parts of words.

    Differs for floating types (``double``), ``interval``, ``point`` and
    arrays (all text).
    """
    declared = F.lower(strip(source_type))
    bare = type_name(declared)
    return (
        F.when(declared.endswith("[]"), "string")
        .when(
            bare.isin("numeric", "decimal"),
            F.when(type_length(declared) != "", F.concat(F.lit("decimal"), type_length(declared))).otherwise(PLAIN_NUMBER),
        )
        .when(bare.isin("int", "integer", "bigint", "smallint", "int2", "int4", "int8"), "long")
        .when(bare.isin("float", "real", "double precision", "float4", "float8"), "double")
        .when(bare == "date", "date")
        .when(bare.startswith("timestamp"), "timestamp")
        .otherwise("string")
    )


def exact_cast_type(source_type: Column) -> Column:
    """`exact_spark_type` for values that are compared to the last digit: a number without a scale is not rounded to four."""
    plain = type_name(strip(source_type)).isin("numeric", "decimal") & (type_length(source_type) == "")
    return F.when(plain, EXACT_PLAIN_NUMBER).otherwise(exact_spark_type(source_type))


def unbounded_cast_type(source_type: Column) -> Column:
    """`exact_cast_type`, where numbers without a precision, or with more digits than a decimal has, are read whole (``numeric``)."""
    is_number = type_name(strip(source_type)).isin("numeric", "decimal")
    precision = F.regexp_extract(source_type, r"\(\s*(\d+)", 1).try_cast("int")
    return F.when(is_number & F.coalesce(precision > 38, F.lit(True)), "numeric").otherwise(exact_cast_type(source_type))


def number_scale(source_type: Column) -> Column:
    """Digits after the point when a compared number is shown."""
    declared = F.coalesce(source_type, F.lit(""))
    second = strip(F.replace(F.get(F.split(declared, ","), F.lit(1)), F.lit(")"), F.lit("")))
    is_number = _holds_any(declared, ["num", "dec"]) & F.contains(declared, F.lit(","))
    return (
        F.when(is_number, F.coalesce(second.try_cast("int"), F.lit(4)))
        .when(_holds_any(declared, ["int"]), 0)
        .otherwise(4)
    )


def is_numeric_type(source_type: Column) -> Column:
    return _holds_any(F.coalesce(source_type, F.lit("")), ["num", "dec", "int"])
