"""Profiles that the warehouse takes itself: one SQL statement per table, one row back.

`profile_statement` writes the metrics of a table as one aggregate, in the
warehouse's dialect or in Spark's (for a source that Spark reads by name). Rows
never leave the source; what comes back has one text per metric and is turned
into the same long form that `tallymark.operators.profile` gives.

Names are quoted. A warehouse keeps unquoted names in lower case, so plain names
are lowered before they are quoted, which finds what the unquoted name would have
found, and reserved words as well; any other name is taken as it is written.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from tallymark.operators.profile import COUNT, EVERY_ROW, FUNCTIONS, Metric, all_profiles
from tallymark.sources.tables import jdbc_source

# Fixed value: how many columns a select list may have in the warehouse, with room to spare.
MOST_COLUMNS = 1600
_PLAIN = re.compile(r"[A-Za-z_][A-Za-z0-9_$]*")


class Dialect(NamedTuple):
    """What differs between sources: the quote of names, the type of text, whether plain names are lowered."""

    quote: str
    text: str
    lowers: bool


WAREHOUSE = Dialect('"', "text", True)
SPARK = Dialect("`", "string", False)


def quoted(name: str, dialect: Dialect = WAREHOUSE) -> str:
    known = name.lower() if dialect.lowers and _PLAIN.fullmatch(name) else name
    return dialect.quote + known.replace(dialect.quote, dialect.quote * 2) + dialect.quote


def shown(metric: Metric, dialect: Dialect = WAREHOUSE) -> str:
    """SQL of one metric as text: a SUM of nothing is ``0``, an extreme of nothing the empty text."""
    if metric.func not in FUNCTIONS:
        raise ValueError(f"Function '{metric.func}' is not one of {', '.join(FUNCTIONS)}")
    value = f"{metric.func}({quoted(metric.col, dialect)})"
    if metric.func == "SUM":
        return f"CAST(COALESCE({value}, 0) AS {dialect.text})"
    return f"COALESCE(CAST({value} AS {dialect.text}), '')"


def profile_statements(
    relation: str, metrics: Sequence[Metric] = (), where: str | None = None, dialect: Dialect = WAREHOUSE
) -> list[str]:
    """The aggregate over a relation (its name, quoted): the row count and all metrics as columns ``metric_0``, ``metric_1``, ...

    One statement, unless there are more metrics than a select list may hold; the
    next ones go on with the numbers and leave the count out. A blank predicate or
    ``none`` keeps all rows; any other stands on lines of its own, so a comment at
    its end does no harm.
    """
    columns = [f"CAST(COUNT(*) AS {dialect.text}) AS metric_0"]
    columns += [f"{shown(metric, dialect)} AS metric_{i}" for i, metric in enumerate(metrics, 1)]
    kept = "" if where is None or where.strip().lower() in ("", "none") else f" WHERE (\n{where}\n)"
    return [
        f"SELECT {', '.join(columns[low : low + MOST_COLUMNS])} FROM {relation}{kept}"
        for low in range(0, len(columns), MOST_COLUMNS)
    ]


def _literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def as_profile(row: DataFrame, metrics: Sequence[Metric]) -> DataFrame:
    """The one row of a statement as profile rows: func, col, value, position."""
    named = [Metric(COUNT, EVERY_ROW), *metrics]
    places = [int(c.removeprefix("metric_")) for c in row.columns]
    rows = [
        f"struct('{named[i].func}' AS func, {_literal(named[i].col)} AS col, cast(metric_{i} AS string) AS value, {i} AS position)"
        for i in places
    ]
    return row.selectExpr(f"inline(array({', '.join(rows)}))")


def profile_at_source(
    run: Callable[[str], DataFrame],
    db: str,
    schema: str,
    table: str,
    metrics: Sequence[Metric] = (),
    where: str | None = None,
    relation: str | None = None,
    dialect: Dialect = WAREHOUSE,
) -> DataFrame:
    """The profile of one table, under its identity, as the source's own SQL gives it.

    ``run`` takes a statement and gives its one row, e.g. `jdbc_aggregates`.
    """
    relation = relation or f"{quoted(schema, dialect)}.{quoted(table, dialect)}"
    long = all_profiles([as_profile(run(sql), metrics) for sql in profile_statements(relation, metrics, where, dialect)])
    identity = [f"{_literal(value)} AS {name}" for name, value in (("db", db), ("schema", schema), ("table", table))]
    return long.selectExpr(*identity, "func", "col", "value", "position")


def jdbc_aggregates(
    spark: SparkSession, url: str, properties: Mapping[str, str] | None = None
) -> Callable[[str], DataFrame]:
    """Runs statements in a database over JDBC.

    Each is one task that waits for one row, so the tables of a batch run side by
    side, as many as there are cores. Spark asks the database for the columns of
    a statement with a condition that no row meets, which costs no scan.
    """
    return lambda statement: jdbc_source(spark, url, properties, query=statement)
