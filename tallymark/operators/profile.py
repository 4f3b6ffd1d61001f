"""Profiles: the row count and SUM, MIN, MAX of columns, in long form.

A profile has the columns ``func, col, value, position`` (after any grouping
columns), all values as text. The row count is the row ``COUNT`` of ``*``.

A profile is one aggregate over one scan, and partial aggregation leaves one
row per task and group to shuffle. That holds at any width, so all metrics of a
table come from one moment and one read of its rows. A caller whose source is a
columnar file that does not change may ask for passes over some columns each.

Grouped extremes of text do not fit Spark's fixed-width hash maps, and would
make it sort every input row. They are kept in its hash map of objects instead,
which sorts only in a task with more groups than
``spark.sql.objectHashAggregate.sortBased.fallbackThreshold`` (128).

Expressions are written as SQL text, since building hundreds of metrics from
Column calls takes the driver longer than running them.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

COUNT, EVERY_ROW = "COUNT", "*"
# An aggregate that gathers nothing, but whose kind makes Spark aggregate in a hash map of objects.
_IN_OBJECTS = "collect_list(cast(NULL AS boolean)) AS in_objects"
FUNCTIONS = ("SUM", "MIN", "MAX")

_CAST = re.compile(r"numeric|string|long|date|timestamp|double|decimal\(\s*\d+\s*(,\s*\d+\s*)?\)")
# Texts that a cast can read, blanks around them included. Any other costs the
# cast an exception for each row, which this test spares.
_PLAIN = r"[+-]?+(?:\d++\.?+\d*+|\.\d++)(?:[eE][+-]?+\d++)?+"
# A decimal may be written in the digits of any script, a double may not.
_ANY_DIGITS = _PLAIN.replace(r"\d", r"\p{Nd}")
_DECIMAL = rf"^[\x00-\x20]*+{_ANY_DIGITS}[\x00-\x20]*+$"
_DOUBLE = rf"(?i)^[\x00-\x20]*+(?:{_PLAIN}[df]?+|[+-]?+(?:inf(?:inity)?+|nan)|[+-]?+0x[\da-fp.+-]++[df]?+)[\x00-\x20]*+$"
_WHOLE_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_TIMES = (T.TimestampType, T.TimestampNTZType)


class Metric(NamedTuple):
    """One metric; ``cast`` is the Spark type a copy's text is read as."""

    func: str
    col: str
    cast: str | None = None


def sums(*columns: str) -> list[Metric]:
    return [Metric("SUM", c) for c in columns]


def extremes(*columns: str) -> list[Metric]:
    return [Metric(f, c) for f in ("MIN", "MAX") for c in columns]


def filtered(df: DataFrame, predicate: str | None) -> DataFrame:
    """The rows a configured predicate keeps; blank or ``none`` keeps all."""
    if predicate is None or predicate.strip().lower() in ("", "none"):
        return df
    return df.where(F.expr(predicate))


def _quoted(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def _literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


# Numbers of any precision are read as texts that order like the numbers: a sign,
# then their digits before and after the point, complemented below zero. Sums add
# such numbers up in limbs.
WHOLE_DIGITS = FRACTION_DIGITS = 72
_LIMB = 18
_ANY_NUMBER = rf"^[\x00-\x20]*+([+-]?)0*+(\d{{0,{WHOLE_DIGITS}}}+)(?:\.(\d{{0,{FRACTION_DIGITS}}}?)0*)?[\x00-\x20]*$"
_UP, _DOWN = "0123456789", "9876543210"


def _number_key(value: str) -> str:
    """SQL of the text that orders like the number a text holds; NULL if it holds none."""
    plain = f"CASE WHEN rlike({value}, '[eE]') THEN cast(try_cast({value} AS decimal(38,18)) AS string) ELSE {value} END"

    def part(group: int) -> str:
        return f"regexp_extract(n, r'{_ANY_NUMBER}', {group})"

    digits = f"concat(lpad({part(2)}, {WHOLE_DIGITS}, '0'), rpad({part(3)}, {FRACTION_DIGITS}, '0'))"
    below = f"{part(1)} = '-' AND rlike({digits}, '[1-9]')"
    key = f"IF({below}, concat('0', translate({digits}, '{_UP}', '{_DOWN}')), concat('1', {digits}))"
    return rf"transform(array({plain}), n -> CASE WHEN rlike(n, r'{_ANY_NUMBER}') AND rlike(n, r'\d') THEN {key} END)[0]"


def _digits_shown(digits: str) -> str:
    """SQL of a number's text from its digits, without needless zeros."""
    whole = f"regexp_replace(substring({digits}, 1, length({digits}) - {FRACTION_DIGITS}), '^0+(?=.)', '')"
    fraction = f"trim(TRAILING '0' FROM right({digits}, {FRACTION_DIGITS}))"
    return f"concat({whole}, IF({fraction} = '', '', concat('.', {fraction})))"


def _key_shown(key: str) -> str:
    """SQL of the number's text from its ordering text."""
    rest = f"substring({key}, 2)"
    return f"IF(startswith({key}, '0'), concat('-', {_digits_shown(f"translate({rest}, '{_DOWN}', '{_UP}')")}), {_digits_shown(rest)})"


def _sum_of_keys(key: str) -> str:
    """SQL of the exact sum of numbers given by their ordering texts, as text; NULL if there are none.

    Limbs of 18 digits are summed apart, as decimals that 10^20 rows do not
    overflow, and carried over in the one row that is left. Below zero the sum is
    that of the negated limbs.
    """
    base = "cast(1e18 AS decimal(19,0))"
    below = f"startswith({key}, '0')"
    digits = f"IF({below}, translate(substring({key}, 2), '{_DOWN}', '{_UP}'), substring({key}, 2))"
    limbs = [
        f"sum(cast(cast(substring({digits}, {at}, {_LIMB}) AS bigint) * IF({below}, -1, 1) AS decimal(28,0)))"
        for at in range(1, WHOLE_DIGITS + FRACTION_DIGITS, _LIMB)
    ]
    carried = (
        "aggregate(reverse({}), named_struct('carry', cast(0 AS decimal(38,0)), 'digits', ''), (t, x) -> named_struct("
        f"'carry', cast((x + t.carry - pmod(x + t.carry, {base})) div {base} AS decimal(38,0)), "
        f"'digits', concat(lpad(cast(pmod(x + t.carry, {base}) AS string), {_LIMB}, '0'), t.digits)))"
    )
    above = _digits_shown("concat(IF(t.carry > 0, cast(t.carry AS string), ''), t.digits)")
    negated = f"transform(array({carried.format('transform(l, y -> cast(-y AS decimal(38,0)))')}), t -> {above})[0]"
    shown = f"transform(array({carried.format('l')}), t -> IF(t.carry < 0, concat('-', {negated}), {above}))[0]"
    return f"IF(count({key}) = 0, NULL, transform(array(array({', '.join(limbs)})), l -> {shown})[0])"


def read_as(value: str, source: T.DataType, cast: str) -> str:
    """SQL that reads a copy's value as a type; what cannot be read becomes NULL, never an error.

    Text read as ``long`` loses its fraction, like a plain numeric cast. A ``numeric``
    has any number of digits, up to 72 before and after the point.
    """
    if not _CAST.fullmatch(cast):
        raise ValueError(f"Type '{cast}' is not one a copy is read as")
    if cast == "long" and isinstance(source, T.StringType):
        # A text that is no number is told apart before the cast, which would
        # throw and catch an exception for each.
        value = rf"nullif(regexp_extract({value}, r'^\s*([+-]?\d+)(?:\.\d*)?\s*$', 1), '')"
    elif cast == "numeric":
        return _number_key(f"cast({value} AS string)")
    elif isinstance(source, T.StringType) and cast == "double":
        value = f"CASE WHEN rlike({value}, r'{_DOUBLE}') THEN {value} END"
    elif isinstance(source, T.StringType) and cast.startswith("decimal"):
        value = f"CASE WHEN rlike({value}, r'{_DECIMAL}') THEN {value} END"
    return f"try_cast({value} AS {cast})"


def _shown(metric: Metric, value: str, kind: T.DataType, of_copy: bool, whole_seconds: bool) -> str:
    """SQL that aggregates an input column and shows the result as text."""
    if metric.cast == "numeric":
        shown = _sum_of_keys(value) if metric.func == "SUM" else _key_shown(f"{metric.func}({value})")
        nothing = "'0'" if metric.func == "SUM" else "''"
    elif metric.func == "SUM":
        if isinstance(kind, _WHOLE_NUMBERS):
            # Twenty digits hold any bigint, so the sum gets thirty: no overflow.
            value = f"cast({value} AS decimal(20,0))"
        elif isinstance(kind, T.StringType):
            value = read_as(value, kind, "double")
        shown, nothing = f"cast(try_sum({value}) AS string)", "'0'"
    else:
        extreme = f"{metric.func}({value})"
        in_seconds = whole_seconds and isinstance(kind, _TIMES)
        shown = f"date_format({extreme}, 'yyyy-MM-dd HH:mm:ss')" if in_seconds else f"cast({extreme} AS string)"
        nothing = "''"
    return shown if of_copy else f"coalesce({shown}, {nothing})"


# How many bytes of a text its code holds; with them goes the text's length, or one more if it is longer.
CODED = 15


def _code(column: str) -> str:
    """SQL of a fixed-width number that orders like a text's first bytes, and among equal ones like its length up to there."""
    digits = f"rpad(hex(substring(cast({column} AS binary), 1, {CODED})), {2 * CODED}, '0')"
    half = [f"cast(conv(substring({digits}, {at}, {CODED}), 16, 10) AS decimal(19,0))" for at in (1, 1 + CODED)]
    length = f"cast(least(octet_length({column}), {CODED + 1}) AS decimal(2,0))"
    return f"cast(({half[0]} * cast({2**60} AS decimal(19,0)) + {half[1]}) * cast(32 AS decimal(2,0)) + {length} AS decimal(38,0))"


def _decoded(code: str) -> str:
    """SQL of the text of a code that holds all of it."""
    low = f"pmod({code}, cast({2**65} AS decimal(38,0)))"
    digits = f"concat(lpad(hex({code} div cast({2**65} AS decimal(38,0))), {CODED}, '0'), lpad(hex({low} div cast(32 AS decimal(38,0))), {CODED}, '0'))"
    return f"cast(substring(unhex({digits}), 1, cast(pmod({code}, cast(32 AS decimal(38,0))) AS int)) AS string)"


def _two_looks(base: DataFrame, by: Sequence[str], aggregates: list[str], looked_up: dict[int, tuple[str, str]], of_copy: bool) -> DataFrame:
    """Groups with their aggregates, and extremes of texts whatever the number of groups.

    The first look takes extremes of codes, which are of fixed width, so its hash
    maps spill and never sort the rows. A text of up to 15 bytes is its code. For
    the others a second look reads the rows again, but only those whose code is
    that of the extreme reach its aggregate.
    """
    codes = {column: f"code_of_{column}" for _, column in looked_up.values()}
    coded = base.selectExpr("*", *[f"{_code(column)} AS {name}" for column, name in codes.items()])
    extremes_of_codes = [f"{func}({codes[column]}) AS code_{position}" for position, (func, column) in looked_up.items()]
    first = coded.groupBy(*by).agg(*[F.expr(a) for a in [*aggregates, *extremes_of_codes]])

    def too_long(position: int) -> str:
        return f"coalesce(pmod(code_{position}, cast(32 AS decimal(38,0))) > {CODED}, false)"

    places = [f"group_{i}" for i, _ in enumerate(by)]
    open_codes = [f"CASE WHEN {too_long(p)} THEN code_{p} END AS open_{p}" for p in looked_up]
    left = first.selectExpr(*[f"{_quoted(c)} AS {place}" for c, place in zip(by, places)], *open_codes)
    left = left.where(" OR ".join(f"open_{p} IS NOT NULL" for p in looked_up))
    same = " AND ".join(f"{_quoted(c)} <=> {place}" for c, place in zip(by, places))
    ties = " OR ".join(f"{codes[column]} = open_{p}" for p, (_, column) in looked_up.items())
    tied = coded.join(left, F.expr(f"{same} AND ({ties})"))
    exact = [f"{func}(CASE WHEN {codes[column]} = open_{p} THEN {column} END) AS exact_{p}" for p, (func, column) in looked_up.items()]
    second = tied.groupBy(*places).agg(*[F.expr(a) for a in [*exact, _IN_OBJECTS]]).where("size(in_objects) = 0")
    both = first.join(second, F.expr(same), "left")
    texts = []
    for position in looked_up:
        text = f"CASE WHEN {too_long(position)} THEN exact_{position} ELSE {_decoded(f'code_{position}')} END"
        texts.append(f"{text if of_copy else f"coalesce({text}, '')"} AS metric_{position}")
    names = [a.rsplit(" AS ", 1)[1] for a in aggregates]
    return both.selectExpr(*map(_quoted, by), *names, *texts)


def _one_pass(
    df: DataFrame,
    by: Sequence[str],
    metrics: Sequence[tuple[int, Metric]],
    with_count: bool,
    of_copy: bool,
    whole_seconds: bool,
    collation: str | None,
    many_groups: bool = False,
) -> DataFrame:
    fields = {f.name.lower(): f.dataType for f in df.schema.fields}
    groups = [_quoted(c) for c in by]
    # Columns are read and cast once, below the aggregate, whatever the number
    # of metrics over them.
    reads, inputs = [], {}
    for _, metric in metrics:
        key = metric.col, metric.cast
        if key not in inputs:
            value, kind = _quoted(metric.col), fields[metric.col.lower()]
            inputs[key] = f"input_{len(inputs)}"
            reads.append(f"{value if metric.cast is None else read_as(value, kind, metric.cast)} AS {inputs[key]}")
    base = df.selectExpr(*groups, *reads)
    numbers = {name for (_, cast), name in inputs.items() if cast == "numeric"}
    kinds = {f.name: f.dataType for f in base.schema.fields}

    def ordered(column: str, func: str) -> str:
        as_is = collation is None or func == "SUM" or column in numbers or not isinstance(kinds[column], T.StringType)
        return column if as_is else f"{column} COLLATE {collation}"

    aggregates, rows, looked_up = [], [], {}
    if with_count:
        aggregates.append("cast(count(1) AS string) AS metric_0")
        rows.append(f"struct('{COUNT}' AS func, '{EVERY_ROW}' AS col, metric_0 AS value, 0 AS position)")
    for position, metric in metrics:
        column = inputs[metric.col, metric.cast]
        shown = _shown(metric, ordered(column, metric.func), kinds[column], of_copy, whole_seconds)
        is_text = metric.func != "SUM" and isinstance(kinds[column], T.StringType)
        if by and many_groups and is_text and metric.cast != "numeric" and collation is None:
            looked_up[position] = metric.func, column
        else:
            aggregates.append(f"{shown} AS metric_{position}")
        rows.append(
            f"struct('{metric.func}' AS func, {_literal(metric.col)} AS col, metric_{position} AS value, {position} AS position)"
        )
    of_text = any(m.func != "SUM" and isinstance(kinds[inputs[m.col, m.cast]], T.StringType) for _, m in metrics)
    if looked_up:
        wide = _two_looks(base, by, aggregates, looked_up, of_copy)
    elif by and of_text:
        wide = base.groupBy(*by).agg(*[F.expr(a) for a in [*aggregates, _IN_OBJECTS]]).where("size(in_objects) = 0")
    else:
        wide = base.groupBy(*by).agg(*[F.expr(a) for a in aggregates])
    return wide.selectExpr(*groups, f"inline(array({', '.join(rows)}))")


def profile(
    df: DataFrame,
    metrics: Sequence[Metric] = (),
    by: Sequence[str] = (),
    of_copy: bool = False,
    whole_seconds: bool | None = None,
    columns_per_pass: int | None = None,
    collation: str | None = None,
    many_groups: bool = False,
) -> DataFrame:
    """Profile a DataFrame, as one table or per group of ``by``.

    On the source side a SUM of nothing is ``0`` and an extreme of nothing is
    the empty text. On the copy's side (``of_copy``) both stay NULL, and
    timestamps are shown in whole seconds unless ``whole_seconds`` says
    otherwise. All columns are read in one pass unless ``columns_per_pass`` asks
    for more, which only suits columnar files that do not change in between: an
    aggregate over hundreds of columns compiles to methods the JVM does not
    optimise. Text is ordered by its bytes, or by ``collation``, e.g. ``UNICODE`` for a source that
    orders by language. ``many_groups`` is for tasks that meet thousands of groups:
    extremes of texts are then found by two reads of the rows, without sorting them;
    with a collation it has no effect.
    """
    known = {c.lower() for c in df.columns}
    for metric in metrics:
        if metric.func not in FUNCTIONS:
            raise ValueError(f"Function '{metric.func}' is not one of {', '.join(FUNCTIONS)}")
        if metric.col.lower() not in known:
            raise ValueError(f"Column '{metric.col}' not found")
    whole_seconds = of_copy if whole_seconds is None else whole_seconds
    size = columns_per_pass or max(len(metrics), 1)
    columns = list(dict.fromkeys(m.col for m in metrics))
    numbered = list(enumerate(metrics, 1))
    passes = [set(columns[i : i + size]) for i in range(0, len(columns), size)] or [set()]
    return all_profiles([
        _one_pass(df, by, [(i, m) for i, m in numbered if m.col in chosen], first, of_copy, whole_seconds, collation, many_groups)
        for first, chosen in zip([True] + [False] * len(passes), passes)
    ])


def profile_table(
    df: DataFrame, db: str, schema: str, table: str, metrics: Sequence[Metric] = (), **options
) -> DataFrame:
    """The profile of one table, under its identity."""
    long = profile(df, metrics, **options)
    return long.select(F.lit(db).alias("db"), F.lit(schema).alias("schema"), F.lit(table).alias("table"), *long.columns)


def profile_family(
    df: DataFrame, db: str, schema: str, metrics: Sequence[Metric] = (), table: str = "table", **options
) -> DataFrame:
    """Profiles of all physical partitions of a table in one job.

    ``table`` is the column that holds the partition's name.
    """
    long = profile(df, metrics, by=[table], **options)
    rest = ["func", "col", "value", "position"]
    return long.select(F.lit(db).alias("db"), F.lit(schema).alias("schema"), F.col(_quoted(table)).alias("table"), *rest)


def all_profiles(profiles: Sequence[DataFrame]) -> DataFrame:
    """Many tables' profiles as one DataFrame, hence one job."""
    return reduce(DataFrame.unionByName, profiles)
