"""Row-level digests: a key digest and a content digest per row.

A narrow projection: nothing is shuffled, whatever the table's size.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.functions import text
from tallymark.operators.control import ALL_COLUMNS, NO_KEYS


def key_columns(keys: str | Sequence[str], columns: Sequence[str], table: str = "") -> list[str]:
    """The key columns named by a list or a comma-separated text; ``ALL`` is every column."""
    if isinstance(keys, str):
        if keys.upper() == ALL_COLUMNS:
            return list(columns)
        keys = [k.strip() for k in keys.split(",") if k.strip()]
    if not keys:
        raise ValueError(NO_KEYS)
    known = {c.lower() for c in columns}
    for key in keys:
        if key.lower() not in known:
            raise ValueError(f"Key column '{key}' not found in table '{table}'")
    return list(keys)


def content_rows(
    df: DataFrame,
    keys: str | Sequence[str],
    columns: Sequence[str],
    special: Collection[str],
    exclude_content: bool = False,
    exact: bool = False,
    table: str = "",
) -> DataFrame:
    """``hash_key, key, hash_content, content`` for every row.

    ``columns`` are all columns in type-map order, ``special`` those whose
    text is reread as Windows-874 (may be empty, in any case).
    ``exclude_content`` leaves the content text empty but keeps its digest.
    ``exact`` uses row text that cannot collide.
    """
    reread = {c.lower() for c in special}

    def value(column: str) -> Column:
        plain = text.name(column)
        return text.reread_as_windows_874(plain.cast("string")) if column.lower() in reread else plain

    joined = text.exact_row_text if exact else text.row_text
    key = joined([value(c) for c in key_columns(keys, columns, table)])
    content = joined([value(c) for c in columns])
    return df.select(
        text.digest(key).alias("hash_key"),
        key.alias("key"),
        text.digest(content).alias("hash_content"),
        (F.lit("") if exclude_content else content).alias("content"),
    )
