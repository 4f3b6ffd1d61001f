"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

Texts are equal when they are identical without white space. Each level looks
only at the groups that the level above left with two rows or more, and only
narrow rows (lengths and hashes) are shuffled, never texts. Every count is
combined before its shuffle, so a text that a third of all rows share sends one
row per task; the joins back to the rows are plain equi-joins that adaptive
execution can split on a hot key.

Defined results: a null text counts as empty; empty texts are equal to each
other; among equal texts the longest original (in code points) stays, then the
smallest doc_id (a null doc_id comes last); an empty table gives no rows. Other
columns of the input, whatever their names, are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import text_of, written

PREFIX_CHARS = 64
_IGNORED = " \t\n\v\f\r"


def normalised(text: str | Column) -> Column:
    return F.translate(text_of(text), _IGNORED, "")


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Of each row: id, code points of the original text, and the three levels; unused ones are pruned from the scan."""
    text = normalised(text_col)
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.char_length(text_of(text_col)).cast("long").alias("n"),
        F.octet_length(text).alias("length"),
        F.xxhash64(F.substring(text, 1, PREFIX_CHARS)).alias("prefix"),
        F.sha2(text.cast("binary"), 256).alias("text_sha256"),
    )


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per text that two rows or more have: text_sha256, keep_id, group_size, and keep_rows,
    the number of rows that are equal to the one that stays in id and length too."""
    rows = signatures(docs, id_col, text_col)
    prefixes = rows.groupBy("length", "prefix").agg(F.count("*").alias("rows"))
    lengths = prefixes.groupBy("length").agg(F.sum("rows").alias("same_length")).where("same_length > 1")
    alike = prefixes.where("rows > 1").join(lengths, "length", "left_semi").select("length", "prefix")
    left = rows.join(alike, ["length", "prefix"], "left_semi")
    by_row = left.groupBy("text_sha256", "doc_id", "n").agg(F.count("*").alias("rows"))
    # The best row first: most code points, then the smallest id, null ids last.
    best = F.struct(F.col("n"), F.col("doc_id").isNotNull().alias("known"), (-F.col("doc_id")).alias("minus"))
    return (
        by_row.groupBy("text_sha256")
        .agg(F.max(F.struct(best.alias("best"), F.col("rows"))).alias("top"), F.sum("rows").alias("group_size"))
        .where("group_size > 1")
        .select("text_sha256", (-F.col("top.best.minus")).alias("keep_id"), "group_size", F.col("top.best.n").alias("keep_n"), F.col("top.rows").alias("keep_rows"))
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    groups = duplicate_groups(docs, id_col, text_col)
    rows = signatures(docs, id_col, text_col).select("doc_id", "n", "text_sha256")
    alone = F.col("group_size").isNull()
    return rows.join(groups, "text_sha256", "left").select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n") == F.col("keep_n")))).alias("kept"),
        "text_sha256",
    )


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns. A row that is repeated, id included, stays once.

    One join against the narrow rows of the groups; a text outside them meets nothing.
    """
    groups = duplicate_groups(docs, id_col, text_col)
    rows = signatures(docs, id_col, text_col).select("text_sha256", F.col("doc_id").alias("id"), F.col("n").alias("chars"))
    stays = F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("chars") == F.col("keep_n"))
    decided = rows.join(groups, "text_sha256").withColumn("stays", stays)
    # What a row is matched by: rows that are equal in it are equal in all that decides.
    decided = written(decided.groupBy("text_sha256", "id", "chars", "stays").agg(F.count("*").alias("rows")))
    names = [f"dedup_{i}_{uuid.uuid4().hex}" for i in range(2)]  # no column of the input has these names
    aside = [f"{name}_" for name in (*names, "id")]
    text = normalised(text_col)
    keyed = docs.withColumns({
        names[0]: F.sha2(text.cast("binary"), 256), names[1]: F.char_length(text_of(text_col)).cast("long"),
    })
    columns = [F.col(f"`{c}`") for c in docs.columns]
    same = (F.col(names[0]) == F.col(aside[0])) & (F.col(names[1]) == F.col(aside[1])) & F.col(f"`{id_col}`").eqNullSafe(F.col(aside[2]))

    def narrow(condition: str) -> DataFrame:
        return decided.where(condition).select("text_sha256", "chars", "id").toDF(*aside)

    single = keyed.join(narrow("not stays or rows > 1"), same, "left_anti").select(*columns)
    if decided.where("stays and rows > 1").isEmpty():  # no row is repeated with its id: the texts are read once
        return single
    repeated = keyed.join(narrow("stays and rows > 1"), same, "left_semi").dropDuplicates([names[0]]).select(*columns)
    return single.unionByName(repeated)
