"""Merkle manifest of a dataset: a content-addressed DAG, and inclusion proofs by descending it.

Every row is a leaf, the digest of its columns. Per source, leaves in the order
of their ids are joined, ``FAN`` consecutive ones at a time, until one subroot
is left; subroots in the order of their sources are joined likewise to the root.
Each node is kept as a record, its digest with its children's, one table a level.

Proofs come from descending the records: the requests for leaves start together
at the root, and at every level the digest in hand is looked up, the digits of the
wanted ranks choose among its children, and the children not chosen are
collected. Requests below the same node travel as one row until they part, so a
level costs a join of its nodes, not of its leaves. The segments collected on the
way down, reversed, are the proof.

How it is spread: ranks come from one range-partitioned sort and the row counts of
its partitions, whatever the sizes of the sources; only digests and ids are
shuffled, never texts. Every level is written to the shared folder, so a lost
executor costs its tasks. The driver holds the root and two heights. One window
without partitions runs over one row per partition of the sort.

Defined results: a null column counts as ``-``; null sources and null ids come
first; rows with the same source and id are ordered by their leaves, and equal
leaves are interchangeable; a lone leaf is its source's subroot, a lone subroot
the root; an empty proof is the digest of the empty text; an empty table has no
root and no rows; other columns of the input, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.llm.common import written

FAN = 3
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_NODE = ["tree", "position", "digest"]


class Manifest(NamedTuple):
    """``leaves``: tree, position, doc_id, source, leaf, and what the caller carries along. ``sources``: tree, source,
    leaves, height, subroot. ``levels`` and ``top``: records of the sources' trees and of the tree above them, by height."""

    leaves: DataFrame
    sources: DataFrame
    levels: list[DataFrame]
    top: list[DataFrame]
    root: str | None

    def store(self) -> DataFrame:
        """digest and children of all records; equal contents are one record."""
        all_levels = [level.select("digest", "children") for level in [*self.levels, *self.top]]
        if not all_levels:
            return self.leaves.select(F.col("leaf").alias("digest"), F.array("leaf").alias("children")).where("false")
        whole = all_levels[0]
        for level in all_levels[1:]:
            whole = whole.unionByName(level)
        return whole.dropDuplicates(["digest"])


def field(value: Column) -> Column:
    """How a value reads in a leaf: its length in bytes and itself, or ``-`` for null."""
    shown = value.cast("string")
    return F.when(shown.isNull(), "-").otherwise(F.concat(F.octet_length(shown).cast("string"), F.lit(":"), shown))


def leaf_of(*values: Column) -> Column:
    """The digest of a row's values, in order, as bytes."""
    return F.unhex(F.sha2(F.concat(*map(field, values)), 256))


def shown(digests: Column) -> Column:
    """Digests, one or several in a row, as hex text."""
    return F.lower(F.hex(digests))


def _joined(digests: Column) -> Column:
    return F.aggregate(digests, F.lit(bytearray()), lambda a, x: F.concat(a, x))


def _ranked(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """The rows with their place, from 0, in the whole order; sorted by range, so no task holds more than a share."""
    # Rows that are equal in everything may be parted too: the last key tells them apart.
    salted = rows.withColumn("salt", F.monotonically_increasing_id())
    keys = [*order, "salt"]
    dealt = salted.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("salt")
    placed = written(dealt.withColumn("place", F.monotonically_increasing_id()))
    part = F.shiftright("place", 33).alias("part")
    counts = placed.groupBy(part).agg(F.count("*").alias("own"))
    before = F.coalesce(F.sum("own").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("part", (before - F.shiftleft("part", 33)).alias("shift"))
    return placed.withColumn("part", part).join(starts, "part").withColumn("place", F.col("place") + F.col("shift")).drop("part", "shift")


def _height(leaves: Column) -> Column:
    """How often ``FAN`` nodes must be joined until one is left."""
    return F.size(F.filter(F.sequence(F.lit(0), F.lit(38)), lambda k: F.pow(F.lit(float(FAN)), k) < leaves))


def _grown(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The records above the given nodes (tree, height, position, digest), by level, and each tree's last digest.

    ``height`` is that of the node's tree.
    """
    most = nodes.agg(F.max("height")).first()[0] or 0
    levels, tops = [], nodes.where("height = 0")
    for height in range(1, most + 1):
        children = F.transform(F.array_sort(F.collect_list(F.struct("position", "digest"))), lambda c: c["digest"])
        parents = (
            nodes.where(F.col("height") >= height)
            .groupBy("tree", "height", F.expr(f"position div {FAN}").alias("parent"))
            .agg(children.alias("children"))
            .select("tree", "height", F.col("parent").alias("position"), F.unhex(F.sha2(shown(_joined(F.col("children"))), 256)).alias("digest"), "children")
        )
        levels.append(written(parents))
        nodes = levels[-1].drop("children")
        tops = tops.unionByName(nodes.where(F.col("height") == height))
    return levels, tops.select("tree", "digest")


def build(rows: DataFrame) -> Manifest:
    """The manifest of rows with doc_id, source and ``leaf``; further columns are carried along with the leaves."""
    placed = _ranked(rows, ["source", "doc_id", "leaf"])
    sizes = placed.groupBy("source").agg(F.min("place").alias("first"), F.count("*").alias("leaves"))
    sources = written(_ranked(sizes, ["source"]).withColumnRenamed("place", "tree").withColumn("height", _height(F.col("leaves"))))
    named = sources.select("tree", "height", "first", F.col("source").alias("named"))
    leaves = written(
        placed.join(named, F.col("source").eqNullSafe(F.col("named")))
        .withColumn("position", F.col("place") - F.col("first"))
        .drop("named", "place", "first")
    )
    levels, subroots = _grown(leaves.select("tree", "height", "position", F.col("leaf").alias("digest")))
    sources = written(sources.join(subroots.withColumnRenamed("digest", "subroot"), "tree").drop("first"))
    trees = sources.count()
    height = next(h for h in range(64) if FAN**h >= trees)
    top, roots = _grown(
        sources.select(F.lit(0).cast("long").alias("tree"), F.lit(height).alias("height"), F.col("tree").alias("position"), F.col("subroot").alias("digest"))
    )
    root = roots.select(shown(F.col("digest")).alias("root")).first()
    return Manifest(leaves, sources, levels, top, root["root"] if root else None)


def _descended(state: DataFrame, level: DataFrame) -> DataFrame:
    """The nodes one level below the given ones, each with the siblings collected on the way to it."""
    records = level.select("digest", "children").dropDuplicates(["digest"])
    chosen = state.join(records, "digest").select("tree", "position", "path", "children", F.posexplode("children").alias("digit", "child"))
    return chosen.select(
        "tree",
        (F.col("position") * FAN + F.col("digit")).alias("position"),
        F.col("child").alias("digest"),
        F.concat("path", F.array(_segment(F.col("children"), F.col("digit")))).alias("path"),
    )


def _segment(children: Column, digit: Column) -> Column:
    """The children not chosen: those before the chosen one, and those after it."""
    return F.struct(
        _joined(F.slice(children, F.lit(1), digit.cast("int"))).alias("before"),
        _joined(F.slice(children, digit.cast("int") + 2, F.lit(FAN))).alias("after"),
    )


def _wanted(state: DataFrame, asked: DataFrame | None, height: int) -> DataFrame:
    """The nodes at this height below which a requested leaf lies."""
    if asked is None:
        return state
    above = asked.select("tree", F.expr(f"position div {FAN ** height}").alias("position")).distinct()
    return state.join(above, ["tree", "position"], "left_semi")


def proofs(manifest: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """The requested leaves (all, or those of the doc_ids in ``requests``) with subroot, root and ``path``.

    ``path`` goes from leaf to root; each segment holds the digests of a run's
    other nodes, ``before`` and ``after`` the one that is being proved.
    """
    leaves = manifest.leaves
    if requests is not None:
        leaves = written(leaves.join(requests.select("doc_id").distinct(), "doc_id", "left_semi"))
    asked = None if requests is None else leaves.select("tree", "position").distinct()
    trees = None if asked is None else asked.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("position")).distinct()

    no_path = F.array().cast("array<struct<before:binary,after:binary>>")
    if manifest.top:
        state = manifest.top[-1].select(*_NODE, no_path.alias("path"))
    else:
        state = manifest.sources.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("position"), F.col("subroot").alias("digest"), no_path.alias("path"))
    for height in range(len(manifest.top), 0, -1):
        state = written(_wanted(_descended(state, manifest.top[height - 1]), trees, height - 1))
    roots = state.select(F.col("position").alias("tree"), "path").join(manifest.sources.select("tree", "height", "subroot"), "tree")
    roots = written(roots.select("tree", "height", F.lit(0).cast("long").alias("position"), F.col("subroot").alias("digest"), "path"))

    def starting(height: int) -> DataFrame:
        return roots.where(F.col("height") == height).drop("height")

    most = len(manifest.levels)
    bottom = starting(0).withColumn("children", F.lit(None).cast("array<binary>"))
    if most:
        state = starting(most)
        for height in range(most, 1, -1):
            state = written(_wanted(_descended(state, manifest.levels[height - 1]), asked, height - 1)).unionByName(starting(height - 1))
        records = manifest.levels[0].select("digest", "children").dropDuplicates(["digest"])
        bottom = bottom.unionByName(state.join(records, "digest"))
    bottom = bottom.select("tree", F.col("position").alias("parent"), "path", "children")
    last = F.when(
        F.col("children").isNotNull(),
        F.concat("path", F.array(_segment(F.col("children"), F.col("position") % FAN))),
    ).otherwise(F.col("path"))
    subroots = manifest.sources.select("tree", "subroot")
    return (
        leaves.withColumn("parent", F.expr(f"position div {FAN}"))
        .join(bottom, ["tree", "parent"])
        .withColumn("path", F.reverse(last))
        .drop("parent", "children")
        .join(subroots, "tree")
        .withColumn("root", F.lit(manifest.root))
    )


def siblings(path: Column) -> Column:
    """All siblings of a path, level by level, left to right, as hex text."""
    return shown(F.aggregate(path, F.lit(bytearray()), lambda a, s: F.concat(a, s["before"], s["after"])))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf (bytes) and its path lead to, as hex text."""
    return F.aggregate(path, shown(leaf), lambda a, s: F.sha2(F.concat(shown(s["before"]), a, shown(s["after"])), 256))


def verified(docs: DataFrame) -> DataFrame:
    """One row per row: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    ``folded_root`` is recomputed from the leaf of a tampered row: where the crc32
    of the id is even, its text lost its line feeds. A null id is not tampered.
    """
    doc_id, source, lang, n_chars, text = map(F.col, COLUMNS)
    leaf = leaf_of(doc_id, source, lang, n_chars, text)
    even = F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 2 == 0, F.lit(False))
    changed = even & F.coalesce(F.contains(text, F.lit("\n")), F.lit(False))
    tampered = F.when(changed, leaf_of(doc_id, source, lang, n_chars, F.replace(text, F.lit("\n"), F.lit("")))).otherwise(F.lit(None))
    manifest = build(written(docs.select("doc_id", "source", leaf.alias("leaf"), tampered.alias("tampered"))))
    proved = proofs(manifest)
    root = folded(F.coalesce("tampered", "leaf"), F.col("path"))
    return proved.select(
        "doc_id",
        shown(F.col("leaf")).alias("leaf"),
        shown(F.col("subroot")).alias("subroot"),
        "root",
        F.sha2(siblings(F.col("path")), 256).alias("proof_sha256"),
        root.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
