"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target number of words: its share of all words by weight,
at most ``MOST`` times its own size, with the excess shared out again. The
whole part of the ratio of target and size is taken for certain, of every document.
The words that then remain are sampled: a document's inclusion probability p grows
with the ``TILT``-th power of its words (in steps of a bit), so that the words
expected are those that remain; where p would pass one the document is certain.
The documents of a source are ranked by the random odds u/(1-u)
divided by the inclusion odds p/(1-p) (Rosen's Pareto sampling), and the first
ones are taken until the words of the source's remainder are filled. What the
document on the border would overshoot goes to smaller ones, by the same order.

The border is found from histograms, never by sorting a source in one task:
three levels of 4,096 bins per source, each over the rows of the one bin that
holds the border. Texts are read twice. Sources are taken to
be a bounded list: the driver holds one row for each, and up to ``FEW_SOURCES`` of
them are sent to the texts; beyond, the texts are shuffled to them once. Random numbers are hashes
of id and text, so reruns agree.

Defined results: a null or blank text has size 0 and is taken 0 words; null is
a source of its own, ordered last; rows that are equal in id and text draw the
same number and count one by one; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.llm.common import text_of, work_folder

WEIGHTS = (1, 2, 3)
MOST = 3
LEVELS = 3
BITS = 12
PLACES = 1 << LEVELS * BITS
#: Times that the words left below a border are offered to smaller documents.
FILLS = 3
#: So many sources are sent to all tasks (10 MB); beyond, rows are shuffled by source.
FEW_SOURCES = 10_000
#: How fast inclusion grows with a document's words: 0 for all alike, 1 in proportion.
TILT = 0.5


def n_words(text: str | Column) -> Column:
    """Runs of other characters than ASCII white space."""
    return F.regexp_count(text_of(text), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def bits_of(size: Column) -> Column:
    """How many binary digits a size has."""
    return F.length(F.bin(size))


def uniform(id_col: str, text_col: str) -> Column:
    """A number above 0 and below 1 for each row, the same in every run."""
    return (F.shiftrightunsigned(F.xxhash64(F.col(id_col), text_of(text_col)), 11) + F.lit(0.5)) / F.lit(float(1 << 53))


def place_of(u: Column, p: Column) -> Column:
    """The Pareto rank q = (u/(1-u)) / (p/(1-p)) as a whole number: q/(1+q) in 2^36 steps."""
    q = (u / (1 - u)) * ((1 - p) / p)
    return F.when(p > 0, F.least(F.floor(q / (1 + q) * PLACES), F.lit(PLACES - 1))).otherwise(PLACES - 1).cast("long")


def allocate(sizes: list[int], weights: list[float], most: float = MOST) -> list[float]:
    """Targets of the sources: shares of all words by weight, none above ``most`` times its size."""
    targets, free, left = [0.0] * len(sizes), {i for i, s in enumerate(sizes) if s}, float(sum(sizes))
    while free:
        share = left / sum(weights[i] for i in free)
        over = {i for i in free if share * weights[i] > most * sizes[i]}
        for i in over or free:
            targets[i] = float(most * sizes[i]) if over else share * weights[i]
        if not over:
            break
        left -= sum(targets[i] for i in over)
        free -= over
    return targets


def inclusion(words: dict[int, int], room: float, tilt: float = TILT) -> list[float]:
    """Inclusion probabilities by the bits of a document's size, so that ``room`` of the ``words`` by bits are expected.

    They are proportional to the size's power; those that would pass one are one, and the others share the rest.
    """
    p, certain = [0.0] * (max(words, default=0) + 1), set()
    while room > 0 and len(certain) < len(words):
        left = room - sum(words[b] for b in certain)
        unit = sum(words[b] * 2.0 ** (tilt * b) for b in words if b not in certain)
        factor = max(left, 0.0) / unit if unit else 0.0
        over = {b for b in words if b not in certain and factor * 2.0 ** (tilt * b) >= 1}
        if not over:
            for b in words:
                p[b] = 1.0 if b in certain else factor * 2.0 ** (tilt * b)
            return p
        certain |= over
    return [1.0 if b in certain else 0.0 for b in range(len(p))]


class Source:
    """What the driver knows of a source: its target, its whole copies, and the border of each round of taking."""

    def __init__(self, name: str | None, words: dict[int, int], target: float, most: float = MOST):
        """``words``: words in documents, by the bits of their size."""
        size = sum(words.values())
        ratio = target / size if size else 0.0
        self.name, self.size, self.target = name, size, target
        self.whole = int(min(math.floor(ratio + 1e-9), most))
        self.left = round(target - self.whole * size) if size and self.whole < most else 0
        self.p = inclusion(words, self.left)
        self.borders: list[int] = []
        self.largest: list[int] = []

    def took(self, border: int, left: int) -> None:
        self.borders.append(border)
        self.largest.append(self.left)
        self.left = left

    def row(self) -> tuple:
        return self.name, self.size, self.target, self.whole, self.p, self.left, self.borders, self.largest


_PARAMETERS = "of string, source_size long, target double, whole int, odds array<double>, left long, borders array<long>, largest array<long>"
_TAKEN = "exists(arrays_zip(borders, largest), r -> place < r.borders and size <= r.largest)"


def _sized(rows: DataFrame, n: int) -> DataFrame:
    """Rows of about a kilobyte or less are sent to every task while they are few; more of them are joined by a shuffle."""
    return F.broadcast(rows) if n <= FEW_SOURCES else rows


def _with_parameters(rows: DataFrame, sources: list[Source], source: str = "source") -> DataFrame:
    """Adds the columns of each row's source, and its own p."""
    parameters = rows.sparkSession.createDataFrame([s.row() for s in sources], _PARAMETERS)
    return rows.join(_sized(parameters, len(sources)), F.col(source).eqNullSafe(F.col("of")), "left").withColumn("p", F.coalesce(F.get("odds", bits_of(F.col("size"))), F.lit(0.0))).drop("of", "odds")


def _find_borders(rows: DataFrame, room: dict[str | None, int]) -> dict[str | None, tuple[int, int]]:
    """For each source: the place before which its rows fit into its room, and the room that they leave."""
    session, found = rows.sparkSession, {}
    prefix, left = dict.fromkeys(room, 0), dict(room)
    for level in range(LEVELS):
        if not prefix:
            break
        shift = BITS * (LEVELS - 1 - level)
        at = session.createDataFrame([(n, prefix[n], left[n]) for n in prefix], "at string, prefix long, room long")
        inside = rows.join(_sized(at, len(prefix)), F.col("source").eqNullSafe(F.col("at"))).where(F.shiftright("place", shift + BITS) == F.col("prefix"))
        bins = inside.groupBy("source", "room", F.shiftright("place", shift).alias("bin")).agg(F.sum("size").alias("words"))
        upto = F.sum("words").over(Window.partitionBy("source").orderBy("bin"))  # at most 4,096 bins of a source
        edge = F.min(F.expr("if(upto > room, struct(bin, room - upto + words as rest), null)")).alias("edge")
        seen = bins.withColumn("upto", upto).groupBy("source").agg(edge, F.max("upto").alias("all")).collect()
        edges = {r["source"]: r["edge"] for r in seen if r["edge"]}
        words = {r["source"]: r["all"] for r in seen}
        for name in prefix.keys() - edges.keys():  # all of them fit
            found[name] = ((prefix[name] + 1) << (shift + BITS), left[name] - words.get(name, 0))
        prefix = {n: e["bin"] for n, e in edges.items()}
        left = {n: e["rest"] for n, e in edges.items()}
    return found | {n: (prefix[n], left[n]) for n in prefix}


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS, most: float = MOST) -> list[Source]:
    """The sources with their targets and borders, from one narrow table of all rows."""
    folder = f"{work_folder(docs.sparkSession)}/drawn"
    narrow = docs.select(F.col(source_col).alias("source"), n_words(text_col).alias("size"), uniform(id_col, text_col).alias("u"))
    narrow.write.parquet(folder)
    drawn = docs.sparkSession.read.schema("source string, size long, u double").parquet(folder)
    words: dict[str | None, dict[int, int]] = {}
    for r in drawn.groupBy("source", bits_of(F.col("size")).alias("bits")).agg(F.sum("size").alias("words")).collect():
        words.setdefault(r["source"], {})[r["bits"]] = int(r["words"])
    names = sorted(words, key=lambda name: (name is None, name or ""))
    targets = allocate([sum(words[n].values()) for n in names], [weights[i % len(weights)] for i in range(len(names))], most)
    sources = [Source(name, words[name], target, most) for name, target in zip(names, targets, strict=True)]
    for _ in range(1 + FILLS):
        room = {s.name: s.left for s in sources if s.left > 0}
        if not room:
            break
        ranked = ranks(_with_parameters(drawn, sources)).where(f"size > 0 and size <= left and not {_TAKEN}")
        found = _find_borders(ranked, room)
        for s in sources:
            s.took(*found.get(s.name, (0, s.left)))
    return sources


def ranks(rows: DataFrame) -> DataFrame:
    return rows.withColumn("place", place_of(F.col("u"), F.col("p")))


def copies(docs: DataFrame, sources: list[Source], id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of ``docs``: doc_id, row (all columns), size, source_size, target, copies. Nothing is shuffled."""
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
        F.col(source_col).alias("source"),
        n_words(text_col).alias("size"),
        uniform(id_col, text_col).alias("u"),
    )
    rest = F.expr(f"if(size > 0 and p > 0 and {_TAKEN}, 1, 0)")
    return ranks(_with_parameters(rows, sources)).select(
        "doc_id", "row", "size", "source_size", "target", F.when(F.col("size") > 0, F.col("whole") + rest).otherwise(0).alias("copies")
    )


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS, most: float = MOST) -> DataFrame:
    """One row per row: doc_id, size, source_size, target, taken."""
    chosen = copies(docs, plan(docs, id_col, text_col, source_col, weights, most), id_col, text_col, source_col)
    return chosen.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS, most: float = MOST) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it. Rows without words are neither added nor dropped."""
    chosen = copies(docs, plan(docs, id_col, text_col, source_col, weights, most), id_col, text_col, source_col)
    times = F.when(F.col("size") == 0, 1).otherwise(F.col("copies"))
    return chosen.where(times > 0).withColumn("copy", F.explode(F.sequence(F.lit(1), times))).select("row.*")
