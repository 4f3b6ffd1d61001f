"""Near duplicates by HyperMinHash: compressed registers, banding, a corrected estimate, then full sets.

1. Each text becomes its set of word shingles (64-bit hashes) and a sketch: the
   shingles fall into buckets, each bucket keeps the smallest value as a count
   of leading zeros and mantissa bits (16 bits a register); empty buckets borrow
   by a fixed probe order. Documents with the same set are one class.
2. Registers are banded. Classes that share no band with another one are done
   (a pair at the least similarity shares none of the 32 bands of 4 registers
   once in twenty million times).
3. For the others it is counted how many of their shingles any other of them
   has. That bounds every possible intersection, and settles most classes that
   differ too much from all others without looking at pairs.
4. Each remaining class is compared with one hub, the most typical class of its
   bands, and with eight if that gives no link; the links give components. Pairs
   of a band are then compared only across components, so a group of thousands of
   copies costs few comparisons each. Pairs pass a bound by bitmaps of their sets, which never
   drops a link, and the collision-corrected Jaccard estimate, five standard errors wide, before full sets are intersected.

All steps are shuffles of narrow rows on hashes with counts combined before the
shuffle; texts are shuffled once, to fetch those of candidate classes. Sets,
links and labels are kept as tables in the shared folder.

Defined results: A-Z count as a-z; words are separated by ASCII white space; a
text with fewer words than a shingle is one shingle; a null or blank text has
none, is linked with nothing and is its own component; a null doc_id takes part
and is never a component's name unless it is alone; repeated rows are copies.
"""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymark.llm.common import Words, bytes_of, chunks, mixed, text_of, work_folder, written

ROWS, BANDS = 4, 32
REGISTERS = ROWS * BANDS
#: 64-bit words of a set's bitmap.
BITMAP = 16
MANTISSA = 10
PROBES = 512
#: Hubs of a bucket that classes are tried with before pairs are looked at.
HUBS = 8
ERRORS = 5
_ODD = np.uint64(0x9E3779B97F4A7C15)
_PROBE = (mixed(np.arange(REGISTERS * PROBES, dtype=np.uint64) * _ODD + np.uint64(7)) % np.uint64(REGISTERS)).astype(np.int64).reshape(PROBES, REGISTERS)
_WORDS = Words()


def shingle_sets(texts: list[bytes], words: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of all texts, sorted within each text, and how many each text has."""
    hashes, _, _, counts = _WORDS.split(texts)
    doc = np.repeat(np.arange(len(texts)), counts)
    first = np.cumsum(counts) - counts
    left = np.repeat(first + counts, counts) - np.arange(len(hashes))  # words up to the end of the text
    begins = np.flatnonzero((left >= words) | ((np.repeat(counts, counts) < words) & (np.arange(len(hashes)) == np.repeat(first, counts))))
    value = np.zeros(len(begins), dtype=np.uint64)
    for k in range(words):
        there = left[begins] > k
        value = (value + np.where(there, hashes[np.minimum(begins + k, len(hashes) - 1)], np.uint64(k + 1))) * _ODD if len(begins) else value
    value, owner = mixed(value), doc[begins]
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), dtype=bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    return value[new], np.bincount(owner[new], minlength=len(texts))


def class_of(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A hash of each whole set."""
    sums = np.concatenate(([np.uint64(0)], np.cumsum(mixed(values ^ _ODD), dtype=np.uint64)))
    edges = np.concatenate(([0], np.cumsum(counts)))
    return mixed((sums[edges[1:]] - sums[edges[:-1]]) ^ (counts.astype(np.uint64) * _ODD)).astype(np.int64)


def registers(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One row of registers per set that is not empty: leading zeros and mantissa of each bucket's minimum."""
    n = len(counts)
    owner = np.repeat(np.arange(n), counts)
    cell = owner * REGISTERS + (values % np.uint64(REGISTERS)).astype(np.int64)
    draw = mixed(values + np.uint64(0xA5A5A5A5A5A5A5A5)) >> np.uint64(1) | np.uint64(1)  # 63 bits, not 0
    lowest = np.full(n * REGISTERS, np.iinfo(np.uint64).max, dtype=np.uint64)
    order = np.argsort(cell, kind="stable")
    if len(order):
        cells = cell[order]
        starts = np.flatnonzero(np.concatenate(([True], cells[1:] != cells[:-1])))
        lowest[cells[starts]] = np.minimum.reduceat(draw[order], starts)
    filled = lowest != np.iinfo(np.uint64).max
    exponent = np.frexp(np.where(filled, lowest, 1).astype(np.float64))
    zeros = np.clip(63 - exponent[1], 0, 62).astype(np.int64)
    mantissa = np.minimum(((exponent[0] * 2 - 1) * (1 << MANTISSA)).astype(np.int64), (1 << MANTISSA) - 1)
    packed = np.where(filled, (zeros << MANTISSA) | mantissa, -1).reshape(n, REGISTERS)
    # Empty buckets borrow the register of the first filled bucket in their own order of probes.
    own = packed.copy()
    row, column = np.nonzero((own < 0) & (counts > 0)[:, None])
    for probe in _PROBE:
        if not len(row):
            break
        found = own[row, probe[column]]
        packed[row, column] = found
        row, column = row[found < 0], column[found < 0]
    if len(row):
        packed[row, column] = own.max(axis=1)[row]
    return packed.astype(np.uint16)


def bitmaps(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A bitmap per set of which each shingle sets one bit: a bit that another set lacks is a shingle that it lacks."""
    bits = np.zeros((len(counts), 64 * BITMAP), dtype=bool)
    bits[np.repeat(np.arange(len(counts)), counts), (values >> np.uint64(40)) % np.uint64(64 * BITMAP)] = True
    return np.packbits(bits, axis=1).view(np.int64)


def _possible(percent: int) -> str:
    """Whether a and b, by their bitmaps and shared shingles, may have enough in common."""
    lacking = lambda x, y: " + ".join(f"bit_count({x}.bits[{i}] & ~{y}.bits[{i}])" for i in range(BITMAP))
    most = f"least(a.shared, b.shared, a.n - ({lacking('a', 'b')}), b.n - ({lacking('b', 'a')}))"
    return f"{100 + percent} * {most} >= {percent} * (a.n + b.n)"


def sketches(docs: DataFrame, words: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: doc_id, n_shingles, class and registers (null for an empty set), bits."""

    def batches(stream):
        import pyarrow as pa

        for batch in stream:
            raw = bytes_of(batch, "text")
            for low, high in chunks(raw):
                values, counts = shingle_sets(raw[low:high], words)
                empty = counts == 0
                rows = registers(values, counts)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(low, high - low), pa.array(counts, pa.int64()), pa.array(class_of(values, counts), mask=empty),
                        pa.array([None if e else r.tobytes() for r, e in zip(rows, empty, strict=True)], pa.binary()),
                        pa.FixedSizeListArray.from_arrays(pa.array(bitmaps(values, counts).ravel()), BITMAP).cast(pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "n_shingles", "class", "registers", "bits"],
                )

    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(batches, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_shingles long, class long, registers binary, bits array<long>")


def sets_of(texts: DataFrame, words: int) -> DataFrame:
    """class and shingles of rows ``class, text``; rows whose text has another set are left out."""

    def batches(stream):
        import pyarrow as pa

        for batch in stream:
            raw, wanted = bytes_of(batch, "text"), batch.column("class").to_numpy(zero_copy_only=False)
            for low, high in chunks(raw):
                values, counts = shingle_sets(raw[low:high], words)
                sets = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32)), pa.array(values.astype(np.int64)))
                same = pa.array(class_of(values, counts) == wanted[low:high])
                yield pa.RecordBatch.from_arrays([batch.column("class").slice(low, high - low), sets], names=["class", "shingles"]).filter(same)

    return texts.mapInArrow(batches, "class long, shingles array<long>")


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Jaccard similarity from the share of equal registers, less the chance that different minima look alike."""
    levels = np.arange(64)
    high, low = 2.0 ** -levels, 2.0 ** -(levels + 1)

    def share(n: np.ndarray) -> np.ndarray:  # of minima with so many leading zeros
        each = np.maximum(n / REGISTERS, 1.0)[:, None]
        return (1 - low) ** each - (1 - high) ** each

    chance = (share(n_a) * share(n_b)).sum(axis=1) / (1 << MANTISSA)
    return ((a == b).mean(axis=1) - chance) / (1 - chance)


def _likely(pairs: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b, n_a, n_b, r_a, r_b`` whose estimate may belong to a link."""
    least = percent / 100 - ERRORS * (percent / 100 * (1 - percent / 100) / REGISTERS) ** 0.5

    def batches(stream):
        import pyarrow as pa

        for batch in stream:
            if batch.num_rows:
                a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint16).reshape(-1, REGISTERS) for c in ("r_a", "r_b"))
                n_a, n_b = (batch.column(c).to_numpy() for c in ("n_a", "n_b"))
                yield batch.select(["a", "b", "n_a", "n_b"]).filter(pa.array(estimate(a, b, n_a, n_b) >= least))

    return pairs.select("a", "b", "n_a", "n_b", "r_a", "r_b").mapInArrow(batches, "a long, b long, n_a long, n_b long")


def _confirmed(pairs: DataFrame, known: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The links among pairs ``a, b``: by bound and estimate, then by intersecting full sets."""
    both = (
        pairs.alias("p").join(known.alias("a"), F.expr("p.a = a.class")).join(known.alias("b"), F.expr(f"p.b = b.class and {_possible(percent)}"))
        .selectExpr("p.a", "p.b", "a.n as n_a", "b.n as n_b", "a.registers as r_a", "b.registers as r_b")
    )
    return _intersected(_likely(both, percent), sets, percent)


def _intersected(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The links among pairs ``a, b, n_a, n_b``, by intersecting full sets."""
    full = (
        pairs
        .join(sets.select(F.col("class").alias("a"), F.col("shingles").alias("x")), "a")
        .join(sets.select(F.col("class").alias("b"), F.col("shingles").alias("y")), "b")
    )
    common = F.size(F.array_intersect("x", "y"))
    return written(full.where(common * (100 + percent) >= percent * (F.col("n_a") + F.col("n_b"))).select("a", "b"))


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """class and label, the smallest class that it reaches: labels spread over links and jump to their own label."""
    both = written(links.select("a", "b").union(links.select("b", "a")).distinct())
    labels = written(nodes.select("class", F.col("class").alias("label")))
    while True:
        near = both.join(labels, F.col("b") == F.col("class")).groupBy("a").agg(F.min("label").alias("near"))
        spread = labels.join(near, F.col("class") == F.col("a"), "left").select("class", F.col("label").alias("old"), F.least("label", F.coalesce("near", "label")).alias("next"))
        jump = labels.select(F.col("class").alias("next"), F.col("label").alias("beyond"))
        step = written(spread.join(jump, "next").select("class", "old", F.least("next", "beyond").alias("label")))
        labels = step.select("class", "label")
        if step.where("label != old").isEmpty():
            return labels


def _placed(rows: DataFrame, known: DataFrame, hubs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of the buckets with what pairs are judged by; ``outside``: in another component than the bucket's hub."""
    heads = hubs.select("bucket", F.col("top.hub").alias("class")).join(labels, "class").select("bucket", F.col("label").alias("main"))
    own = rows.select("class", "bucket").join(labels, "class").join(known.select("class", "n", "shared", "bits"), "class")
    return written(own.join(heads, "bucket").withColumn("outside", F.expr("label != main")))


def near_classes(docs: DataFrame, drawn: DataFrame, words: int, percent: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """class and component_id of every class that has links. ``drawn``: the sketches of ``docs``, as a table."""
    classes = drawn.where("class is not null").groupBy("class", "n_shingles", "registers", "bits").agg(F.min("doc_id").alias("doc_id"))
    buckets = F.expr(f"transform(sequence(0, {BANDS - 1}), band -> xxhash64(band, substring(registers, {2 * ROWS} * band + 1, {2 * ROWS})))")
    banded = classes.select("class", F.explode(buckets).alias("bucket"))
    met = banded.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    banded = written(banded.join(met, "bucket", "left_semi"))
    candidates = written(classes.join(banded.select("class").distinct(), "class", "left_semi"))
    wanted = candidates.select(F.col("doc_id").alias("wanted"), "class")
    texts = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).join(wanted, F.expr("id <=> wanted")).select("class", "text")
    sets = written(sets_of(texts, words))
    shingles = sets.select("class", F.explode("shingles").alias("shingle"))
    common = shingles.groupBy("shingle").agg(F.count("*").alias("df")).where("df > 1")
    shared = shingles.join(common, "shingle", "left_semi").groupBy("class").agg(F.count("*").alias("shared"))
    linkable = f"{(100 + percent) * 100} * shared >= {percent} * {100 + percent} * n"
    known = written(candidates.join(shared, "class").select("class", F.col("n_shingles").alias("n"), "shared", "registers", "bits", "doc_id").where(linkable))
    # The hub of a bucket has the largest share of shingles that others have too.
    typical = F.struct((F.col("shared") / F.col("n")).alias("share"), F.col("class").alias("hub"))
    rows = written(banded.join(known.select("class", typical.alias("typical")), "class"))
    hubs = rows.groupBy("bucket").agg(F.max("typical").alias("top"))
    star = rows.join(hubs, "bucket").groupBy(F.col("class").alias("a")).agg(F.max("top").alias("top")).select("a", F.col("top.hub").alias("b")).where("a != b")
    links = _confirmed(star, known, sets, percent)
    labels = components(known, links)
    # Classes that are not with their hub yet are compared with more hubs of their buckets.
    placed = _placed(rows, known, hubs, labels)
    order = Window.partitionBy("bucket").orderBy(F.desc("typical"))
    more_hubs = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= HUBS).select("bucket", "class")
    more_hubs = more_hubs.join(known.select("class", "n", "shared", "bits"), "class").alias("b")
    again = placed.where("outside").alias("a").join(more_hubs, F.expr(f"a.bucket = b.bucket and a.class != b.class and {_possible(percent)}"))
    again = again.select(F.col("a.class").alias("a"), F.col("b.class").alias("b")).distinct()
    links = links.union(_confirmed(again, known, sets, percent))
    labels = components(known, links)
    # What is left: pairs across components of which one is not with its hub.
    placed = _placed(rows, known, hubs, labels)
    placed = placed.join(placed.where("outside").select("bucket").distinct(), "bucket", "left_semi")
    a, b = placed.where("outside").alias("a"), placed.alias("b")
    across = a.join(b, F.expr(f"a.bucket = b.bucket and a.label != b.label and (not b.outside or a.class < b.class) and {_possible(percent)}"))
    more = _confirmed(across.select(F.col("a.class").alias("a"), F.col("b.class").alias("b")).distinct(), known, sets, percent)
    labels = components(known, links.union(more))
    names = labels.join(known.select("class", "doc_id"), "class")
    return written(names.join(names.groupBy("label").agg(F.min("doc_id").alias("component_id")), "label").select("class", "component_id"))


def linked_classes(docs: DataFrame, drawn: DataFrame, words: int, percent: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As `near_classes`, with every link for certain: no bands and no estimate, but a prefix filter over full sets.

    Two sets that are alike enough share one of the first shingles of both, where
    shingles are ordered by rarity and as many are taken as may be missing and one.
    """
    classes = drawn.where("class is not null").groupBy("class", F.col("n_shingles").alias("n")).agg(F.min("doc_id").alias("doc_id"))
    wanted = classes.select(F.col("doc_id").alias("wanted"), "class")
    texts = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).join(wanted, F.expr("id <=> wanted")).select("class", "text")
    # A doc_id that several texts have names some of them; their sets differ and are left out, but for one of equal ones.
    sets = written(sets_of(texts, words).dropDuplicates(["class"]))
    shingles = sets.select("class", F.explode("shingles").alias("shingle"))
    common = shingles.groupBy("shingle").agg(F.count("*").alias("df"))
    own = shingles.join(common, "shingle").join(classes.select("class", "n"), "class")
    place = F.row_number().over(Window.partitionBy("class").orderBy("df", "shingle"))
    prefix = own.withColumn("place", place).where(f"df > 1 and place <= n - cast(ceil({percent} * n / 100) as long) + 1")
    prefix = written(prefix.select("shingle", "class", "n", "place"))
    needed = f"{percent} * (a.n + b.n)"
    bounds = f"100 * least(a.n, b.n) >= {percent} * greatest(a.n, b.n) and {100 + percent} * (1 + least(a.n - a.place, b.n - b.place)) >= {needed}"
    met = prefix.alias("a").join(prefix.alias("b"), F.expr(f"a.shingle = b.shingle and a.class < b.class and {bounds}"))
    pairs = written(met.select(F.col("a.class").alias("a"), F.col("b.class").alias("b"), F.col("a.n").alias("n_a"), F.col("b.n").alias("n_b")).distinct())
    links = _intersected(pairs, sets, percent)
    labels = components(classes, links)
    names = labels.join(classes.select("class", "doc_id"), "class")
    return written(names.join(names.groupBy("label").agg(F.min("doc_id").alias("component_id")), "label").select("class", "component_id"))


def near_duplicates(
    docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", exact: bool = False
) -> DataFrame:
    """One row per row: doc_id, n_shingles, component_id (the smallest doc_id reachable), kept.

    A link at 0.8 is missed by all bands with a chance of 5e-8, and by the estimate
    (five standard errors) with one of about 3e-7. ``exact`` misses none; its join
    grows with the pairs that share a rare shingle.
    """
    drawn = written(sketches(docs, words, id_col, text_col))
    linked = (linked_classes if exact else near_classes)(docs, drawn, words, percent, id_col, text_col)
    alike = drawn.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("first_id"))
    named = written(alike.join(linked, "class", "left").select("class", F.coalesce("component_id", "first_id").alias("component_id")))
    rows = drawn.select("doc_id", "n_shingles", "class").join(named, "class", "left")
    component = F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return rows.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def one_of_each(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` but those that have a near duplicate with a smaller doc_id. Rows without words stay."""
    decided = near_duplicates(docs, words, percent, id_col, text_col)
    name = f"gone_{uuid.uuid4().hex}"  # no column of the input has this name
    gone = decided.where("not kept").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(gone, F.col(f"`{id_col}`").eqNullSafe(F.col(name)), "left_anti")
