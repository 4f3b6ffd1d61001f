"""Benchmark passages in documents: a prefix-filtered join of word shingles, checked over item-sized windows.

An item's windows are its runs of ``window`` words (all of its words, if there are
fewer). A window is a set of shingles of ``shingle`` words; a document holds the
window only where it holds all of them. So one shingle is a necessary prefix, and
the rarest in the corpus makes the fewest candidates.

1. The shingles of all windows set bits in a bitmap of bounded size. Documents are
   read once; runs of words whose shingles are all in the bitmap, long enough to
   hold a window (the length bound), are kept as passages. The bitmap lets wrong
   ones through and loses none.
2. Passages that are equal are looked at once. Their shingles, counted with the
   documents they stand in, order the shingles of every window by rarity.
3. Windows meet passages by their rarest shingle; the place of it in both gives the
   place of the window, which must lie inside (the positional bound), and the
   words there must be the window's, one by one.
4. Places go back to the documents' passages; overlapping ones are united.

How it is spread: only passages are shuffled, never texts. A passage that a third of
all documents share is one row until its places go back, by a plain equi-join that
adaptive execution can split. Benchmarks of any size work: beyond the bitmap's
bound it lets more through. Results per document are gathered from its own
passages and the items that occur in it.

Defined results: null texts and items have no words; items without words have no
windows; equal windows of several items count for each; a repeated item_id is one
item, a null one shows as the empty text; repeated rows have results of their own;
empty tables, of documents or items, give no hits; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.llm.common import Words, bytes_of, chunks, mixed, text_of, written

WINDOW, SHINGLE = 10, 5
#: Bits of the bitmap for each shingle, and the most bits it may have (8 MB).
BITS_EACH, MOST_BITS = 64, 1 << 26
#: The bytes that stand between words, all but digits, letters and what is beyond ASCII.
SEPARATORS = bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
_WORDS = Words(SEPARATORS)
_NOT_WORDS = "[" + "".join(f"\\x{b:02X}" for b in SEPARATORS) + "]+"
_TURN = np.uint64(0x9FB21C651E98DF25)


def words_of(text: str | Column) -> Column:
    """The words of a text, A-Z as a-z."""
    lower = F.translate(text_of(text), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(lower, _NOT_WORDS), lambda w: w != "")


def _shingles(words: Column, size: Column) -> Column:
    """place and shingle of every run of ``size`` words."""
    places = F.sequence(F.lit(0), F.size(words) - size)
    found = F.transform(places, lambda i: F.struct(i.alias("place"), F.concat_ws(" ", F.slice(words, i + 1, size)).alias("shingle")))
    return F.when(F.size(words) >= size, found).otherwise(F.array().cast("array<struct<place:int,shingle:string>>"))


def item_windows(items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """item_id, passage (the window's words), words and size (their number and that of a shingle's), one row per item and window."""
    words = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), words_of("text").alias("w")).where("size(w) > 0")
    length = F.least(F.size("w"), F.lit(window))
    return (
        words.withColumn("words", length)
        .withColumn("size", F.least("words", F.lit(shingle)))
        .select("item_id", "words", "size", F.explode(_shingles(F.col("w"), F.col("words"))).alias("found"))
        .select("item_id", "words", "size", F.col("found.shingle").alias("passage"))
        .distinct()
    )


def _hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of ``size`` words."""
    count = max(len(words) - size + 1, 0)
    h = np.zeros(count, dtype=np.uint64)
    for i in range(size):
        h = h * _TURN + words[i : i + count]
    return mixed(h + np.uint64(size))


def _bits(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
    return [hashes & np.uint64(bits - 1), (hashes >> np.uint64(32)) & np.uint64(bits - 1)]


class Bitmap:
    """Bits of the shingles of one size, and the least run of them that can hold a window."""

    def __init__(self, size: int, least: int, bits: int):
        self.size, self.least, self.bits = size, least, bits
        self.mask = np.zeros(max(bits // 64, 1), dtype=np.uint64)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), dtype=bool)
        for at in _bits(hashes, self.bits):
            found &= (self.mask[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
        return found


def bitmaps(windows: DataFrame) -> list[Bitmap]:
    """The bitmap of each shingle size, joined from the parts of all workers; its size is bounded whatever the benchmark's."""
    shingled = windows.select("words", "size", F.explode(_shingles(F.split("passage", " "), F.col("size"))).alias("found"))
    shingled = shingled.select("words", "size", F.col("found.shingle").alias("text"))
    sizes = shingled.groupBy("size").agg(F.min(F.col("words") - F.col("size") + 1).alias("least"), F.count("*").alias("n")).collect()
    maps = {r["size"]: Bitmap(r["size"], r["least"], min(MOST_BITS, 1 << (r["n"] * BITS_EACH - 1).bit_length())) for r in sizes}
    bits = {size: m.bits for size, m in maps.items()}

    def marks(stream):
        import pyarrow as pa

        for batch in stream:
            of = batch.column("size").to_numpy()
            raw = bytes_of(batch, "text")
            for size in np.unique(of):
                texts = [raw[i] for i in np.flatnonzero(of == size)]
                words, _, _, _ = _WORDS.split(texts)
                h = _hashes(words, int(size))[:: int(size)]  # the texts lie end to end, each of exactly this many words
                at = np.unique(np.concatenate(_bits(h, bits[int(size)])))
                part = np.unique(at >> np.uint64(6))
                mask = np.zeros(len(part), dtype=np.uint64)
                np.bitwise_or.at(mask, np.searchsorted(part, at >> np.uint64(6)), np.uint64(1) << (at & np.uint64(63)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(part), size, dtype=np.int32)), pa.array(part.view(np.int64)), pa.array(mask.view(np.int64))],
                    names=["size", "part", "mask"],
                )

    joined = shingled.select("size", "text").mapInArrow(marks, "size int, part long, mask long").groupBy("size", "part").agg(F.bit_or("mask").alias("mask"))
    found = joined.toArrow()
    of, part, mask = (found.column(c).to_numpy() for c in ("size", "part", "mask"))
    for size, m in maps.items():
        m.mask[part[of == size]] = mask[of == size].view(np.uint64)
    return list(maps.values())


def _runs(inside: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last place of the runs of at least ``least`` true values."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], inside.view(np.int8), [0]))))
    first, past = edges[0::2], edges[1::2]
    long = past - first >= least
    return first[long], past[long] - 1


def passages(docs: DataFrame, maps: list[Bitmap]) -> DataFrame:
    """row, doc_id, n_words and ``found`` of every document: the passages (size of their shingles, first word, words) in which windows may lie."""
    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_words long, found array<struct<size:int,first:int,passage:string>>"

    def batches(stream):
        import pyarrow as pa

        inner = pa.struct([("size", pa.int32()), ("first", pa.int32()), ("passage", pa.string())])
        for batch in stream:
            raw = bytes_of(batch, "text")
            counts, found = [], []
            for low, high in chunks(raw):
                texts = raw[low:high]
                hashes, starts, ends, own = _WORDS.split(texts)
                joined = b"\n".join(texts)
                before = np.cumsum(own) - own
                chunk: list[list[dict]] = [[] for _ in texts]
                doc = np.repeat(np.arange(len(texts)), own)
                for m in maps:
                    inside = m.holds(_hashes(hashes, m.size))
                    # A shingle must not reach into the next text.
                    inside &= doc[: len(inside)] == doc[m.size - 1 :]
                    # Two texts' shingles are apart if shingles have two words or more; single words are not.
                    if m.size == 1:
                        pieces = [(b + f, b + p) for b, n in zip(before, own) for f, p in zip(*_runs(inside[b : b + n], m.least))]
                    else:
                        pieces = list(zip(*_runs(inside, m.least)))
                    for first, last in pieces:
                        last += m.size - 1
                        passage = b" ".join(joined[starts[i] : ends[i]].lower() for i in range(first, last + 1))
                        chunk[doc[first]].append({"size": m.size, "first": int(first - before[doc[first]]), "passage": passage.decode()})
                counts.append(own)
                found += chunk
            if raw:
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(np.concatenate(counts).astype(np.int64)), pa.array(found, pa.list_(inner))],
                    names=["doc_id", "n_words", "found"],
                )

    return written(rows.mapInArrow(batches, schema).withColumn("row", F.monotonically_increasing_id()))


def placed(read: DataFrame) -> DataFrame:
    """row, size, offset, text: one row per passage of a document."""
    return written(read.select("row", F.explode("found").alias("f")).select("row", "f.size", F.col("f.first").alias("offset"), F.col("f.passage").alias("text")))


def matched(places: DataFrame, windows: DataFrame, window: int = WINDOW) -> DataFrame:
    """size, text, start, past, passage: the windows in every different passage, by place in it."""
    texts = places.groupBy("size", "text").agg(F.count("*").alias("documents"))
    around = texts.withColumn("w", F.split("text", " ")).select("*", F.explode(_shingles(F.col("w"), F.col("size"))).alias("s"))
    # Beside each shingle as many words as a window around it can have, not the whole passage.
    low = F.greatest(F.col("s.place") - window, F.lit(0))
    shingles = written(
        around.select(
            "size", "text", "documents", F.col("s.shingle").alias("shingle"), F.col("s.place").alias("place"),
            low.alias("low"), F.slice("w", low + 1, F.lit(2 * window + 1)).alias("near"),
        )
    )
    rarity = shingles.groupBy("size", "shingle").agg(F.sum("documents").alias("uses"))
    of_windows = (
        windows.select("passage", "words", "size").distinct()
        .select("*", F.explode(_shingles(F.split("passage", " "), F.col("size"))).alias("s"))
        .select("passage", "words", "size", F.col("s.shingle").alias("shingle"), F.col("s.place").alias("inside"))
    )
    # A window with a shingle that no passage has occurs nowhere: its rarest is that one, and meets none.
    rarest = F.min(F.struct(F.coalesce("uses", F.lit(0)).alias("uses"), "shingle", "inside")).alias("r")
    ordered = of_windows.join(rarity, ["size", "shingle"], "left").groupBy("passage", "words", "size").agg(rarest)
    prefixes = ordered.where("r.uses > 0").select("passage", "words", "size", "r.shingle", "r.inside")
    start = F.col("place") - F.col("inside")
    words_there = F.concat_ws(" ", F.slice("near", start - F.col("low") + 1, F.col("words")))
    return written(
        shingles.join(prefixes, ["size", "shingle"])
        .where(start >= 0)
        .where(words_there == F.col("passage"))
        .select("size", "text", start.alias("start"), (start + F.col("words")).alias("past"), "passage")
    )


def _united(found: DataFrame) -> DataFrame:
    """size, text, parts: of each passage the words in any window, as places without overlap."""
    by_place = Window.partitionBy("size", "text").orderBy("start", "past")
    reached = F.max("past").over(by_place.rowsBetween(Window.unboundedPreceding, -1))
    opens = (F.col("start") > F.coalesce(reached, F.lit(-1))).cast("int")
    islands = found.select("size", "text", "start", "past").distinct().withColumn("opens", opens).withColumn("island", F.sum("opens").over(by_place))
    parts = islands.groupBy("size", "text", "island").agg(F.struct(F.min("start").alias("first"), F.max("past").alias("past")).alias("part"))
    return parts.groupBy("size", "text").agg(F.collect_list("part").alias("parts"))


def _covered(parts: Column) -> Column:
    """Words in any of the places of one document, which may overlap."""
    start = F.struct(F.lit(0).alias("reached"), F.lit(0).cast("long").alias("n"))

    def add(total: Column, part: Column) -> Column:
        fresh = F.greatest(F.lit(0), part["past"] - F.greatest(part["first"], total["reached"]))
        return F.struct(F.greatest(total["reached"], part["past"]).alias("reached"), (total["n"] + fresh).alias("n"))

    return F.aggregate(F.array_sort(parts), start, add, lambda total: total["n"])


def spans(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, item_id, first, past, passage: every place of every window of every item; ``past`` is the word after the last."""
    windows = written(item_windows(items, window, shingle))
    read = passages(docs, bitmaps(windows))
    places = placed(read)
    here = places.join(matched(places, windows, window), ["size", "text"])
    offset = F.col("offset")
    return (
        here.select("row", "passage", (offset + F.col("start")).alias("first"), (offset + F.col("past")).alias("past"))
        .join(read.select("row", "doc_id"), "row")
        .join(windows.select("passage", "item_id"), "passage")
        .select("doc_id", "item_id", "first", "past", "passage")
    )


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """One row per row: doc_id, n_words, n_hit (words in a window), item_ids (those with a window here, sorted as text)."""
    windows = written(item_windows(items, window, shingle))
    read = passages(docs, bitmaps(windows))
    places = placed(read)
    found = matched(places, windows, window)
    # Gathered for every different passage first, so a document adds a few places and items for each of its own.
    owners = found.select("size", "text", "passage").distinct().join(windows.select("passage", "item_id"), "passage")
    items_of = owners.groupBy("size", "text").agg(F.collect_set("item_id").alias("items"))
    known = written(_united(found).join(items_of, ["size", "text"]))
    moved = F.transform(
        "parts", lambda p: F.struct((p["first"] + F.col("offset")).alias("first"), (p["past"] + F.col("offset")).alias("past"))
    )
    by_row = (
        places.join(known, ["size", "text"])
        .select("row", moved.alias("parts"), "items")
        .groupBy("row")
        .agg(_covered(F.flatten(F.collect_list("parts"))).alias("n_hit"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("item_ids"))
    )
    return (
        read.select("row", "doc_id", "n_words")
        .join(by_row, "row", "left")
        .select(
            "doc_id", "n_words",
            F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
            F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        )
    )


def digests(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    return contamination(docs, items).select(
        "doc_id", "n_words", "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
