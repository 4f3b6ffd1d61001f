"""Language-model scores by a hierarchical Pitman-Yor model with Gibbs-sampled seating.

Two levels of restaurants above a uniform base over the V+1 known and unknown
tokens: one restaurant per preceding word, and the unigram restaurant, which all
of them share as parent. The first token of a text has the end of a text as its
context. The tables of every (context, token) are seated by Gibbs sampling; the
probability of a token is averaged over the ``SAMPLES`` kept samples.

How it is spread: a worker turns its texts into blocks of about ``BLOCK_BYTES``, each
the distinct words of the block, as hashes, and for every token the place of its word.
Texts are read once and never shuffled. A block sends its distinct pairs of context and
token, with their counts, to buckets by the pair's hash, as packed arrays; a bucket sums
them and gives one row per pair met more than once (never per occurrence) and sums by
token and by context. Each sweep is one pass over these rows: tables are summed by token
and by context over all rows, both sums are joined to the pairs, and all pairs are seated
again and written. A pair that was met once sits at one table in every sample, so it takes
no part but counts in the sums. The sampled rows are the model, and it grows with the
corpus. To score, each block asks the buckets for its distinct pairs, a sorted array of
hashes each, and one join for its distinct words; the answers to just these are brought
back to the block. A table or shuffle file goes when nothing needs it any more. The
driver holds only sums over all rows.

A sweep sees the tables of other pairs as they were after the sweep before (the
usual approximation of distributed Gibbs sampling); sums are exact. Chances follow
from the hashes of context and word, so scores do not depend on how rows are laid out.

Defined results: A-Z count as a-z; a null or blank text is one end token;
tokens that no training text has share the unknown entry of the base; if no row
may be learned from, all tokens are unknown; repeated rows count as often as
they are there.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import CHUNK_BYTES, Words, bytes_of, chunks, mixed, removed, shuffles_cleared, text_of, written

#: Bytes of text of a block, and bytes of text for each of which there is a bucket.
BLOCK_BYTES = BUCKET_BYTES = 24 << 20
SWEEPS, SAMPLES = 3, 2
#: Rows that are seated side by side: a seating takes as many steps as the pair with most tables needs.
SEATED_ROWS = 1 << 18
DISCOUNT, STRENGTH = 0.7, 20.0
PARENT_DISCOUNT, PARENT_STRENGTH = 0.7, 20.0
#: The hash of the end of a text, which is no word's, and the context of its first token.
END = np.uint64(0x0E4D0E4D0E4D0E4D)
_WORDS = Words()
_TABLES = [f"t{s}" for s in range(SAMPLES)]


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and context (the hash before it) of every token, ends included, and the number of tokens of each text."""
    hashes, _, _, counts = _WORDS.split(texts)
    out = np.full(len(hashes) + len(texts), END, dtype=np.uint64)
    is_word = np.ones(len(out), dtype=bool)
    is_word[np.cumsum(counts + 1) - 1] = False
    out[is_word] = hashes
    return out, np.concatenate(([END], out[:-1])), counts + 1


def _pair_key(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mixed(mixed(context) + word)


def _merged(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """One entry for each pair of context and word, with its count."""
    context, word, count = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((word, context))
    context, word, count = context[order], word[order], count[order]
    starts = np.flatnonzero(np.concatenate(([True], (context[1:] != context[:-1]) | (word[1:] != word[:-1]))))
    return context[starts], word[starts], np.add.reduceat(count, starts)


def _distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.concatenate(([True], x[1:] != x[:-1]))]


def packed(x: np.ndarray) -> bytes:
    """Whole numbers as compressed bytes, those of equal place side by side, as the high ones are mostly zero."""
    import pyarrow as pa

    places = np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.dtype.itemsize).T)
    return len(x).to_bytes(8, "little") + pa.compress(places.tobytes(), "zstd", asbytes=True)


def unpacked(data: bytes, kind: type) -> np.ndarray:
    import pyarrow as pa

    n, width = int.from_bytes(data[:8], "little"), np.dtype(kind).itemsize
    places = np.frombuffer(pa.decompress(data[8:], n * width, "zstd"), dtype=np.uint8).reshape(width, n)
    return np.ascontiguousarray(places.T).view(kind).reshape(n)


def _ascending(x: np.ndarray) -> bytes:
    return packed(np.diff(x, prepend=x.dtype.type(0)))


def _ascended(data: bytes, kind: type = np.uint64) -> np.ndarray:
    return np.cumsum(unpacked(data, kind), dtype=kind)


def kept(df: DataFrame) -> DataFrame:
    """`written`, without the shuffle files."""
    with shuffles_cleared(df.sparkSession):
        return written(df)


class Block:
    """A block's rows: sorted hashes of its distinct words, the place among them of every token, tokens of each text, and which may be learned from."""

    names = ["learn", "sizes", "words", "tokens"]

    def __init__(self, rows, at: int):
        learn, sizes, words, tokens = (rows.column(c)[at].as_py() for c in self.names)
        self.learn = unpacked(learn, np.uint8).astype(bool)
        self.sizes = unpacked(sizes, np.int64)
        self.words = _ascended(words)
        self.tokens = unpacked(tokens, np.uint32).astype(np.int64)

    def codes(self) -> np.ndarray:
        """The pair of context and word of every token, as one number."""
        end = np.searchsorted(self.words, END)
        return np.concatenate(([end], self.tokens[:-1])) * len(self.words) + self.tokens

    def pairs(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places of context and word of each code."""
        return np.divmod(code, len(self.words))

    def learned(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The distinct codes of the texts that may be learned from, sorted, and how often each is there."""
        return np.unique(code[np.repeat(self.learn, self.sizes)], return_counts=True)

    def keys(self, code: np.ndarray) -> np.ndarray:
        context, word = self.pairs(code)
        return _pair_key(self.words[context], self.words[word])


def blocks_of(rows: DataFrame) -> DataFrame:
    """block, docs, size (bytes of text) and the arrays of `Block`: one row per block of the texts of a task."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def batches(stream):
        import pyarrow as pa

        def block():
            docs = pa.concat_arrays(ids)
            words, tokens = np.unique(np.concatenate(hashes), return_inverse=True)
            columns = [pa.array([size]), pa.ListArray.from_arrays(pa.array([0, len(docs)], pa.int32()), docs)]
            arrays = [packed(np.concatenate(learn)), packed(np.concatenate(sizes)), _ascending(words), packed(tokens.astype(np.uint32))]
            return pa.RecordBatch.from_arrays([*columns, *(pa.array([x], pa.binary()) for x in arrays)], names=["size", "docs", *Block.names])

        ids, learn, hashes, sizes, size = [], [], [], [], 0
        for batch in stream:
            raw = bytes_of(batch, "text")
            for low, high in chunks(raw, min(CHUNK_BYTES, BLOCK_BYTES)):
                word, _, counts = tokens(raw[low:high])
                ids.append(batch.column("doc_id").take(pa.array(np.arange(low, high))))  # a slice would hold the texts
                learn.append(batch.column("learn").slice(low, high - low).to_numpy(zero_copy_only=False).astype(np.uint8))
                hashes.append(word)
                sizes.append(counts.astype(np.int64))
                size += sum(map(len, raw[low:high]))
                if size >= BLOCK_BYTES:
                    yield block()
                    ids, learn, hashes, sizes, size = [], [], [], [], 0
        if ids:
            yield block()

    schema = f"size long, docs array<{kind}>, " + ", ".join(f"{c} binary" for c in Block.names)
    return rows.mapInArrow(batches, schema).withColumn("block", F.monotonically_increasing_id())


def _buckets(key: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each pair; larger keys have no smaller one."""
    return ((key >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def _dealt(key: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each bucket that is asked, and the places of its keys, by key."""
    if not len(key):
        return
    order = np.argsort(key)
    bucket = _buckets(key[order], buckets)
    starts = np.flatnonzero(np.diff(bucket, prepend=np.uint64(buckets)))
    for low, high in zip(starts, [*starts[1:], len(order)], strict=True):
        yield int(bucket[low]), order[low:high]


def _messages(rows: list[tuple], names: list[str], kinds: list) -> Iterator:
    import pyarrow as pa

    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def counted(blocks: DataFrame, buckets: int) -> DataFrame:
    """of, context, word, customers, pairs: a row per pair that was met more than once in the training texts (of: pair),
    and sums of all pairs by word and by context (of: word, context), several of the same from different buckets."""
    names = ["bucket", "words", "contexts", "places", "counts"]

    def sent(stream):
        import pyarrow as pa

        for batch in stream:
            for i in range(batch.num_rows):
                block, rows = Block(batch, i), []
                code, count = block.learned(block.codes())
                context, word = block.pairs(code)
                for bucket, own in _dealt(block.keys(code), buckets):
                    own = np.sort(own)  # by context
                    used, at = np.unique(np.concatenate([context[own], word[own]]), return_inverse=True)
                    at = at.astype(np.uint32)
                    rows.append((bucket, _ascending(block.words[used]), _ascending(at[: len(own)]), packed(at[len(own) :]), packed(count[own])))
                yield from _messages(rows, names, [pa.int32(), *[pa.binary()] * 4])

    def summed(messages):
        import pyarrow as pa

        parts = []
        for words, contexts, places, counts in zip(*(messages.column(c) for c in names[1:]), strict=True):
            known = _ascended(words.as_py())
            parts.append((known[_ascended(contexts.as_py(), np.uint32)], known[unpacked(places.as_py(), np.uint32)], unpacked(counts.as_py(), np.int64)))
        context, word, customers = _merged(parts)
        again = customers > 1
        out = [("pair", context[again], word[again], customers[again], np.ones(again.sum(), dtype=np.int64))]
        for of, key in (("word", word), ("context", context)):
            key, at, pairs = np.unique(key, return_inverse=True, return_counts=True)
            total = np.zeros(len(key), dtype=np.int64)
            np.add.at(total, at, customers)
            out.append((of, key, key, total, pairs.astype(np.int64)))
        columns = [pa.array(np.concatenate(x).view(np.int64)) for x in zip(*(o[1:] for o in out), strict=True)]
        of = pa.DictionaryArray.from_arrays(np.repeat(np.arange(len(out), dtype=np.int8), [len(o[1]) for o in out]), [o[0] for o in out])
        return pa.Table.from_arrays([of.cast(pa.string()), *columns], names=["of", "context", "word", "customers", "pairs"])

    parts = blocks.select(*Block.names).mapInArrow(sent, "bucket int, words binary, contexts binary, places binary, counts binary")
    return parts.groupBy("bucket").applyInArrow(summed, "of string, context long, word long, customers long, pairs long")


def seated(customers: np.ndarray, new: np.ndarray, discount: float, seeds: np.ndarray) -> np.ndarray:
    """Tables after all customers of each dish are seated again, one by one.

    A customer opens a table with odds ``new`` against ``n - discount * t``, for
    n customers seated at t tables. Runs of customers that open none are skipped
    in one step by inverting their joint probability. ``seeds``: of each dish, all
    its chances follow from it, whatever rows lie beside it.
    """
    n, t = np.minimum(customers, 1).astype(float), np.minimum(customers, 1).astype(float)
    active, step = np.flatnonzero(customers > 1), np.uint64(0)
    while len(active):
        free = n[active] - discount * t[active]
        step += np.uint64(1)
        chance = (mixed(seeds[active] + step * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(11)) * 2.0**-53
        # P(no new table up to m customers) = (free / (free + m - n)) ** new, continued between whole numbers.
        jump = free * (np.maximum(chance, 1e-300) ** (-1 / np.maximum(new[active], 1e-3)) - 1)
        reached = n[active] + 1 + np.floor(np.minimum(jump, 1e15))
        opened = reached <= customers[active]
        n[active] = np.minimum(reached, customers[active])
        t[active[opened]] += 1
        active = active[opened & (reached < customers[active])]
    return t.astype(np.int64)


def _gathered(stream) -> Iterator:
    """The same rows in batches of ``SEATED_ROWS`` and more; none without rows."""
    import pyarrow as pa

    held: list = []
    for batch in stream:
        held.append(batch)
        if sum(b.num_rows for b in held) >= SEATED_ROWS:
            yield pa.concat_batches(held)
            held = []
    if any(b.num_rows for b in held):
        yield pa.concat_batches(held)


def _column(batch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy()


def _seeds(key: np.ndarray, sweep: int) -> np.ndarray:
    return mixed(key ^ mixed(np.array([sweep + 1], dtype=np.uint64)))


class Parent:
    """The unigram restaurant for one sample of the pairs' tables: word, customers, dishes and above (tables), and their sums."""

    def __init__(self, words: DataFrame, pairs: DataFrame, tables: str, above: float | None, sweep: int):
        """``words``, ``pairs``: as in `Model`. ``above``: tables of the unigram restaurant after the sweep before; one for each word if None."""
        dishes = kept(with_extra(words, pairs, "word", tables).select("word", "customers", F.col(tables).alias("dishes")))
        seen = dishes.agg(F.count("*").alias("v"), F.sum("customers").alias("n"), F.sum("dishes").alias("d")).first()
        self.v, self.n = seen["v"], seen["n"] or 0
        self.total = (seen["d"] or 0) + PARENT_STRENGTH
        new = self._unseen(self.v if above is None else above)

        def batches(stream):
            import pyarrow as pa

            for batch in _gathered(stream):
                word, dish = _column(batch, "word"), _column(batch, "dishes")
                tables = seated(dish, np.full(len(dish), new), PARENT_DISCOUNT, _seeds(word.view(np.uint64), sweep))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tables)], names=["word", "customers", "dishes", "above"])

        self.words = kept(dishes.mapInArrow(batches, "word long, customers long, dishes long, above long"))
        removed(dishes)
        self.above = self.words.agg(F.sum("above").alias("n")).first()["n"] or 0
        self.unseen = self._unseen(self.above)

    def _unseen(self, above: float) -> float:
        return (PARENT_STRENGTH + PARENT_DISCOUNT * above) / (self.v + 1)

    def probability(self) -> Column:
        return (F.col("dishes") - F.lit(PARENT_DISCOUNT) * F.col("above") + F.lit(float(self.unseen))) / F.lit(float(self.total))


class Model(NamedTuple):
    """What is learned: ``words`` and ``contexts`` (customers and pairs), the tables of the pairs met more than once in
    every kept sample, the unigram restaurant of each sample, and the keys of pairs met once if they are at hand."""

    words: DataFrame
    contexts: DataFrame
    pairs: DataFrame
    parents: list[Parent]
    once: DataFrame | None = None


def with_extra(sums: DataFrame, pairs: DataFrame, key: str, *tables: str) -> DataFrame:
    """Sums with the tables of all their pairs: one each, and what those met more than once have beyond it."""
    extra = pairs.groupBy(key).agg(*(F.sum(F.col(t) - 1).alias(t) for t in tables))
    total = ((F.col("pairs") + F.coalesce(t, F.lit(0).cast("long"))).alias(t) for t in tables)
    return sums.join(extra, key, "left").select(key, "customers", *total)


def totals(counts: DataFrame, key: str, pairs: Column) -> DataFrame:
    return kept(counts.groupBy(key).agg(F.sum("customers").alias("customers"), F.sum(pairs).alias("pairs")))


def sampled(counts: DataFrame) -> Model:
    """The model of pairs that are given as rows: context, word, customers."""
    words, contexts = (totals(counts, key, F.lit(1)) for key in ("word", "context"))
    return swept(words, contexts, counts.where("customers > 1"))._replace(once=counts.where("customers = 1"))


def swept(words: DataFrame, contexts: DataFrame, pairs: DataFrame) -> Model:
    """The pairs met more than once with their tables in every kept sample, and the unigram restaurant of each."""
    pairs = pairs.select("context", "word", "customers", *(F.lit(1).cast("long").alias(t) for t in _TABLES))
    names = ["context", "word", "customers", *_TABLES]
    schema = ", ".join(f"{c} long" for c in names)
    last, above, parents = _TABLES[-1], None, []
    for sweep in range(SWEEPS + 1):
        parent = Parent(words, pairs, last, above, sweep)
        above = parent.above
        parents.append(parent)
        if len(parents) > SAMPLES:
            removed(parents.pop(0).words)
        if sweep == SWEEPS:
            break
        # Written, so that Spark can split what a very common context or word has in the joins.
        seats = kept(with_extra(contexts, pairs, "context", last).select("context", F.col(last).alias("seats")))

        def batches(stream, sweep=sweep):
            import pyarrow as pa

            for batch in _gathered(stream):
                customers = _column(batch, "customers")
                key = _pair_key(_column(batch, "context").view(np.uint64), _column(batch, "word").view(np.uint64))
                new = (STRENGTH + DISCOUNT * _column(batch, "seats")) * np.minimum(_column(batch, "parent"), 1)
                tables = pa.array(seated(customers, new, DISCOUNT, _seeds(key, sweep)))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ["context", "word", "customers", *_TABLES[1:]]), tables], names=names)

        served = pairs.join(parent.words.select("word", parent.probability().alias("parent")), "word").join(seats, "context")
        before, pairs = pairs, kept(served.mapInArrow(batches, schema))
        for old in [seats, before] if sweep else [seats]:  # the first pairs are the caller's
            removed(old)
    return Model(words, contexts, pairs, parents)


def pair_answers(blocks: DataFrame, pairs: DataFrame, buckets: int) -> DataFrame:
    """block, bucket, and what the model knows of each distinct pair of the block there, by key: customers and tables by sample."""
    names = ["bucket", "block", "keys", "counts"]
    told = ["customers", *_TABLES]

    def asked(stream):
        import pyarrow as pa

        for batch in stream:
            for i in range(batch.num_rows):
                block, rows = Block(batch, i), []
                code = block.codes()
                met, (learned, n) = _distinct(code), block.learned(code)
                key, count = block.keys(met), np.zeros(len(met), dtype=np.int64)
                count[np.searchsorted(met, learned)] = n
                for bucket, own in _dealt(key, buckets):
                    rows.append((bucket, batch.column("block")[i].as_py(), _ascending(key[own]), packed(count[own])))
                yield from _messages(rows, names, [pa.int32(), pa.int64(), pa.binary(), pa.binary()])

    def keyed(stream):
        import pyarrow as pa

        for batch in stream:
            key = _pair_key(_column(batch, "context").view(np.uint64), _column(batch, "word").view(np.uint64))
            columns = [pa.array(_buckets(key, buckets).astype(np.int32)), pa.array(key.view(np.int64)), *(batch.column(t) for t in _TABLES)]
            yield pa.RecordBatch.from_arrays(columns, names=["bucket", "key", *_TABLES])

    def answered(messages, known):
        import pyarrow as pa

        keys = [_ascended(x.as_py()) for x in messages.column("keys")]
        counts = [unpacked(x.as_py(), np.int64) for x in messages.column("counts")]
        key, at = np.unique(np.concatenate(keys), return_inverse=True) if keys else (np.empty(0, np.uint64), np.empty(0, np.int64))
        customers = np.zeros(len(key), dtype=np.int64)
        parts = np.split(at, np.cumsum([len(k) for k in keys])[:-1])
        for own, count in zip(parts, counts, strict=True):
            customers[own] += count  # a block asks for a key once
        values = [customers, *(np.minimum(customers, 1) for _ in _TABLES)]
        seated_at = np.searchsorted(key, known.column("key").to_numpy().view(np.uint64))
        for t, value in zip(_TABLES, values[1:], strict=True):
            value[seated_at] = known.column(t).to_numpy()
        replies = [pa.array([packed(value[own]) for own in parts], pa.binary()) for value in values]
        return pa.Table.from_arrays([messages.column("block"), messages.column("bucket"), *replies], names=["block", "bucket", *told])

    sent = blocks.select("block", *Block.names).mapInArrow(asked, "bucket int, block long, keys binary, counts binary")
    known = pairs.select("context", "word", *_TABLES).mapInArrow(keyed, "bucket int, key long, " + ", ".join(f"{t} long" for t in _TABLES))
    schema = "block long, bucket int, " + ", ".join(f"{c} binary" for c in told)
    return sent.groupBy("bucket").cogroup(known.groupBy("bucket")).applyInArrow(answered, schema)


def word_answers(blocks: DataFrame, model: Model) -> DataFrame:
    """block, key, and what the model knows of each distinct word of the block: its count, dishes and tables above by
    sample, and customers and tables by sample of the context that it is."""
    known = model.parents[-1].words.select("word", F.col("customers").alias("n"))
    for s, parent in enumerate(model.parents):
        known = known.join(parent.words.select("word", F.col("dishes").alias(f"d{s}"), F.col("above").alias(f"a{s}")), "word")
    known = known.join(with_extra(model.contexts, model.pairs, "context", *_TABLES).withColumnRenamed("context", "word"), "word", "left").na.fill(0)

    def asked(stream):
        import pyarrow as pa

        for batch in stream:
            for words, block in zip(batch.column("words"), batch.column("block"), strict=True):
                key = _ascended(words.as_py()).view(np.int64)
                for low in range(0, len(key), 100_000):
                    own = pa.array(key[low : low + 100_000])
                    yield pa.RecordBatch.from_arrays([pa.repeat(block, len(own)), own], names=["block", "word"])

    return blocks.select("block", "words").mapInArrow(asked, "block long, word long").join(known, "word")


def score(docs: DataFrame, may_learn: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 probabilities)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(may_learn, F.lit(False)).alias("learn"), text_of(text_col).alias("text"))
    blocks = kept(blocks_of(rows))
    size = blocks.agg(F.sum("size").alias("n")).first()["n"] or 0
    buckets = max(1, -(-size // BUCKET_BYTES))
    counts = kept(counted(blocks, buckets))
    words, contexts = (totals(counts.where(F.col("of") == key), key, F.col("pairs")) for key in ("word", "context"))
    pairs = kept(counts.where("of = 'pair'").select("context", "word", "customers"))
    removed(counts)
    model = swept(words, contexts, pairs)
    replies, told = kept(pair_answers(blocks, model.pairs, buckets)), kept(word_answers(blocks, model))
    parents = model.parents
    for table in (words, contexts, pairs, model.pairs, *(p.words for p in parents)):
        removed(table)
    n, v = parents[-1].n, parents[-1].v
    unseen, total = ([getattr(p, x) for p in parents] for x in ("unseen", "total"))

    def scored(left, right):
        import pyarrow as pa

        bucket = left.column("bucket").to_numpy()
        at = int(np.flatnonzero(bucket < 0)[0])
        block, answers = Block(left, at), [i for i in np.argsort(bucket) if i != at]
        # what is known of the words, and of the contexts that they are
        key, place = np.unique(right.column("word").to_numpy().view(np.uint64), return_index=True)
        where = np.searchsorted(block.words, key)

        def of_words(name):
            out = np.zeros(len(block.words))
            out[where] = right.column(name).to_numpy()[place]
            return out

        c, customers = of_words("n"), of_words("customers")
        known, nothing = c > 0, np.array(unseen) / np.array(total)
        parent = np.stack([(of_words(f"d{s}") - PARENT_DISCOUNT * of_words(f"a{s}") + unseen[s]) / total[s] for s in range(SAMPLES)], axis=1)
        parent = np.where(known[:, None], parent, nothing)
        back = np.stack([(STRENGTH + DISCOUNT * of_words(t)) / (STRENGTH + customers) for t in _TABLES], axis=1)
        back = np.where(customers[:, None] > 0, back, 1.0)  # nobody sits in a context that was never met
        # of each distinct pair
        code, pair = np.unique(block.codes(), return_inverse=True)
        asked = np.concatenate([own for _, own in _dealt(block.keys(code), buckets)])
        met, *tables = (np.concatenate([unpacked(left.column(x)[int(i)].as_py(), np.int64) for i in answers]) for x in ["customers", *_TABLES])
        here = np.empty((len(code), SAMPLES))
        here[asked] = np.stack([met - DISCOUNT * t for t in tables], axis=1)
        context, word = block.pairs(code)
        p = np.log10((here / (STRENGTH + customers[context])[:, None] + back[context] * parent[word]).mean(axis=1))
        sizes = block.sizes
        doc = np.repeat(np.arange(len(sizes)), sizes)
        summed = lambda x: np.bincount(doc, weights=x, minlength=len(sizes))
        base = np.log10((c + 0.5) / (n + 0.5 * (v + 1)))
        columns = [
            left.column("docs")[at].values, pa.array(~block.learn), pa.array(sizes), pa.array(summed(known[block.tokens]).astype(np.int64)),
            pa.array(np.full(len(sizes), n)), pa.array(summed(base[block.tokens])), pa.array(summed(p[pair])),
        ]
        return pa.Table.from_arrays(columns, names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    asking = blocks.withColumn("bucket", F.lit(-1)).unionByName(replies, allowMissingColumns=True)
    return asking.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(scored, schema)
