"""Byte-level BPE encoding and decoding by a vocabulary file of ranks.

Two tiers. A minimal perfect hash over the vocabulary resolves every pre-token
that is itself a token. What it does not hold is merged: a heap of pair ranks
over a linked list of byte positions, so that a pre-token of n bytes costs
n log n steps however long it is. Ids are turned back into bytes by gathering
from one table of token bytes.

The work is a projection: nothing is shuffled. The tables have the size of the
vocabulary file, which is fixed; workers keep a bounded memory of pre-tokens
that they have met. Defined results: a null text counts as empty and has no
tokens; rows and other columns are independent of each other.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from heapq import heapify, heappop, heappush

import numpy as np
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import bytes_of, chunks, mixed, text_of

#: Pre-tokens in each of the two generations that a worker remembers.
REMEMBERED = 250_000
#: Longer pre-tokens are not remembered.
REMEMBERED_CHARS = 64


class PerfectHash:
    """Maps each of n keys to a slot of its own in 0..n-1, by a displacement per bucket of keys."""

    def __init__(self, keys: list[bytes]):
        self.n = n = len(keys)
        self.buckets = max(1, n // 4)
        hashes = self.hashes(keys)
        bucket = (hashes >> np.uint64(32)) % np.uint64(self.buckets)
        order = np.argsort(bucket, kind="stable")
        edges = np.searchsorted(bucket[order], np.arange(self.buckets + 1, dtype=np.uint64))
        free = np.ones(n, dtype=bool)
        self.shift = np.zeros(self.buckets, dtype=np.int64)
        self.key_at = np.zeros(n, dtype=np.int64)
        sizes = np.diff(edges)
        for b in np.argsort(-sizes, kind="stable"):
            own = order[edges[b] : edges[b + 1]]
            if len(own) <= 1:
                break
            base, low = hashes[own], 0
            while True:
                tried = np.arange(low, low + 256, dtype=np.uint64)
                slots = self._slots(base[None, :], tried[:, None])
                fits = free[slots].all(axis=1)
                for t in np.flatnonzero(fits):
                    if len(set(slots[t].tolist())) == len(own):
                        break
                else:
                    low += 256
                    continue
                self.shift[b], self.key_at[slots[t]], free[slots[t]] = tried[t], own, False
                break
        # Buckets of one key name their slot outright.
        left = iter(np.flatnonzero(free))
        for b in np.flatnonzero(sizes == 1):
            slot = next(left)
            self.shift[b], self.key_at[slot] = -1 - slot, order[edges[b]]

    @staticmethod
    def hashes(keys: list[bytes]) -> np.ndarray:
        digest = xxhash.xxh3_64_intdigest
        return np.fromiter(map(digest, keys), dtype=np.uint64, count=len(keys))

    def _slots(self, hashes: np.ndarray, shift: np.ndarray) -> np.ndarray:
        return (mixed(hashes + shift * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(self.n)).astype(np.int64)

    def lookup(self, keys: list[bytes]) -> np.ndarray:
        """The one key index that each of these could have; the caller compares the bytes."""
        hashes = self.hashes(keys)
        shift = self.shift[((hashes >> np.uint64(32)) % np.uint64(self.buckets)).astype(np.int64)]
        slots = np.where(shift < 0, -1 - shift, self._slots(hashes, np.maximum(shift, 0).astype(np.uint64)))
        return self.key_at[slots]


def read_ranks(path: str) -> list[bytes]:
    """Token bytes by id, from a file of lines 'base64 id' on the driver."""
    with open(path, "rb") as lines:
        ranks = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, lines)}
    return [ranks[i] for i in range(len(ranks))]


class Gather:
    """Joins the entries of a table that a list of ids names, without a loop over the ids."""

    def __init__(self, entries: list[bytes]):
        self.lengths = np.fromiter(map(len, entries), dtype=np.int64, count=len(entries))
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.table = np.frombuffer(b"".join(entries), dtype=np.uint8)

    def __call__(self, ids: np.ndarray) -> bytes:
        widths = self.lengths[ids]
        ends = np.cumsum(widths)
        shift = np.repeat(self.starts[ids] - (ends - widths), widths)
        return self.table[np.arange(len(shift)) + shift].tobytes()


class Codec:
    def __init__(self, tokens: list[bytes], pattern: str, perfect: PerfectHash | None = None):
        self.tokens = tokens
        self.pieces = regex.compile(pattern).findall
        self.perfect = perfect or PerfectHash(tokens)
        rank = {token: i for i, token in enumerate(tokens)}
        self.byte_ids = [rank[bytes([b])] for b in range(256)]
        self.pairs = {
            rank[token[:cut]] << 32 | rank[token[cut:]]: i
            for token, i in rank.items() for cut in range(1, len(token)) if token[:cut] in rank and token[cut:] in rank
        }
        self.recent: dict[str, bytes] = {}
        self.earlier: dict[str, bytes] = {}
        self.decode = Gather(tokens)
        self.decimal = Gather([b"%d " % i for i in range(len(tokens))])

    def merged(self, piece: bytes) -> list[int]:
        """The ids of a pre-token that is no token: always the lowest ranked pair first, then the leftmost."""
        pairs, ids, n = self.pairs, [self.byte_ids[b] for b in piece], len(piece)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [r << 32 | i for i in range(n - 1) if (r := pairs.get(ids[i] << 32 | ids[i + 1])) is not None]
        heapify(heap)
        while heap:
            top = heappop(heap)
            new, i = top >> 32, top & 0xFFFFFFFF
            j = after[i]
            if ids[i] < 0 or j >= n or pairs.get(ids[i] << 32 | ids[j]) != new:
                continue  # an end of this pair has been merged meanwhile
            ids[i], ids[j] = new, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := pairs.get(new << 32 | ids[k])) is not None:
                    heappush(heap, r << 32 | i)
            if (h := before[i]) >= 0 and (r := pairs.get(ids[h] << 32 | new)) is not None:
                heappush(heap, r << 32 | h)
        return [x for x in ids if x >= 0]

    def resolve(self, pieces: set[str]) -> dict[str, bytes]:
        """The ids of each pre-token as packed 32-bit numbers."""
        names = list(pieces)
        raw = [x.encode() for x in names]
        tokens, merged = self.tokens, self.merged
        return {
            name: array("I", (i,) if tokens[i] == piece else merged(piece)).tobytes()
            for name, piece, i in zip(names, raw, self.perfect.lookup(raw).tolist(), strict=True)
        }

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        split = [self.pieces(text) for text in texts]
        met = set().union(*split)
        new = {x: self.recent[x] for x in met if x in self.recent}
        older = {x: self.earlier[x] for x in met if x not in new and x in self.earlier}
        found = self.resolve({x for x in met if x not in new and x not in older})
        self.recent.update(older)
        self.recent.update((k, v) for k, v in found.items() if len(k) <= REMEMBERED_CHARS)
        if len(self.recent) > REMEMBERED:
            self.earlier, self.recent = self.recent, {}
        get = {**new, **older, **found}.__getitem__
        return [np.frombuffer(b"".join(map(get, pieces)), dtype=np.uint32) for pieces in split]


_codecs: dict[str, Codec] = {}


def _codec(key: str, shared) -> Codec:
    """This worker's codec; its tables are built once from the broadcast vocabulary."""
    if key not in _codecs:
        _codecs.clear()
        tokens, pattern, perfect = shared.value
        _codecs[key] = Codec(tokens, pattern, perfect)
    return _codecs[key]


def _shared(df: DataFrame, path: str, pattern: str):
    tokens = read_ranks(path)
    key = hashlib.sha256(b"\0".join(tokens) + pattern.encode()).hexdigest()
    return key, df.sparkSession.sparkContext.broadcast((tokens, pattern, PerfectHash(tokens)))


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: doc_id and ids, the token ids of the whole text."""
    key, shared = _shared(docs, path, pattern)

    def batches(stream):
        import pyarrow as pa

        for batch in stream:
            codec, raw = _codec(key, shared), bytes_of(batch, "text")
            for low, high in chunks(raw):
                ids = codec.encode([x.decode() for x in raw[low:high]])
                edges = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
                values = np.concatenate(ids).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(low, high - low), pa.ListArray.from_arrays(pa.array(edges), pa.array(values))],
                    names=["doc_id", "ids"],
                )

    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(batches, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """One row per row of ``doc_id, ids``: doc_id, text."""
    key, shared = _shared(encoded, path, pattern)

    def batches(stream):
        import pyarrow as pa

        for batch in stream:
            decoded = _codec(key, shared).decode
            texts = [decoded(np.asarray(x.values)).decode("utf-8", "replace") if x.is_valid else "" for x in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    rows = encoded.select("doc_id", "ids")
    return rows.mapInArrow(batches, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text string")


def digests(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode every text and keep digests: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    key, shared = _shared(docs, path, pattern)

    def batches(stream):
        import pyarrow as pa

        sha = hashlib.sha256
        for batch in stream:
            codec, raw, rows = _codec(key, shared), bytes_of(batch, "text"), []
            for low, high in chunks(raw):
                for ids in codec.encode([x.decode() for x in raw[low:high]]):
                    rows.append((len(ids), sha(codec.decimal(ids)[:-1]).hexdigest(), sha(codec.decode(ids)).hexdigest()))
            n, ids_sha, decoded_sha = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(decoded_sha, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(batches, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def round_trip(docs: DataFrame, path: str, pattern: str, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` with every text encoded and decoded again; a null text stays null."""
    key, shared = _shared(docs, path, pattern)

    def batches(stream):
        import pyarrow as pa

        for batch in stream:
            codec, raw, texts = _codec(key, shared), bytes_of(batch, text_col), []
            for low, high in chunks(raw):
                texts += [codec.decode(ids).decode() for ids in codec.encode([x.decode() for x in raw[low:high]])]
            at = batch.schema.get_field_index(text_col)
            told = batch.column(at).is_valid().to_pylist()
            column = pa.array([x if ok else None for x, ok in zip(texts, told, strict=True)], batch.column(at).type)
            yield batch.set_column(at, batch.schema.field(at), column)

    return docs.mapInArrow(batches, docs.schema)
