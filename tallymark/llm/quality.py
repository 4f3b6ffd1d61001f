"""Quality of documents by weak labels: heuristics vote, EM weighs them, a hashed linear scorer generalises.

Eight overlapping heuristics each call a text junk or fine, or abstain. How
often they are right is estimated without labels, by expectation-maximisation
over the counts of vote patterns: there are at most 3^8 patterns, whatever the
number of documents, and all documents are counted. The posterior of a text's
pattern is the soft label by which a logistic scorer over hashed byte and word
events is trained, on a sample of ``SAMPLE`` documents chosen by hash. The
scorer judges every whole text; the votes themselves decide nothing.

Nothing but pattern counts is shuffled. Defined results: a text that is null or
has fewer than ``LEAST_WORDS`` words is kept with the score of the prior; repeated
rows and other columns have no influence on each other.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import Words, bytes_of, chunks, hand_out_few, mixed, text_of

#: Documents, chosen by the hash of their text, that the scorer is trained on.
SAMPLE = 4000
SLOTS = 1024
#: Texts with fewer words are not judged but kept.
LEAST_WORDS = 5
#: The label model takes no heuristic to call fine texts junk more often than this.
MOST_FALSE_ALARMS = 0.002
#: A text goes when it is junk with this probability.
JUNK_FROM = 0.7
VOTERS = 8
ABSTAIN, FINE, JUNK = 0, 1, 2
#: Share from which a heuristic says junk, share up to which it says fine, least number of things counted.
SYMBOLS = (0.08, 0.02, 10)
CAPITALS = (0.30, 0.15, 20)
REPEATED_WORDS = (0.15, 0.04, 8)
FEW_DISTINCT = (0.70, 0.50, 20)
SYMBOL_ENDINGS = (0.20, 0.05, 5)
BARE_SYMBOLS = (0.10, 0.03, 5)
REPEATED_LINES = (0.50, 0.20, 4)
NO_LETTERS = (0.30, 0.15, 10)

_WORDS = Words()
_SYMBOL = np.isin(np.arange(256), list(b"*#$%&|!<>=_~^\\@{}[]"))
_UPPER = (np.arange(256) >= 65) & (np.arange(256) <= 90)
_LOWER = (np.arange(256) >= 97) & (np.arange(256) <= 122)
_LETTER = _UPPER | _LOWER | (np.arange(256) >= 128)
_KIND = np.select([_UPPER, _LOWER, np.arange(256) >= 128, (np.arange(256) >= 48) & (np.arange(256) <= 57), _SYMBOL], [1, 2, 3, 4, 5], 0)


class Measured:
    """What the heuristics and the scorer see of a chunk of texts, as arrays."""

    def __init__(self, texts: list[bytes]):
        self.n = n = len(texts)
        self.hashes, starts, ends, self.words = _WORDS.split(texts)
        self.buffer = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
        self.lengths = np.fromiter(map(len, texts), dtype=np.int64, count=n) + 1
        self.byte_doc = np.repeat(np.arange(n), self.lengths)
        self.word_doc = np.repeat(np.arange(n), self.words)
        same = np.zeros(len(starts), dtype=bool)
        if len(starts) > 1:
            same[1:] = (self.hashes[1:] == self.hashes[:-1]) & (self.word_doc[1:] == self.word_doc[:-1])
        self.same = same
        self.first, self.last = _KIND[self.buffer[starts]], _KIND[self.buffer[ends - 1]]
        self.raw_last, self.widths = self.buffer[ends - 1], ends - starts
        uppers = np.concatenate(([0], np.cumsum(_UPPER[self.buffer])))
        self.capital = (uppers[ends] - uppers[starts] > 1).astype(np.int64)

    def per_byte(self, table: np.ndarray) -> np.ndarray:
        return np.bincount(self.byte_doc, weights=table[self.buffer], minlength=self.n)

    def per_word(self, flags: np.ndarray) -> np.ndarray:
        return np.bincount(self.word_doc, weights=flags, minlength=self.n)

    def distinct_words(self) -> np.ndarray:
        order = np.lexsort((self.hashes, self.word_doc))
        h, d = self.hashes[order], self.word_doc[order]
        new = np.ones(len(h), dtype=bool)
        new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
        return np.bincount(d[new], minlength=self.n)

    def events(self) -> tuple[np.ndarray, np.ndarray]:
        """Slots of the word events and of the byte values; the scorer takes the mean weight of each."""
        shape = (((self.first * 6 + self.last) * 2 + self.capital) * 2 + self.same) * 4 + np.minimum(self.widths - 1, 3)
        slot = lambda code: (mixed(code.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(SLOTS)).astype(np.int64)
        return slot(shape + 1000), slot(np.arange(256))


def _vote(share: np.ndarray, counted: np.ndarray, limits: tuple[float, float, int]) -> np.ndarray:
    junk, fine, least = limits
    return np.where(counted < least, ABSTAIN, np.where(share >= junk, JUNK, np.where(share <= fine, FINE, ABSTAIN)))


def votes(texts: list[bytes]) -> np.ndarray:
    """One row per text with the vote of each heuristic."""
    m = Measured(texts)
    words, dense = np.maximum(m.words, 1), m.per_byte(_WORDS.is_word.astype(float))
    letters, cased = m.per_byte(_LETTER.astype(float)), m.per_byte((_UPPER | _LOWER).astype(float))
    filled = np.maximum(dense, 1)
    lines, again = np.zeros(m.n), np.zeros(m.n)
    for i, text in enumerate(texts):
        own = [x for x in text.split(b"\n") if x.strip()]
        lines[i], again[i] = len(own), len(own) - len(set(own))
    symbol_end = m.per_word((m.last == 5).astype(float))
    bare = m.per_word(((m.last == 5) & (m.widths == 1)).astype(float))
    found = [
        _vote(m.per_byte(_SYMBOL.astype(float)) / filled, dense, SYMBOLS),
        _vote(m.per_byte(_UPPER.astype(float)) / np.maximum(cased, 1), cased, CAPITALS),
        _vote(m.per_word(m.same) / words, m.words, REPEATED_WORDS),
        _vote(1 - m.distinct_words() / words, m.words, FEW_DISTINCT),
        _vote(symbol_end / words, m.words, SYMBOL_ENDINGS),
        _vote(bare / words, m.words, BARE_SYMBOLS),
        _vote(again / np.maximum(lines, 1), lines, REPEATED_LINES),
        _vote(1 - letters / filled, dense, NO_LETTERS),
    ]
    return np.where(m.words[:, None] > 0, np.stack(found, axis=1), ABSTAIN)


class LabelModel:
    """How each heuristic votes on junk and on fine texts, estimated by EM from counts of vote patterns."""

    def __init__(self, patterns: np.ndarray, counts: np.ndarray, rounds: int = 100):
        junk = np.where((patterns == JUNK).any(axis=1), 0.9, 0.05)
        self.prior, self.says = 0.1, np.full((2, VOTERS, 3), 1 / 3)
        for _ in range(rounds if len(counts) else 0):
            weights = np.stack([counts * (1 - junk), counts * junk])
            self.prior = float(np.clip(weights[1].sum() / counts.sum(), 1e-3, 0.5))
            hits = np.stack([(weights[:, :, None] * (patterns == vote)[None]).sum(axis=1) for vote in (ABSTAIN, FINE, JUNK)], axis=2)
            self.says = (hits + 0.1) / (hits.sum(axis=2, keepdims=True) + 0.3)
            self.says[0, :, JUNK] = np.minimum(self.says[0, :, JUNK], MOST_FALSE_ALARMS)
            self.says /= self.says.sum(axis=2, keepdims=True)
            junk = self.posterior(patterns)

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """The probability that a text with these votes is junk."""
        told = np.log(self.says)[:, np.arange(VOTERS)[None], patterns].sum(axis=2)
        return 1 / (1 + np.exp(np.clip(told[0] - told[1] + np.log((1 - self.prior) / self.prior), -500, 500)))


def features(texts: list[bytes]) -> np.ndarray:
    """One row per text: mean counts of hashed word events and byte values."""
    m = Measured(texts)
    word_slots, byte_slots = m.events()
    by_word = np.bincount(m.word_doc * SLOTS + word_slots, minlength=m.n * SLOTS).reshape(m.n, SLOTS) / np.maximum(m.words, 1)[:, None]
    by_byte = np.bincount(m.byte_doc * SLOTS + byte_slots[m.buffer], minlength=m.n * SLOTS).reshape(m.n, SLOTS) / m.lengths[:, None]
    return (by_word + by_byte).astype(np.float32)


def fit(x: np.ndarray, junk: np.ndarray, steps: int = 1000, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels, by Adam over the whole sample."""
    w, b = np.zeros(x.shape[1]), 0.0
    m, v = np.zeros(x.shape[1] + 1), np.zeros(x.shape[1] + 1)
    for t in range(1, steps + 1 if len(x) else 0):
        error = 1 / (1 + np.exp(-(x @ w + b))) - junk
        gradient = np.append(x.T @ error / len(x) + decay * w, error.mean())
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        step = 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
        w, b = w - step[:-1], b - step[-1]
    return w, float(b)


class Scorer:
    def __init__(self, weights: np.ndarray, bias: float, prior: float):
        self.weights, self.bias, self.prior = weights, bias, prior

    def junk(self, texts: list[bytes]) -> np.ndarray:
        m = Measured(texts)
        word_slots, byte_slots = m.events()
        score = self.bias + m.per_word(self.weights[word_slots]) / np.maximum(m.words, 1) + m.per_byte(self.weights[byte_slots]) / m.lengths
        return np.where(m.words < LEAST_WORDS, self.prior, 1 / (1 + np.exp(-np.clip(score, -500, 500))))


def _patterns(rows: DataFrame) -> DataFrame:
    def batches(stream):
        import pyarrow as pa

        for batch in stream:
            raw = bytes_of(batch, "text")
            for low, high in chunks(raw):
                yield pa.RecordBatch.from_arrays([pa.array(votes(raw[low:high]) @ 3 ** np.arange(VOTERS), pa.int64())], names=["pattern"])

    return rows.mapInArrow(batches, "pattern long")


def train(docs: DataFrame, text_col: str = "text", sample: int = SAMPLE) -> Scorer:
    """The label model of all documents and the scorer of a sample of them."""
    texts = docs.select(text_of(text_col).alias("text"))
    counted = _patterns(texts).groupBy("pattern").count().collect()  # at most 3^8 rows
    patterns = np.array([[r["pattern"] // 3**k % 3 for k in range(VOTERS)] for r in counted], dtype=np.int64).reshape(-1, VOTERS)
    counts = np.array([r["count"] for r in counted], dtype=float)
    model = LabelModel(patterns, counts)
    span = 1 << 30
    share = min(1.0, sample / max(counts.sum(), 1))
    chosen = texts.where(F.pmod(F.xxhash64("text"), F.lit(span)) < int(span * share))

    def batches(stream):
        import pyarrow as pa

        for batch in stream:
            raw = [x for x in bytes_of(batch, "text") if x.strip()]
            for low, high in chunks(raw):
                x, junk = features(raw[low:high]), model.posterior(votes(raw[low:high]))
                yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in x], pa.binary()), pa.array(junk)], names=["x", "junk"])

    # About ``sample`` rows; a text with very many copies counts once, so that it cannot outweigh the others.
    rows = chosen.distinct().mapInArrow(batches, "x binary, junk double").collect()
    x = np.stack([np.frombuffer(r["x"], dtype=np.float32) for r in rows]).astype(float) if rows else np.zeros((0, SLOTS))
    return Scorer(*fit(x, np.array([r["junk"] for r in rows])), prior=model.prior)


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE, junk_from: float = JUNK_FROM) -> DataFrame:
    """One row per row: doc_id, row (all columns), score (1: fine, 0: junk), kept."""
    hand_out_few(docs.sparkSession)
    scorer = train(docs, text_col, sample)
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), text_of(text_col).alias("text")
    )

    def scores(stream):
        import pandas as pd

        for texts in stream:
            raw = [x.encode() for x in texts]
            yield pd.Series(np.concatenate([scorer.junk(raw[low:high]) for low, high in chunks(raw)]) if raw else [], dtype=float)

    junk = F.pandas_udf(scores, "double", F.PandasUDFType.SCALAR_ITER)
    return rows.withColumn("junk", junk("text")).select("doc_id", "row", (1 - F.col("junk")).alias("score"), (F.col("junk") < junk_from).alias("kept"))
