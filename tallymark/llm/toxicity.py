"""Toxicity by a counterfactual-regularised classifier.

A text is the set of its hashed words and word beginnings. A logistic model is
trained on a bounded sample of labelled rows; for every training text in which
a group of people is named, the names are swapped for those of other groups,
and the squared change of the score is added to the loss. So a mention alone
cannot carry weight, and neutral mentions raise no alarm.

The score is calibrated on the training rows, by models that have not seen
them, so that 0.3 is the cut. Texts are
read once to train (sampled rows only are collected) and once to score; nothing
is shuffled but the sample. Defined results: a null
or empty text has the lowest evidence and the score of the bias; rows of labels
without text, or with a null label, are not trained on; an id, or a text of the
sample, with both labels counts as toxic; if no labelled row is
left every text gets score 0; repeated rows and other columns have no influence.
Rows that may not be learned from have no part in counts, sample or calibration.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import Words, bytes_of, chunks, mixed, text_of

#: Labelled rows that are trained on, chosen by hash: about so many toxic and so many other ones.
SAMPLE = 2000
SUPPORT = 4
FOLDS = 3
SLOTS = 1 << 18
BEGINNINGS = (4, 5, 6)
CUT = 0.3
PENALTY = 1.0
#: Names of groups of people; each row is swapped within itself.
IDENTITIES = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("gay", "straight", "lesbian", "bisexual", "trans"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("immigrants", "refugees", "citizens", "locals"),
    ("old", "young", "disabled", "blind", "deaf"),
    ("frauen", "männer"), ("muslime", "christen", "juden"), ("ausländer", "einwanderer", "deutsche"),
    ("femmes", "hommes"), ("musulmans", "chrétiens", "juifs"), ("immigrés", "français"),
    ("mujeres", "hombres"), ("musulmanes", "cristianos", "judíos"), ("inmigrantes", "españoles"),
)
#: Words: letters and digits; bytes above 127 belong to words.
_WORDS = Words(bytes(b for b in range(128) if not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122)))


def _slots(hashes: np.ndarray) -> np.ndarray:
    return (mixed(hashes) % np.uint64(SLOTS)).astype(np.int64)


def events(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Text and slot of each distinct hashed word and word beginning (in bytes)."""
    hashes, starts, ends, counts = _WORDS.split(texts)
    doc = np.repeat(np.arange(len(texts)), counts)
    buffer = np.frombuffer(b"\n".join(texts) + b"\n" + b" " * max(BEGINNINGS), dtype=np.uint8)
    slots, owners = [_slots(hashes)], [doc]
    value = np.zeros(len(starts), dtype=np.uint64)
    for i in range(max(BEGINNINGS)):
        value = (value + _WORDS.values[buffer[starts + i]]) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(i)
        if i + 1 in BEGINNINGS:
            long = ends - starts > i + 1
            slots.append(_slots(value[long]))
            owners.append(doc[long])
    key = np.unique(np.concatenate(owners) * SLOTS + np.concatenate(slots))
    return key // SLOTS, key % SLOTS


def swapped(text: str) -> list[str]:
    """The text with the group names of each kind that it holds swapped, in turn, for the others of that kind."""
    import regex

    out = []
    for names in IDENTITIES:
        found = regex.compile(r"\b(" + "|".join(names) + r")\b", regex.I)
        place = {name.casefold(): i for i, name in enumerate(names)}

        def other(m, k: int, names=names, place=place) -> str:
            # Case folds more letters together than there are names: what is none stays.
            at = place.get(m[0].casefold())
            return m[0] if at is None else names[(at + k) % len(names)]

        if any(m[0].casefold() in place for m in found.finditer(text)):
            out += [found.sub(lambda m, k=k, other=other: other(m, k), text) for k in range(1, len(names))]
    return out


class Model:
    """Sparse logistic regression over presence of slots, with the counterfactual penalty."""

    def __init__(self, texts: list[str], labels: list[int], plain: float = 1.0):
        """``plain``: labelled rows that each sampled row with label 0 stands for."""
        self.slots, self.weights, self.bias, self.shift = np.zeros(0, dtype=np.int64), np.zeros(0), 0.0, 0.0
        y = np.array(labels, dtype=float)
        if not len(y):
            return
        raw = [t.encode() for t in texts]
        pairs = [(i, v) for i, t in enumerate(texts) for v in swapped(t)]
        base = np.array([i for i, _ in pairs], dtype=np.int64)
        doc, slot = self._events(raw + [v.encode() for _, v in pairs])
        # A slot that few texts have can only be learned by heart.
        seen, slot, support = np.unique(slot, return_inverse=True, return_counts=True)
        told = support[slot] >= SUPPORT
        doc, slot = doc[told], slot[told]
        fold = np.arange(len(y)) % FOLDS
        z = np.zeros(len(y))
        for k in range(FOLDS):
            w, b = self._fit(doc, slot, len(seen), y, base, fold != k)
            z = np.where(fold == k, np.bincount(doc, weights=w[slot], minlength=len(y) + len(base))[: len(y)] + b, z)
        w, self.bias = self._fit(doc, slot, len(seen), y, base, np.ones(len(y), dtype=bool))
        self.slots, self.weights = seen[w != 0], w[w != 0]
        self._calibrate(z, y, plain)

    @staticmethod
    def _fit(doc: np.ndarray, slot: np.ndarray, width: int, y: np.ndarray, base: np.ndarray, used: np.ndarray, steps: int = 150, decay: float = 3e-4):
        """Weights and bias by Adam over the ``used`` texts and their swapped versions."""
        n, total = len(y), len(y) + len(base)
        share, paired = used / max(used.sum(), 1), used[base] / max(used.sum(), 1)
        w, b = np.zeros(width), 0.0
        m, v = np.zeros(width + 1), np.zeros(width + 1)
        for t in range(1, steps + 1):
            z = np.bincount(doc, weights=w[slot], minlength=total) + b
            pull = np.zeros(total)
            pull[:n] = (1 / (1 + np.exp(-np.clip(z[:n], -50, 50))) - y) * share
            change = PENALTY * (z[n:] - z[base]) * paired
            pull[n:] += change
            np.add.at(pull, base, -change)
            gradient = np.append(np.bincount(slot, weights=pull[doc], minlength=width) + decay * w, pull[:n].sum())
            m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
            step = 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
            w, b = w - step[:-1], b - step[-1]
        return w, float(b)

    @staticmethod
    def _events(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        docs, slots = [], []
        for low, high in chunks(raw):
            d, s = events(raw[low:high])
            docs.append(d + low)
            slots.append(s)
        return np.concatenate(docs), np.concatenate(slots)

    def _calibrate(self, z: np.ndarray, y: np.ndarray, plain: float) -> None:
        """Move the scores so that the cut lies where rows that a model was not trained on are told apart best."""
        order = np.argsort(-z, kind="stable")
        hits, alarms = np.cumsum(y[order]), np.cumsum(1 - y[order]) * plain
        best = int(np.argmax(2 * hits / (hits + alarms + y.sum())))  # the F1 score over all labelled rows
        low = z[order[best + 1]] if best + 1 < len(z) else z[order[best]] - 1
        self.shift = float(np.log(CUT / (1 - CUT)) - (0.5 * z[order[best]] + 0.5 * low))

    def scores(self, texts: list[bytes]) -> np.ndarray:
        if not len(self.slots):
            return np.zeros(len(texts))
        doc, slot = events(texts)
        at = np.minimum(np.searchsorted(self.slots, slot), len(self.slots) - 1)
        known = self.slots[at] == slot
        z = np.bincount(doc[known], weights=self.weights[at[known]], minlength=len(texts)) + self.bias + self.shift
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def train(docs: DataFrame, labels: DataFrame, may_train: Column, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Model:
    """``labels``: id and toxic (0 or 1). ``may_train``: of which rows of ``docs`` labels may be learned."""
    own = docs.where(may_train).select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    told = labels.where("toxic in (0, 1)").groupBy(F.col(id_col).alias("labelled")).agg(F.max("toxic").alias("y"))
    # Only narrow ids are joined; labels of other rows are not even counted.
    told = told.join(own.select("id").distinct(), F.col("id") == F.col("labelled"), "left_semi")
    counts = {r["y"]: r["count"] for r in told.groupBy("y").count().collect()}
    span = 1 << 30
    limit = lambda y: int(span * min(1.0, sample / max(counts.get(y, 0), 1)))
    chosen = told.where(F.pmod(F.xxhash64("labelled"), F.lit(span)) < F.when(F.col("y") == 1, limit(1)).otherwise(limit(0)))
    # The sample is bounded by its parameter, so it is sent to the texts and not the texts to it.
    rows = own.join(F.broadcast(chosen), F.col("id") == F.col("labelled")).select("text", "y").distinct().collect()  # about 2 * sample rows
    labelled: dict[str, int] = {}
    for r in rows:
        labelled[r["text"]] = max(r["y"], labelled.get(r["text"], 0))
    rows = sorted(labelled.items())
    return Model([t for t, _ in rows], [y for _, y in rows], max(1.0, counts.get(0, 0) / sample) / max(1.0, counts.get(1, 0) / sample))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: doc_id, score, predicted."""

    def batches(stream):
        import pyarrow as pa

        for batch in stream:
            raw = bytes_of(batch, "text")
            found = np.concatenate([model.scores(raw[low:high]) for low, high in chunks(raw)]) if raw else np.zeros(0)
            predicted = pa.array((found >= CUT).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.float64()), predicted], names=["doc_id", "score", "predicted"])

    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(batches, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double, predicted int")
