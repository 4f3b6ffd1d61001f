"""Whitening of embeddings by a covariance from variances of single and paired dimensions (polarisation).

Components become whole numbers x = floor(scale * c) + shift. With n vectors and
sums S, the centred values n * x - S are whole numbers too. Added up exactly are
their squares, for every dimension and for the sum of every two dimensions; since
var(a + b) - var(a) - var(b) = 2 cov(a, b), the differences are all covariances,
exact until they are divided. The matrix goes to ``eigh``; rows are projected.

How it is spread: three passes over the vectors (sums, squares, the check of the
result) and one projection, all without shuffling a vector: a task sends one row
per dimension or pair of dimensions. The driver holds matrices of dimension by
dimension, whatever the number of rows. Squares are added as limbs of 24 bits,
which no number of rows overflows, and joined as Python integers.

Defined results: vectors that are null, empty, hold a null or non-finite component,
or one whose x is beyond 2^62, take no part and get no rows; of vectors of several
lengths the most frequent length counts (the longest of equally frequent ones);
components whose eigenvalue is not above rounding (1e-12 of the largest) cannot be
scaled to one and are left out, so a single vector or equal vectors give no rows;
repeated rows and ids count once each; an empty table gives no rows; a deviation
beyond 38 digits is null; the largest entry of each component is positive.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 32
#: Rows that are worked on at a time: so many squares of 24 bits add up in 64.
ROWS = 4096
_LIMB = 24
_SAFE = 2.0**62


class Fit(NamedTuple):
    """``vectors``: components by dimensions, of length one. ``values``: their eigenvalues, falling."""

    n: int
    sums: list[int]
    covariance: np.ndarray
    vectors: np.ndarray
    values: np.ndarray
    share: np.ndarray


def _usable(batch, name: str, size: int | None = None):
    """Row numbers and scaled whole components of the vectors of a batch that take part, by length."""
    column = batch.column(name)
    offsets = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False).astype(np.float64)  # nulls become nan
    lengths = np.diff(offsets)
    there = column.is_valid().to_numpy(zero_copy_only=False) & (lengths > 0)
    for length in np.unique(lengths[there]) if size is None else [size]:
        rows = np.flatnonzero(there & (lengths == length))
        if len(rows):
            with np.errstate(over="ignore", invalid="ignore"):
                x = np.floor(SCALE * flat[offsets[rows][:, None] + np.arange(length)])
            good = (np.abs(x) < _SAFE).all(axis=1)  # false for nan and infinity too
            if good.any():
                yield rows[good], x[good].astype(np.int64) + SHIFT


def _limbs(value: int) -> list[int]:
    """A whole number as limbs of 48 bits, the last with the sign."""
    out = []
    while not -(1 << 47) <= value < 1 << 47:
        out.append(value & ((1 << 48) - 1))
        value >>= 48
    return [*out, value]


def _record(pa, keys: list[tuple[int, int]], totals: list[int]):
    rows = [(a, b, k, limb) for (a, b), total in zip(keys, totals, strict=True) for k, limb in enumerate(_limbs(total))]
    names = ["a", "b", "limb", "value"]
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[i]) for i in range(4)], names=names)


_KEYED = "a int, b int, limb int, value long"


def _totals(parts: DataFrame) -> dict[tuple[int, int], int]:
    """Whole sums of a and b, from the limbs that the tasks sent; as many rows as there are keys and limbs."""
    summed = parts.groupBy("a", "b", "limb").agg(F.sum(F.col("value").cast("decimal(20,0)")).alias("value"))
    found: dict[tuple[int, int], int] = {}
    for r in summed.collect():
        found[r["a"], r["b"]] = found.get((r["a"], r["b"]), 0) + (int(r["value"]) << (48 * r["limb"]))
    return found


def sums(vectors: DataFrame, column: str) -> tuple[int, list[int]]:
    """Number of vectors of the most frequent length that take part, and the sum of each dimension."""

    def batches(stream):
        import pyarrow as pa

        found: dict[int, list[int]] = {}
        for batch in stream:
            for rows, x in _usable(batch, column):
                for low in range(0, len(x), ROWS):
                    own = found.setdefault(x.shape[1], [0] * (x.shape[1] + 1))
                    own[0] += len(x[low : low + ROWS])
                    # High and low halves, so that no sum overflows.
                    high, rest = x[low : low + ROWS] >> 31, x[low : low + ROWS] & ((1 << 31) - 1)
                    for i, (h, r) in enumerate(zip(high.sum(axis=0).tolist(), rest.sum(axis=0).tolist(), strict=True), 1):
                        own[i] += (h << 31) + r
        for size, own in found.items():
            yield _record(pa, [(size, i) for i in range(size + 1)], own)

    found = _totals(vectors.select(column).mapInArrow(batches, _KEYED))
    sizes = {size: n for (size, i), n in found.items() if i == 0}
    if not sizes:
        return 0, []
    size = max(sizes, key=lambda s: (sizes[s], s))
    return sizes[size], [found[size, i] for i in range(1, size + 1)]


def _centred(x: np.ndarray, n: int, own: list[int]) -> np.ndarray:
    """n * x - S, as 64-bit numbers where they and sums of two of them fit, else as Python integers."""
    middle = [s // n for s in own]
    left = np.array([s - n * m for s, m in zip(own, middle, strict=True)], dtype=object)  # 0 <= left < n
    if max(abs(m) for m in middle) < 1 << 62:
        near = x - np.array(middle, dtype=np.int64)
        if float(np.abs(near.astype(np.float64)).max()) * n + n < 2.0**61:
            return near * n - left.astype(np.int64)
    return x.astype(object) * n - np.array(own, dtype=object)


def _squares(values: np.ndarray) -> list[int]:
    """The exact sum of squares of every column, at most ``ROWS`` rows."""
    if values.dtype == object:
        return (values * values).sum(axis=0).tolist()
    most = int(np.abs(values).max())
    if most < 1 << _LIMB:
        return (values * values).sum(axis=0).tolist()
    limbs, rest = [], np.abs(values)
    while most:
        limbs.append(rest & ((1 << _LIMB) - 1))
        rest, most = rest >> _LIMB, most >> _LIMB
    total = [0] * values.shape[1]
    for i, p in enumerate(limbs):
        for j in range(i, len(limbs)):
            part = (p * limbs[j]).sum(axis=0).tolist()
            shift = _LIMB * (i + j) + (j > i)
            total = [t + (v << shift) for t, v in zip(total, part, strict=True)]
    return total


def squares(vectors: DataFrame, column: str, n: int, own: list[int]) -> dict[tuple[int, int], int]:
    """The exact sums of squared centred values: of dimension a under (a, a), of dimensions a and b added under (a, b)."""
    size = len(own)

    def batches(stream):
        import pyarrow as pa

        keys = [(a, b) for a in range(size) for b in range(a, size)]
        totals: list[int] = []
        for batch in stream:
            for _, x in _usable(batch, column, size):
                for low in range(0, len(x), ROWS):
                    d = _centred(x[low : low + ROWS], n, own)
                    part: list[int] = []
                    for a in range(size):
                        part += _squares(d[:, a : a + 1])
                        if a + 1 < size:
                            part += _squares(d[:, a : a + 1] + d[:, a + 1 :])
                    totals = [t + p for t, p in zip(totals, part, strict=True)] if totals else part
        if totals:
            yield _record(pa, keys, totals)

    return _totals(vectors.select(column).mapInArrow(batches, _KEYED))


def covariance(found: dict[tuple[int, int], int], size: int, n: int) -> np.ndarray:
    """The matrix by polarisation; every entry is a quotient of whole numbers, rounded once."""
    v = np.empty((size, size))
    for a in range(size):
        v[a, a] = found[a, a] / n**3
        for b in range(a + 1, size):
            v[a, b] = v[b, a] = (found[a, b] - found[a, a] - found[b, b]) / (2 * n**3)
    return v


def fit(vectors: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> Fit | None:
    """The whitening of all vectors that take part; None if there are none."""
    n, own = sums(vectors, column)
    if not n:
        return None
    v = covariance(squares(vectors, column, n, own), len(own), n)
    values, found = np.linalg.eigh(v)
    order = np.argsort(-values, kind="stable")[:components]
    order = order[values[order] > 1e-12 * max(values.max(), 0.0)]
    basis = found[:, order].T
    basis = basis * np.sign(basis[np.arange(len(basis)), np.abs(basis).argmax(axis=1)])[:, None]
    trace = float(np.trace(v))
    return Fit(n, own, v, basis, values[order], values[order] / trace if trace else values[order])


def _projected(x: np.ndarray, model: Fit) -> tuple[np.ndarray, np.ndarray]:
    """Centred whole values (n * x - S) and the whitened components of some rows."""
    d = _centred(x, model.n, model.sums)
    return d, (d.astype(np.float64) / model.n) @ (model.vectors / np.sqrt(model.values)[:, None]).T


def identity_error(vectors: DataFrame, model: Fit, column: str = "embedding") -> float:
    """The largest absolute entry of the whitened vectors' covariance minus the identity, measured over all of them."""
    width = len(model.values)

    def batches(stream):
        import pyarrow as pa

        total, first = np.zeros((width, width)), np.zeros(width)
        for batch in stream:
            for _, x in _usable(batch, column, len(model.sums)):
                for low in range(0, len(x), ROWS):
                    z = _projected(x[low : low + ROWS], model)[1]
                    total += z.T @ z
                    first += z.sum(axis=0)
        a, b = np.indices((width, width + 1)).reshape(2, -1).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(np.hstack([total, first[:, None]]).ravel())], names=["a", "b", "value"])

    parts = vectors.select(column).mapInArrow(batches, "a int, b int, value double").groupBy("a", "b").agg(F.sum("value").alias("value"))
    moments = np.zeros((width, width + 1))
    for r in parts.collect():
        moments[r["a"], r["b"]] = r["value"]
    mean = moments[:, -1] / model.n
    return float(np.abs(moments[:, :-1] / model.n - np.outer(mean, mean) - np.eye(width)).max())


def transform(vectors: DataFrame, model: Fit, id_col: str = "vec_id", column: str = "embedding") -> DataFrame:
    """vec_id, deviation (decimal, sum of squared centred values, exact), whitened (array): one row per vector that takes part."""
    import pyarrow as pa

    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(column).alias("embedding"))
    kind = rows.schema["vec_id"].dataType.simpleString()

    def batches(stream):
        from decimal import Decimal

        for batch in stream:
            for at, x in _usable(batch, "embedding", len(model.sums)):
                for low in range(0, len(x), ROWS):
                    d, z = _projected(x[low : low + ROWS], model)
                    exact = _squares(d.T) if len(d) and d.shape[1] <= ROWS else [sum(v * v for v in row) for row in d.tolist()]
                    deviations = pa.array([Decimal(v) if v < 10**38 else None for v in exact], pa.decimal128(38, 0))
                    ids = batch.column("vec_id").take(pa.array(at[low : low + ROWS]))
                    yield pa.RecordBatch.from_arrays([ids, deviations, pa.array(list(z), pa.list_(pa.float64()))], names=["vec_id", "deviation", "whitened"])

    return rows.mapInArrow(batches, f"vec_id {kind}, deviation decimal(38,0), whitened array<double>")


def whitened(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row per vector that takes part and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    kind = vectors.schema["vec_id"].dataType.simpleString()
    model = fit(vectors, components=components)
    if model is None or not len(model.values):
        schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
        return vectors.sparkSession.createDataFrame([], schema)
    error = identity_error(vectors, model)
    share = F.array(*map(F.lit, model.share.tolist()))
    return transform(vectors, model).select("vec_id", F.col("deviation").cast("long").alias("deviation"), F.posexplode("whitened").alias("place", "whitened")).select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(share, F.col("place")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
