"""Helpers that several operators share: tables, folders, and word hashes of byte buffers."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that an operator turns into arrays at a time; a longer text is one chunk of its own.
CHUNK_BYTES = 1 << 20
SPACES = b" \t\n\v\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table. Python workers are told where this package lies, whatever folder the driver runs in."""
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{root}:{known}".rstrip(":")
    hand_out_few(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows that Spark hands to a Python worker at a time. Texts are long: ten thousand, Spark's own number, are tens of MB,
#: which are held by the executor and several times by the worker.
ROWS_AT_A_TIME = 1000


def hand_out_few(spark: SparkSession) -> None:
    """Let workers get texts in batches of ``ROWS_AT_A_TIME``, unless the session asks for another number than Spark's own."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, str(ROWS_AT_A_TIME))


def work_folder(spark: SparkSession) -> str:
    """A new folder below the one that all executors share."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """The rows of ``df``, kept as a table in the shared folder, so that lost executors cost no recomputing."""
    path = f"{work_folder(df.sparkSession)}/rows"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_cleared(spark: SparkSession) -> Iterator[None]:
    """Spark removes the shuffle files of each query run in here when that query ends; otherwise they stay while the driver refers to them."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def removed(df: DataFrame) -> None:
    """Delete the files of a table that `written` gave and that nothing reads any more."""
    spark = df.sparkSession
    for folder in {file.rpartition("/")[0] for file in df.inputFiles()}:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def text_of(column: str | Column) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def crc_remainder(doc_id: str | Column, modulus: int) -> Column:
    """crc32 of an id written as text, modulo ``modulus``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def chunks(texts: list[bytes], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` bytes each; every text is in one of them, whole."""
    low = size = 0
    for i, text in enumerate(texts):
        if i > low and size + len(text) > limit:
            yield low, i
            low, size = i, 0
        size += len(text) + 1
    if low < len(texts):
        yield low, len(texts)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all others."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_STEP = np.uint64(0xD1342543DE82EF95)
_powers = np.ones(1, dtype=np.uint64)


def _powers_up_to(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        grown = np.full(max(n, 1024), _STEP, dtype=np.uint64)
        grown[0] = 1
        _powers = np.multiply.accumulate(grown)
    return _powers


class Words:
    """Splits buffers of bytes into words and hashes each word, all in arrays.

    ``separators``: the bytes between words; A-Z count as a-z.
    """

    def __init__(self, separators: bytes = SPACES):
        self.is_word = np.ones(256, dtype=bool)
        self.is_word[list(separators)] = False
        folded = np.arange(256)
        folded[65:91] += 32
        self.values = np.where(self.is_word, _BYTE[folded], np.uint64(0))

    def split(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of the words of all texts in order: hash, first byte, byte after the last; and the words of each text.

        Positions count in the texts joined by one line feed, which must be a separator.
        """
        buffer = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
        inside = self.is_word[buffer]
        edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0)))
        starts, ends = edges[0::2], edges[1::2]
        lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)) + 1
        counts = np.diff(np.searchsorted(starts, np.concatenate(([0], np.cumsum(lengths)))))
        if not len(starts):
            return np.empty(0, dtype=np.uint64), starts, ends, counts
        where = np.flatnonzero(inside)
        widths = ends - starts
        first = np.cumsum(widths) - widths
        within = np.arange(len(where)) - np.repeat(first, widths)
        powers = _powers_up_to(int(widths.max()))
        hashes = np.add.reduceat(self.values[buffer[where]] * powers[within], first)
        return mixed(hashes + widths.astype(np.uint64)), starts, ends, counts


def bytes_of(batch, name: str) -> list[bytes]:
    """A text column of an Arrow batch or table as UTF-8 bytes, nulls as empty."""
    import pyarrow as pa

    column = batch.column(name)
    return [x or b"" for x in column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()]
