"""Running the profiles of many tables, with failures kept apart."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone
from itertools import islice
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from tallymark.operators.profile import all_profiles

PROFILE_SCHEMA = "db string, schema string, table string, func string, col string, value string, position int"


class Request(NamedTuple):
    """Tables that can be profiled together, e.g. the partitions of one table."""

    tables: tuple
    build: Callable[[tuple], DataFrame]


class Outcome(NamedTuple):
    """What became of one table: when it ran, and the error if it failed."""

    table: object
    started: datetime
    ended: datetime
    error: str | None


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def _batches(requests: Iterable[Request], size: int) -> Iterator[Sequence[Request]]:
    stream = iter(requests)
    while batch := list(islice(stream, size)):
        yield batch


def _built(request: Request) -> list[tuple[tuple, DataFrame | Exception]]:
    """The request's profile, or those of its halves if it cannot be planned, down to the tables that cannot."""
    try:
        return [(request.tables, request.build(request.tables))]
    except Exception as failure:
        if len(request.tables) == 1:
            return [(request.tables, failure)]
        middle = len(request.tables) // 2
        halves = request.tables[:middle], request.tables[middle:]
        return [built for half in halves for built in _built(Request(half, request.build))]


def write_profiles(
    spark: SparkSession, requests: Iterable[Request], folder: str, batch_size: int = 50
) -> list[Outcome]:
    """Write the profiles of all requests below ``folder``, a batch per job; requests may come as a stream.

    A batch is the union of its profiles, so its tables run side by side and
    its plan stays bounded. A table that cannot be planned is left out; a batch
    that fails while running leaves nothing behind and runs again in halves, of
    which only those with a bad table are halved further. So one bad table
    costs few runs beside its own: it has no rows in the folder, and its error
    tells why.
    """
    spark.createDataFrame([], PROFILE_SCHEMA).write.mode("append").parquet(folder)
    outcomes = []
    for batch in _batches(requests, batch_size):
        started = _now()
        # Planning reads file footers, so the wait is for storage.
        with ThreadPoolExecutor(8) as pool:
            built = [b for found in pool.map(_built, batch) for b in found]
        good = [(tables, df) for tables, df in built if isinstance(df, DataFrame)]
        outcomes += [Outcome(tables[0], started, _now(), str(e)) for tables, e in built if not isinstance(e, DataFrame)]
        build = {table: r.build for r in batch for table in r.tables}
        outcomes += _run([(tables, df, build[tables[0]]) for tables, df in good], folder)
    return outcomes


def _write(profiles: Sequence[DataFrame], folder: str) -> None:
    all_profiles(profiles).write.mode("append").parquet(folder)


def _run(parts: Sequence[tuple[tuple, DataFrame, Callable]], folder: str) -> list[Outcome]:
    """Write the given profiles; if that fails, the halves of them, down to single tables."""
    if not parts:
        return []
    started = _now()
    try:
        _write([df for _, df, _ in parts], folder)
    except Exception as failure:
        if len(parts) > 1:
            middle = len(parts) // 2
            return _run(parts[:middle], folder) + _run(parts[middle:], folder)
        ((tables, _, build),) = parts
        if len(tables) == 1:
            return [Outcome(tables[0], started, _now(), str(failure))]
        outcomes = []
        for half in (tables[: len(tables) // 2], tables[len(tables) // 2 :]):
            for members, df in _built(Request(half, build)):
                outcomes += (
                    _run([(members, df, build)], folder)
                    if isinstance(df, DataFrame)
                    else [Outcome(members[0], started, _now(), str(df))]
                )
        return outcomes
    return [Outcome(table, started, _now(), None) for tables, _, _ in parts for table in tables]
