"""Tables that are replaced whole.

A version is written to a folder of its own, and then a small numbered pointer file is made that names it.
Readers go by the highest pointer that can be read, so a writer that stops at any point leaves the old
rows or the new ones, never a mixture and never none. A pointer is made only where there is none of its
number, so of two writers that started from one version only the first succeeds.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from railpulse.sinks.files import read_note, stored, write_note

POINTERS = "pointers"
# Versions that stay: the current one and the one before, which running readers may have planned with.
KEPT = 2


class VersionTaken(RuntimeError):
    """Another writer has put a version after the one that this writer started from."""


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.parquet(path)


def _names(spark: SparkSession, folder: str) -> list[str]:
    place, store = stored(spark, folder)
    return [status.getPath().getName() for status in store.listStatus(place)] if store.exists(place) else []


def _pointers(spark: SparkSession, table: str) -> list[int]:
    return sorted((int(name) for name in _names(spark, f"{table}/{POINTERS}") if name.isdigit()), reverse=True)


def _named(spark: SparkSession, table: str, number: int) -> str | None:
    """The folder that a pointer names; None if its writer stopped before it was whole."""
    try:
        return read_note(spark, f"{table}/{POINTERS}/{number:09d}")
    except Py4JJavaError:
        return None


def current(spark: SparkSession, table: str) -> tuple[int, str | None]:
    """The number and the folder of the current version; the folder is None where there is none yet."""
    for number in _pointers(spark, table):
        name = _named(spark, table, number)
        if name:
            return number, f"{table}/{name}"
    return -1, None


def read_version(spark: SparkSession, table: str, schema: StructType) -> DataFrame:
    """The rows of the current version of a parquet table."""
    folder = current(spark, table)[1]
    if folder is None:
        raise FileNotFoundError(f"no version of {table}")
    return spark.read.schema(schema).parquet(folder)


def put_version(df: DataFrame, table: str, after: int | None = None, write: Callable[[DataFrame, str], None] = write_parquet) -> int:
    """Replace a table by ``df``; returns the version's number.

    ``after`` is the version that ``df`` was made from: where another has been put since, nothing changes and
    ``VersionTaken`` is raised. Without it the last writer wins.
    """
    spark = df.sparkSession
    while True:
        taken = _pointers(spark, table)
        if after is not None and current(spark, table)[0] != after:
            raise VersionTaken(f"{table} has moved on from version {after}")
        number = taken[0] + 1 if taken else 0
        name = f"version-{number:09d}-{uuid.uuid4().hex}"
        write(df, f"{table}/{name}")
        if after is not None and current(spark, table)[0] != after:
            raise VersionTaken(f"{table} has moved on from version {after}")
        try:
            write_note(spark, f"{table}/{POINTERS}/{number:09d}", name)
        except Py4JJavaError:
            if _named(spark, table, number) in (None, name):
                raise
            if after is not None:
                raise VersionTaken(f"{table} has moved on from version {after}") from None
            continue
        if after is not None and current(spark, table)[0] != number:
            raise VersionTaken(f"{table} has moved on from version {after}")
        _clean(spark, table)
        return number


def _clean(spark: SparkSession, table: str) -> None:
    """Remove versions before the last ``KEPT``, and what writers that stopped have left of them."""
    whole = [n for n in _pointers(spark, table) if _named(spark, table, n)]
    if len(whole) <= KEPT:
        return
    oldest = whole[KEPT - 1]
    for name in _names(spark, table):
        if name.startswith("version-") and int(name.split("-")[1]) < oldest:
            place, store = stored(spark, f"{table}/{name}")
            store.delete(place, True)
    for number in _pointers(spark, table):
        if number < oldest:
            place, store = stored(spark, f"{table}/{POINTERS}/{number:09d}")
            store.delete(place, False)
