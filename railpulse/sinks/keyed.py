"""Fact tables where the last write per key wins.

A batch is added as a folder of its own and costs what the batch holds; nothing already written is
read or rewritten. Within it rows lie in key buckets, each a folder sorted by key, so that asking for
some keys reads their buckets only. Reading folds the batches to the latest row per key. A batch
that is run again replaces its own folder, so replays change nothing.

A small file names the number of buckets and the columns of a table; both stay. Folding into a new
table may give it more buckets.
"""

from __future__ import annotations

import json

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType, TimestampType

from railpulse.operators.ordered import latest_by_key
from railpulse.sinks.files import read_note, stored, write_note
from railpulse.sources.readings import arrival_columns

BATCH = "batch"
BUCKET = "key_bucket"
# Of a new table; one of many terabytes is given more, so that a bucket stays within a few tasks.
BUCKETS = 16
FORM = "_form"
FOLDING = "_folding"


class OtherForm(ValueError):
    """A batch does not have the columns or key of its table."""


class Unfinished(ValueError):
    """A table whose folding has stopped midway; ``compact`` goes on with it."""


def upsert_latest(old: DataFrame, new: DataFrame, keys: list[str], sequence: list) -> DataFrame:
    """``old`` with ``new`` put over it by key, the higher sequence winning."""
    return latest_by_key(old.unionByName(new), keys, sequence)


def last_written(df: DataFrame, keys: list[str], sequence: list | None = None) -> DataFrame:
    """One row per key: the highest in ``sequence``, by default the one written last to the raw
    files. Rows that do not carry where they came from are told apart by their values.

    To be used on numbers and timestamps, before ids and times are rendered as text.
    """
    values = [c for c in df.columns if c not in keys]
    return latest_by_key(df, keys, sequence or arrival_columns(df) or values)


def bucket_of(key: list[Column], buckets: int) -> Column:
    """The bucket of a key, given in the table's types; null is a value like any other."""
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def put_batch(df: DataFrame, table: str, batch: int, keys: list[str], buckets: int = BUCKETS) -> None:
    """Write one batch of rows that are unique by key. ``buckets`` counts for a new table only."""
    rows, spark = df.drop(*arrival_columns(df)), df.sparkSession
    form = _form_for(spark, table, rows.schema, keys, buckets)
    _in_buckets(rows, keys, form["buckets"], "static").parquet(f"{table}/{BATCH}={batch:09d}")


def _in_buckets(rows: DataFrame, keys: list[str], buckets: int, replaced: str):
    dealt = rows.withColumn(BUCKET, bucket_of([F.col(k) for k in keys], buckets))
    even = dealt.hint("rebalance", F.col(BUCKET)).sortWithinPartitions(BUCKET, *keys)
    return even.write.mode("overwrite").option("partitionOverwriteMode", replaced).partitionBy(BUCKET)


def _columns(schema: StructType) -> list[list[str]]:
    return [[f.name, f.dataType.simpleString()] for f in schema]


def _form_for(spark: SparkSession, table: str, schema: StructType, keys: list[str], buckets: int) -> dict:
    """The form of a table that is to take rows of this schema; a new table gets it from them."""
    place = f"{table}/{FORM}"
    new = {"buckets": buckets, "keys": keys, "columns": _columns(schema)}
    if read_note(spark, place) is None:
        if read_note(spark, f"{table}/{FOLDING}") is not None:
            raise Unfinished(f"{table} is not folded to its end")
        if _batches(spark, table):
            raise OtherForm(f"{table} has batches without key buckets: fold it into a new table with compact")
        try:
            write_note(spark, place, json.dumps(new))
        except Py4JJavaError:
            # Another writer was first; its form counts.
            if read_note(spark, place) is None:
                raise
    form = json.loads(read_note(spark, place))
    for part in ("keys", "columns"):
        if form[part] != new[part]:
            raise OtherForm(f"{table} has the {part} {form[part]}, the batch {new[part]}")
    return form


def _batches(spark: SparkSession, table: str) -> list[int]:
    folder, store = stored(spark, table)
    names = [status.getPath().getName() for status in store.listStatus(folder)] if store.exists(folder) else []
    return sorted(int(name.partition("=")[2]) for name in names if name.startswith(f"{BATCH}="))


def _form(spark: SparkSession, table: str) -> dict | None:
    """The form of a table; None for one without buckets."""
    note = read_note(spark, f"{table}/{FORM}")
    if note is None and read_note(spark, f"{table}/{FOLDING}") is not None:
        raise Unfinished(f"{table} is not folded to its end")
    return json.loads(note) if note else None


def _rows(spark: SparkSession, table: str, form: dict | None) -> DataFrame:
    """All rows of all batches, with the batch and the bucket."""
    read = spark.read.option("basePath", table)
    if form:
        read = read.schema(StructType([*_schema(form), StructField(BATCH, LongType()), StructField(BUCKET, IntegerType())]))
    return read.parquet(table).withColumn(BATCH, F.col(BATCH).cast("long"))


def _schema(form: dict) -> StructType:
    return StructType.fromDDL(", ".join(f"`{name.replace('`', '``')}` {kind}" for name, kind in form["columns"]))


def read_latest(spark: SparkSession, table: str, keys: list[str],
                sequence: list | None = None) -> DataFrame:
    """The row that wins per key over all batches: by default that of the batch run last.

    Naming a ``sequence``, such as an event time, lets the highest value win instead. A filter on
    key columns reaches the scan; ``read_keys`` skips buckets as well.
    """
    rows = _rows(spark, table, _form(spark, table))
    return latest_by_key(rows, keys, [*(sequence or []), BATCH]).drop(BATCH, BUCKET)


def read_keys(spark: SparkSession, table: str, keys: list[str], wanted: list[tuple], sequence: list | None = None) -> DataFrame:
    """``read_latest`` for some keys, each a tuple in the order of ``keys``: only their buckets are listed in the scan.

    Values are cast to the table's types, and null finds null. For a list that a person or a service
    names; a table of keys is better joined.
    """
    form = _form(spark, table)
    rows = _rows(spark, table, form)
    kinds = {f.name: f.dataType for f in rows.schema}

    def literal(name, value) -> Column:
        # Times as text go by the session's zone, as everywhere.
        return F.lit(str(value) if value is not None and isinstance(kinds[name], TimestampType) else value).cast(kinds[name])

    asked = [[literal(name, value) for name, value in zip(keys, key, strict=True)] for key in dict.fromkeys(wanted)]
    if not asked:
        return rows.where("false").drop(BATCH, BUCKET)
    if form:
        if form["keys"] != list(keys):
            raise OtherForm(f"{table} has the keys {form['keys']}, asked by {keys}")
        rows = rows.where(F.col(BUCKET).isin(*[bucket_of(key, form["buckets"]) for key in asked]))
    own = F.lit(False)
    for key in asked:
        same = F.lit(True)
        for name, value in zip(keys, key):
            same &= F.col(name).eqNullSafe(value)
        own |= same
    return latest_by_key(rows.where(own), keys, [*(sequence or []), BATCH]).drop(BATCH, BUCKET)


def compact(spark: SparkSession, table: str, into: str, keys: list[str], sequence: list | None = None,
            buckets: int | None = None, at_once: int | None = None) -> None:
    """Write the winning rows to a new table folder, for readers to move to.

    ``sequence`` is that of the table's readers. The rows take the number of the last batch folded,
    so later batches come after them and none that a new ingest starts with replaces them.

    Buckets are folded ``at_once`` at a time, by default all in one job, and those that are done are noted. A
    folding that stopped goes on when called again, over the batches that it began with; until its end the new
    table cannot be read. ``buckets`` gives the new table a multiple of the old number, so that a bucket parts
    without meeting others; a table without buckets is folded whole.
    """
    if read_note(spark, f"{into}/{FORM}") is not None:
        raise FileExistsError(f"{into} is a table already")
    old = _form(spark, table)
    count = old["buckets"] if old else 1
    wanted = buckets or (count if old else BUCKETS)
    if wanted % count:
        raise ValueError(f"{wanted} buckets are not a multiple of {count}")
    rows = _rows(spark, table, old)
    columns = rows.drop(BATCH, BUCKET)
    plan = {"table": table, "last": max(_batches(spark, table), default=0), "buckets": wanted, "keys": list(keys),
            "at_once": at_once or count, "sequence": [str(s) for s in sequence or []], "columns": _columns(columns.schema)}
    begun = read_note(spark, f"{into}/{FOLDING}")
    if begun is None:
        if _batches(spark, into):
            raise FileExistsError(f"{into} holds batches")
        write_note(spark, f"{into}/{FOLDING}", json.dumps(plan))
    else:
        begun = json.loads(begun)
        if begun | {"last": plan["last"]} != plan:
            raise OtherForm(f"{into} was begun as {begun}")
        plan = begun
    rows = rows.where(F.col(BATCH) <= plan["last"])
    for first in range(0, count, plan["at_once"]):
        done = f"{into}/{FOLDING}-{first}"
        if read_note(spark, done) is None:
            some = rows.where(F.col(BUCKET).between(first, first + plan["at_once"] - 1)) if old else rows
            won = latest_by_key(some, keys, [*(sequence or []), BATCH]).drop(BATCH, BUCKET)
            _in_buckets(won, keys, wanted, "dynamic").parquet(f"{into}/{BATCH}={plan['last']:09d}")
            write_note(spark, done, "")
    write_note(spark, f"{into}/{FORM}", json.dumps({"buckets": wanted, "keys": list(keys), "columns": plan["columns"]}))
