"""Files with any header: which type each column has, in a batch and over all batches of the trusted zone.

A column of a batch is of one kind: ``none`` (no value), ``whole`` (numbers that doubles hold exactly), ``long``
(whole numbers of 64 bits), ``fraction``, ``time`` or ``text``. Kinds are ordered by what holds what:
nothing below all, whole below long and below fraction, text above all. A column over
batches is of the least kind above its own in each, so a long and a fraction meet in text, where neither loses digits.
Nothing written is changed for it: a batch is widened as it is read.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegralType, LongType, NumericType, StringType, StructField, StructType, TimestampNTZType, TimestampType

from railpulse.functions.columns import rendered
from railpulse.schemas import TIME_FORMAT
from railpulse.sinks.files import Zones, stored

# The name of a kind within a column's metadata.
KIND = "kind"
TYPES = {"none": StringType(), "whole": DoubleType(), "long": LongType(), "fraction": DoubleType(), "time": TimestampType(), "text": StringType()}
KINDS = "place int, name string, kind string"
EXACT = 2**53
WHOLE = r"^(0|-?[1-9]\d{0,18})$"
FRACTION = r"^[+-]?((0|[1-9]\d*)(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"
ODD = ["NaN", "Inf", "-Inf"]


def looks_like_id(name: str) -> bool:
    name = name.lower()
    return name == "id" or name.endswith("_id") or name.startswith(("id_", "num_"))


def joined(one: str, other: str) -> str:
    """The least kind that holds both."""
    pair = {one, other} - {"none"}
    if len(pair) < 2:
        return next(iter(pair), "none")
    for both in ("long", "fraction"):
        if pair == {"whole", both}:
            return both
    return "text"


def kind_of_value(text: Column) -> Column:
    """The kind of one value; null for null. Numbers with leading zeros are text, as is what a number would not
    hold to the last digit before the point."""
    number, long_ = text.try_cast("double"), text.try_cast("long")
    by_exponent = text.rlike("[eE]")
    return (F.when(text.isNull(), None)
            .when(text.rlike(WHOLE) & long_.isNotNull(), F.when(long_.between(-EXACT, EXACT), "whole").otherwise("long"))
            .when(text.isin(*ODD), "fraction")
            .when(text.rlike(FRACTION) & ((F.abs(number) <= EXACT) | (by_exponent & (F.abs(number) < float("inf")))), "fraction")
            .otherwise("text"))


def kinds_of(texts: DataFrame) -> dict[str, str]:
    """The kind of each column of texts, by one scan that brings at most four flags a column to the driver."""
    free = [c for c in texts.columns if not looks_like_id(c)]
    kinds = [k for k in TYPES if k not in ("none", "time")]
    found = texts.agg(F.lit(0), *[F.bool_or(kind_of_value(_named(c)) == k).alias(f"{i} {k}") for i, c in enumerate(free) for k in kinds]).first()
    flags = {c: functools.reduce(joined, [k for k in kinds if found[f"{i} {k}"]], "none") for i, c in enumerate(free)}
    return {c: flags.get(c, "text") for c in texts.columns}


def _named(name: str) -> Column:
    return F.col(f"`{name.replace('`', '``')}`")


def schema_of(kinds: dict[str, str]) -> StructType:
    """A schema that carries the kinds along."""
    return StructType([StructField(name, TYPES[kind], metadata={KIND: kind}) for name, kind in kinds.items()])


def kinds_in(schema: StructType) -> dict[str, str]:
    """The kinds that a schema carries; those of columns without one go by type."""
    def kind(field: StructField) -> str:
        if KIND in field.metadata:
            return field.metadata[KIND]
        if isinstance(field.dataType, IntegralType):
            return "long"
        if isinstance(field.dataType, (TimestampType, TimestampNTZType)):
            return "time"
        return "fraction" if isinstance(field.dataType, NumericType) else "text"

    return {f.name: kind(f) for f in schema}


def read_optical(spark: SparkSession, path: str | list[str], schema: StructType | None = None,
                 time_columns: tuple[str, ...] = (), time_format: str = TIME_FORMAT) -> DataFrame:
    """Files with any header. Without a schema one more scan of the files finds the kind of each column;
    whole numbers become doubles like fractions unless a double would lose digits. Times
    are never guessed, as Spark would take ``T1`` for one: those named in ``time_columns`` are
    read by ``time_format``. All else, and every id, is text."""
    if schema is None:
        kinds = kinds_of(spark.read.option("header", True).csv(path))
        schema = schema_of({name: "time" if name in time_columns else kind for name, kind in kinds.items()})
    rows = (spark.read.option("header", True).option("enforceSchema", False).option("timestampFormat", time_format)
            .schema(schema).csv(path))
    # A file read drops what the schema says of a column.
    return rows.select([_named(f.name).alias(f.name, metadata=f.metadata) if f.metadata else _named(f.name) for f in schema])


def put_kinds(spark: SparkSession, zones: Zones, family: str, batch: int, kinds: dict[str, str]) -> None:
    """Note the kinds of a batch's columns."""
    rows = [(place, name, kind) for place, (name, kind) in enumerate(kinds.items())]
    spark.createDataFrame(rows, KINDS).coalesce(1).write.mode("overwrite").json(zones.kinds(family, batch))


def drop_kinds(spark: SparkSession, zones: Zones, family: str, batch: int) -> None:
    place, store = stored(spark, zones.kinds(family, batch))
    store.delete(place, True)


def noted_kinds(spark: SparkSession, zones: Zones, family: str) -> dict[int, dict[str, str]]:
    """The kinds of each batch that has a note, the first batch first."""
    folder, store = stored(spark, zones.kinds(family))
    if not store.exists(folder):
        return {}
    notes = spark.read.schema(f"{KINDS}, batch long").json(zones.kinds(family)).groupBy("batch").agg(
        F.sort_array(F.collect_list(F.struct("place", "name", "kind"))))
    return {batch: {c.name: c.kind for c in columns} for batch, columns in sorted(map(tuple, notes.where("batch IS NOT NULL").collect()))}


def widened(value: Column, own: str, to: str) -> Column:
    """A column of one kind as a kind above it."""
    if own == "none":
        return F.lit(None).cast(TYPES[to])
    if to == "text":
        return rendered(value) if own == "time" else value.cast("long").cast("string") if own == "whole" else value.cast("string")
    return value.cast(TYPES[to])


def read_trusted(spark: SparkSession, zones: Zones, family: str) -> DataFrame:
    """All trusted rows of a family with any header, each column in the kind that holds it over all batches, with the number of the
    ``batch``.

    Batches with the same kinds are one scan. A column that a batch lacks is null for it. Numbers that meet texts
    are shown as they are kept: whole ones without a point, fractions as rounded. A batch
    without a note, as one that is being replaced, goes by the types of its files.
    """
    from railpulse.sources.readings import without_arrival  # which reads optical files by this module

    folder, store = stored(spark, zones.trusted(family))
    names = [s.getPath().getName() for s in store.listStatus(folder)] if store.exists(folder) else []
    batches = sorted(int(name.partition("=")[2]) for name in names if name.startswith("batch="))
    if not batches:
        raise ValueError(f"{family} has no trusted rows")
    notes = noted_kinds(spark, zones, family)
    kinds = {b: notes.get(b) or kinds_in(without_arrival(spark.read.parquet(zones.trusted(family, b))).schema) for b in batches}
    family_kinds: dict[str, str] = {}
    alike: dict[tuple, list[int]] = {}
    for batch, own in kinds.items():
        alike.setdefault(tuple(own.items()), []).append(batch)
        for name, kind in own.items():
            family_kinds[name] = joined(family_kinds.get(name, "none"), kind)

    def scan(own: tuple, numbers: list[int]) -> DataFrame:
        own = dict(own)
        rows = spark.read.option("basePath", zones.trusted(family)).parquet(*[zones.trusted(family, b) for b in numbers])
        wide = [widened(_named(name) if name in own else F.lit(None), own.get(name, "none"), kind).alias(name) for name, kind in family_kinds.items()]
        return rows.select(*wide, F.col("batch").cast("long").alias("batch"))

    return functools.reduce(DataFrame.unionByName, [scan(*item) for item in alike.items()])
