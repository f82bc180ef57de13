"""Dimension tables from dumps with typed attributes, and from the tables they are loaded into.

A dump is ``{"Items": [{"<attribute>": {"S": "<text>"}, "<attribute>": {"N": "<number>"}}]}``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, NumericType, StringType, StructField, StructType

from railpulse.schemas import dimension_schema
from railpulse.session import Scratch
from railpulse.sinks.versions import current, put_version, read_version
from railpulse.sources.pieces import split_items


def dump_schema(flat: StructType) -> StructType:
    """The nested schema of a dump that holds the attributes of ``flat``."""
    value = StructType([StructField("S", StringType()), StructField("N", StringType())])
    item = StructType([StructField(f.name, value) for f in flat])
    return StructType([StructField("Items", ArrayType(item))])


def unwrap_items(df: DataFrame, flat: StructType) -> DataFrame:
    """``Items`` as flat rows: numbers typed, missing attributes null, no items no rows."""

    def value(field):
        if isinstance(field.dataType, NumericType):
            return F.col(f"item.{field.name}.N").cast("double").cast(field.dataType).alias(field.name)
        return F.col(f"item.{field.name}.S").alias(field.name)

    return df.select(F.explode("Items").alias("item")).select(*[value(f) for f in flat])


def last_of_each_key(items: DataFrame, flat: StructType) -> DataFrame:
    """``Items`` with one item per key (the table's first attribute), the last of the dump: of several files that
    by name, within it by place."""
    key = F.col(f"item.{flat[0].name}.S")
    turn = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("file"), F.desc("place")))
    return items.withColumn("turn", turn).where("turn = 1").select(F.array("item").alias("Items"))


def read_typed_dump(spark: SparkSession, path: str | list[str], table: str, scratch: Scratch | None = None) -> DataFrame:
    """Dump files. Their encoding (UTF-8 or UTF-16, with or without mark) is detected.

    A damaged file fails the read. Without ``scratch`` each file is read whole by one task; with it, files in UTF-8
    are cut at item boundaries and read by many.
    """
    flat = dimension_schema(table)
    if scratch is None:
        return unwrap_items(_read_raw(spark, path, flat), flat)
    return unwrap_items(read_items(spark, path, flat, scratch).select(F.array("item").alias("Items")), flat)


def read_items(spark: SparkSession, path: str | list[str], flat: StructType, scratch: Scratch) -> DataFrame:
    """The items of dumps with the file and the place in it, each file read by as many tasks as it has splits."""
    items, whole = split_items(spark, path, scratch)
    item = dump_schema(flat)["Items"].dataType.elementType
    rows = items.select("file", "place", F.from_json("text", item, {"mode": "FAILFAST"}).alias("item"))
    if not whole:
        return rows
    raw = _read_raw(spark, whole, flat).select("_metadata.file_path", F.posexplode("Items").alias("at", "item"))
    place = F.struct(F.lit(0).cast("long").alias("block"), F.col("at").cast("long").alias("line"))
    return rows.unionByName(raw.select(F.col("file_path").alias("file"), place.alias("place"), "item"))


def _read_raw(spark: SparkSession, path: str | list[str], flat: StructType) -> DataFrame:
    return spark.read.option("multiLine", True).option("mode", "FAILFAST").schema(dump_schema(flat)).json(path)


def load_dimensions(spark: SparkSession, dumps: dict[str, str], table_dir: str) -> None:
    """Put dumps, given by table name, into one dimension table each, by the table's key.

    An item replaces the row of its key; rows of other keys stay. A key that a dump repeats keeps
    its last item. A table is a versioned one: a damaged dump, or a load that stops anywhere, leaves the old
    rows or the new ones whole, and of two loads at a time one gets ``VersionTaken`` and may be run again.
    """
    with Scratch(spark) as scratch:
        for table, path in dumps.items():
            flat, place = dimension_schema(table), f"{table_dir.rstrip('/')}/{table}"
            items = read_items(spark, path, flat, scratch)
            # Written down, since both the new rows and the choice of old ones need it.
            dump = scratch.save(unwrap_items(last_of_each_key(items, flat), flat), "dump-rows")
            number, old = current(spark, place)
            if old:
                key = flat[0].name
                rest = spark.read.schema(flat).parquet(old).join(dump.select(key), key, "left_anti")
                dump = dump.unionByName(rest)
            put_version(dump, place, after=number)


@dataclass(frozen=True)
class Dimensions:
    """The dimension tables the plans join with."""

    metadata: DataFrame
    circuits: DataFrame
    distances: DataFrame
    tracks: DataFrame
    lines: DataFrame


def read_dimension(spark: SparkSession, table_dir: str, name: str) -> DataFrame:
    return read_version(spark, f"{table_dir.rstrip('/')}/{name}", dimension_schema(name))


def read_dimensions(spark: SparkSession, table_dir: str) -> Dimensions:
    def table(name):
        return read_dimension(spark, table_dir, name)

    return Dimensions(table("SensorMetadata"), table("Circuito"), table("PiezoSensorDistancia"),
                      table("Trilho"), table("Linha"))


def dimension_from_rows(spark: SparkSession, rows: list[tuple], table: str) -> DataFrame:
    return spark.createDataFrame(rows, dimension_schema(table))
