"""Raw reading files: CSV with a header row."""

from __future__ import annotations

import csv
import functools
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from railpulse.functions.routing import key_within, root_of, route_family
from railpulse.schemas import readings_schema
from railpulse.sources.optical import read_optical


# The line of a row whose values do not fit the contract; null for all others.
MISFIT = "_misfit"
HEADERS_AT_A_TIME = 32


def typed_header(header: list[str], family: str) -> StructType:
    """The header's columns in file order, typed by the family's contract; others are text."""
    contract = {f.name: f for f in readings_schema(family)}
    missing = [name for name in contract if name not in header]
    if missing:
        raise ValueError(f"{family} file lacks the columns {', '.join(missing)}")
    return StructType([contract.get(name, StructField(name, StringType())) for name in header])


def with_misfits(schema: StructType) -> StructType:
    """A schema with a column for the line of a row whose values do not fit their types."""
    return StructType([*schema, StructField(MISFIT, StringType())])


def files_of(spark: SparkSession, path: str | list[str]) -> list[str]:
    """The files that a read of ``path`` takes, in order of their names; their content is not read."""
    jvm = spark.sparkContext._jvm
    return sorted(jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri)).toString() for uri in spark.read.text(path).inputFiles())


def first_line(spark: SparkSession, path: str) -> str | None:
    """The first line of a file, packed or not, of a megabyte at most; None if it is empty."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(path)
    stream = place.getFileSystem(conf).open(place)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(place)
        plain = jvm.org.apache.commons.io.input.BoundedInputStream(codec.createInputStream(stream) if codec else stream, 1 << 20)
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(plain, "UTF-8")).readLine()
    finally:
        stream.close()


def header_of(spark: SparkSession, path: str) -> tuple[str, ...]:
    """The names in a file's header; none if the file is empty."""
    line = first_line(spark, path)
    return tuple(next(csv.reader([line.removeprefix("\ufeff")]), ())) if line else ()


def headers(spark: SparkSession, paths: list[str]) -> list[tuple[str, ...]]:
    """The header of each file. Only first lines pass the driver, several at a time."""
    with ThreadPoolExecutor(HEADERS_AT_A_TIME) as pool:
        return list(pool.map(lambda path: header_of(spark, path), paths))


def read_readings(spark: SparkSession, path: str | list[str], family: str, misfits: bool = False, arrival: bool = False) -> DataFrame:
    """Files of one family, each read by its own header: columns go by name.

    Types come from the contract, so the data is not scanned for them. Files with the same header are one scan, and the
    scans are put together by name: the order is that of the first file's header, and a column that the contract
    does not ask for is empty text, not null, for files that lack it, so that cleaning keeps their rows. A file that lacks a column of the contract fails the read; an empty one has no
    rows. With ``misfits`` the column ``MISFIT`` holds the lines of rows that do not fit, with ``arrival`` rows
    carry the file they came from.
    """
    if family == "optical":
        rows = read_optical(spark, path)
        return with_arrival(rows) if arrival else rows
    files = files_of(spark, path)
    by_header: dict[tuple[str, ...], list[str]] = {}
    for file, header in zip(files, headers(spark, files)):
        by_header.setdefault(header, []).append(file)
    by_header.pop((), None)
    extra = list(dict.fromkeys(name for header in by_header for name in header if name not in readings_schema(family).names))

    def scan(header, files):
        try:
            schema = typed_header(list(header), family)
        except ValueError as lacking:
            raise ValueError(f"{lacking}: {files if isinstance(files, str) else files[0]}") from None
        rows = (spark.read.option("header", True).option("enforceSchema", False).option("columnNameOfCorruptRecord", MISFIT)
                .schema(with_misfits(schema) if misfits else schema).csv(files))
        rows = rows.select("*", *file_columns()) if arrival else rows
        return rows.withColumns({name: F.lit("") for name in extra if name not in header})

    if len(by_header) == 1:
        (header, files), = by_header.items()
        # As given, so that the files need not be named one by one; those without a line add nothing.
        rows = scan(header, path if isinstance(path, str) else files)
    elif by_header:
        rows = functools.reduce(DataFrame.unionByName, [scan(*item) for item in by_header.items()])
    else:
        schema = readings_schema(family)
        rows = spark.createDataFrame([], with_misfits(schema) if misfits else schema)
        rows = rows.select("*", *[F.lit(None).cast(kind).alias(c) for c, kind in FILE_TYPES.items()]) if arrival else rows
    return rows.withColumn("source_row", F.monotonically_increasing_id()) if arrival else rows


# The file a row came from, by its time and a 128-bit hash of its path: rows are grouped by these,
# and whole paths would be carried through every shuffle.
FILE_KEY = ["source_time", "source_id", "source_id2"]
# With the place within the file: the order in which rows were written.
ARRIVAL = [*FILE_KEY, "source_block", "source_row"]


# All columns that ``file_columns`` makes.
FILE_TYPES = {"source_file": "string", "source_time": "bigint", "source_id": "bigint", "source_id2": "bigint", "source_block": "bigint"}


def file_columns() -> list[Column]:
    """The columns that name a row's file; for plain file reads and file streams."""
    path = F.col("_metadata.file_path")
    return [
        path.alias("source_file"),
        F.unix_micros("_metadata.file_modification_time").alias("source_time"),
        F.xxhash64(path).alias("source_id"),
        F.xxhash64(F.lit(1), path).alias("source_id2"),
        F.col("_metadata.file_block_start").alias("source_block"),
    ]


def with_arrival(df: DataFrame) -> DataFrame:
    """Add the file a row came from and its place there.

    Pairing and headway then stay within a file, and of two rows for one key the one written
    last wins. ``df`` must be a plain file read.
    """
    return df.select("*", *file_columns(), F.monotonically_increasing_id().alias("source_row"))


def arrival_columns(df: DataFrame) -> list[str]:
    return [c for c in ARRIVAL if c in df.columns]


def without_arrival(df: DataFrame) -> DataFrame:
    return df.drop(*ARRIVAL, "source_file")


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows_read"))


def raw_keys(spark: SparkSession, folder: str) -> DataFrame:
    """``path``, ``key`` and routed ``family`` of the files below a folder; their content is not
    read. Files that belong to no family have a null there."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
             .select("path", key_within(F.col("path"), root_of(spark, folder, encoded=False)).alias("key")))
    return files.withColumn("family", route_family(F.col("key")))
