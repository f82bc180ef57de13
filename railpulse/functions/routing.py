"""Which family a raw file belongs to, decided from its key."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The text that marks a family in a file key, in order of precedence.
ROUTE_MARKS = [
    ("dht", "dht11"),
    ("dps", "dps"),
    ("optical", "optical"),
    ("omron", "omron"),
    ("piezo", "piezo"),
    ("tof", "tof"),
]
MARK_OF = {family: mark for mark, family in ROUTE_MARKS}


def route_family(key: Column) -> Column:
    """The family of the first mark found in the key, or null."""
    tests = [F.when(F.contains(key, F.lit(mark)), family) for mark, family in ROUTE_MARKS]
    return F.coalesce(*tests)


def names_family(key: Column, family: Column) -> Column:
    """Whether the key carries the mark of the family that was asked for."""
    marks = F.create_map(*[F.lit(x) for family_mark in MARK_OF.items() for x in family_mark])
    return F.contains(key, F.element_at(marks, family))


def accepted(df: DataFrame, key: str, family: str) -> DataFrame:
    return df.filter(names_family(F.col(key), F.col(family)))


def rejected(df: DataFrame, key: str, family: str) -> DataFrame:
    """Rows whose key does not name the family asked for, or that ask for none we know."""
    return df.filter(~F.coalesce(names_family(F.col(key), F.col(family)), F.lit(False)))


# Scheme and bucket or host of a path.
STORE = r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"


def key_within(path: Column, root: str) -> Column:
    """The file key below ``root``: marks in the names of the store and the root do not count.

    Both may be qualified or not; they must be encoded alike.
    """
    root = re.sub(STORE, "", root).rstrip("/")
    below = F.regexp_replace(path, STORE, "")
    return F.when(F.startswith(below, F.lit(root + "/")), F.substr(below, F.lit(len(root) + 1))).otherwise(below)


def root_of(spark: SparkSession, folder: str, encoded: bool = True) -> str:
    """The full path of a folder in its store; ``encoded`` as in ``_metadata.file_path``."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    uri = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toUri()
    return uri.getRawPath() if encoded else uri.getPath()
