"""Cleaning shared by all families: drop null rows, round, settle dates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType,
    DoubleType,
    FloatType,
    StringType,
    StructField,
    TimestampNTZType,
    TimestampType,
)

from railpulse.functions.columns import rendered

PLACES = 5
LOCAL_ZONE = "America/Sao_Paulo"

# Date text is read in the first of these formats that fits.
DATE_FORMATS = [
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss.SSSZ",
    "dd/MM/yyyy HH:mm:ss",
    "yyyy-MM-dd",
]

TIME_TYPES = (DateType, TimestampType, TimestampNTZType)


def drop_nulls(df: DataFrame) -> DataFrame:
    """Rows without null and without NaN, as ``na.drop``.

    One test per column, so that the null tests reach a parquet scan and skip row groups.
    """
    present = F.lit(True)
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        present = present & column.isNotNull()
        if isinstance(field.dataType, (DoubleType, FloatType)):
            present = present & ~F.isnan(column)
    return df.filter(present)


def rounded(column: Column, places: int) -> Column:
    """``round``, half up on the digits a double prints, without its cost where nothing changes.

    Spark rounds a double by way of its text. A double that equals a whole number of units of the
    last place is its own result: below 1e9 and up to six places its digits cannot lie nearer to
    another unit. Adding zero turns -0.0 into 0.0, as ``round`` does.
    """
    if places > 6:
        return F.round(column, places)
    units = F.lit(10.0**places)
    settled = (F.abs(column) < 1e9) & (column == F.rint(column * units) / units)
    return F.when(settled, column + F.lit(0.0)).otherwise(F.round(column, places))


def parse_date_text(name: str) -> Column:
    """Date text as a timestamp, or null when no format fits.

    A failed attempt raises and catches an exception inside Spark, so the format that the text's
    separators point to is tried first. No text fits two formats, so the result is that of trying
    them in turn.
    """
    text = F.col(f"`{name}`")
    spaced, zoned, slashed, day = [F.try_to_timestamp(text, F.lit(f)) for f in DATE_FORMATS]
    likely = (
        F.when(F.substring(text, 3, 1) == "/", slashed)
        .when(F.substring(text, 11, 1) == "T", zoned)
        .when(F.length(text) == 10, day)
        .otherwise(spaced)
    )
    return F.coalesce(likely, spaced, zoned, slashed, day)


def is_date_text(field: StructField) -> bool:
    return isinstance(field.dataType, StringType) and "date" in field.name.lower()


def _clean(df: DataFrame, places: int, zone: str, time_form) -> DataFrame:
    """One projection over the null-free rows; the column's type picks its treatment."""

    def settle(field: StructField) -> Column:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, DoubleType):
            column = rounded(column, places)
        elif isinstance(field.dataType, TIME_TYPES):
            column = time_form(column)
        elif is_date_text(field):
            column = time_form(F.from_utc_timestamp(parse_date_text(field.name), zone))
        return column.alias(field.name)

    return drop_nulls(df).select(*[settle(f) for f in df.schema.fields])


def clean(df: DataFrame, places: int = PLACES, zone: str = LOCAL_ZONE) -> DataFrame:
    """Null-free rows, doubles rounded, dates and timestamps as ``yyyy-MM-dd HH:mm:ss`` text.

    Text columns with ``date`` in their name are parsed as UTC and shown in ``zone``; text that
    is no date becomes null there and keeps its row.
    """
    return _clean(df, places, zone, rendered)


def clean_typed(df: DataFrame, places: int = PLACES, zone: str = LOCAL_ZONE) -> DataFrame:
    """``clean`` with timestamps cut to the second instead of rendered.

    Grouping and ordering by these equals grouping and ordering by the text, at eight bytes a
    value; the text is rendered once, on the rows that reach a sink.
    """
    return _clean(df, places, zone, lambda time: F.date_trunc("second", time))


def render_times(df: DataFrame) -> DataFrame:
    """Timestamps left by ``clean_typed`` as text."""
    return df.select(*[
        (rendered(F.col(f"`{f.name}`")) if isinstance(f.dataType, TIME_TYPES)
         else F.col(f"`{f.name}`")).alias(f.name)
        for f in df.schema.fields
    ])
