"""Omron and optical: cleaned rows go on unchanged."""

from __future__ import annotations

from pyspark.sql import DataFrame

from railpulse.operators.cleaning import clean, clean_typed
from railpulse.sinks.files import Zones, write_client, write_trusted
from railpulse.sources.optical import drop_kinds, kinds_in, put_kinds
from railpulse.sources.readings import without_arrival


def passthrough(df: DataFrame) -> DataFrame:
    return clean(df)


def run_passthrough(readings: DataFrame, family: str, zones: Zones, batch: int) -> int:
    spark = readings.sparkSession
    if family == "optical":
        # Never a note that tells of other rows than those that are there.
        drop_kinds(spark, zones, family, batch)
    trusted, kept = write_trusted(clean_typed(readings), zones, family, batch)
    if family == "optical":
        put_kinds(spark, zones, family, batch, kinds_in(without_arrival(readings).schema))
    write_client(without_arrival(trusted), zones, family, batch)
    return kept
