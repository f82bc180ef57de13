"""One call per batch of any family."""

from __future__ import annotations

import functools
import hashlib
import operator
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from railpulse.functions.routing import MARK_OF
from railpulse.plans.dht11 import run_dht11
from railpulse.plans.dps import run_dps
from railpulse.plans.passthrough import run_passthrough
from railpulse.plans.piezo import UnknownTrack, run_piezo
from railpulse.plans.tof import run_tof
from railpulse.schemas import MEASURES, TOO_LARGE
from railpulse.session import Scratch
from railpulse.sinks.files import Zones, claim_batch, observed
from railpulse.sources.dumps import Dimensions
from railpulse.sources.readings import FILE_TYPES, MISFIT, files_of, read_readings


UTC = ("UTC", "Etc/UTC", "Z", "GMT", "+00:00")


class RowCounts(NamedTuple):
    """Rows read from the raw files, those left by cleaning, and those set aside because a value
    does not fit its type. The others held a null."""

    read: int
    kept: int
    misfits: int = 0


def run_family(family: str, readings: DataFrame, dims: Dimensions, zones: Zones, batch: int,
               scratch_folder: str | None = None, owner: str = "batch run", dht11_sequence: list[str] | None = None, **options) -> RowCounts:
    """Clean a batch of readings and write its trusted rows, fact rows and client extract.

    Only the trusted write reads the raw files, and it counts their rows on the way; the rest
    starts from the trusted rows. Running a batch number again replaces what the same ``owner``
    wrote before; a number of another owner's raises. The session's zone must be UTC.
    ``dht11_sequence`` goes to the DHT11 run, all other options to the piezo run.
    """
    spark = readings.sparkSession
    if spark.conf.get("spark.sql.session.timeZone") not in UTC:
        raise ValueError("set spark.sql.session.timeZone to UTC: event times are read and shown in it")
    if family not in MARK_OF:
        raise ValueError(f"no such family: {family}")
    claim_batch(spark, zones, family, batch, owner)
    if MISFIT in readings.columns:
        readings = readings.withColumn(MISFIT, F.coalesce(MISFIT, beyond_facts(readings, family)))
    counted = Observation()
    misfits = F.count(MISFIT) if MISFIT in readings.columns else F.sum(F.lit(0))
    raw, readings = readings, readings.observe(counted, F.count(F.lit(1)).alias("rows_read"), misfits.alias("misfits"))
    if MISFIT in readings.columns:
        readings = readings.where(F.col(MISFIT).isNull()).drop(MISFIT)

    def seen() -> dict:
        return observed(counted, raw, rows_read=F.count(F.lit(1)), misfits=misfits)

    def set_aside() -> int:
        """Rows that do not fit; only where there are any are the raw files read once more."""
        found = seen()["misfits"] or 0
        if found:
            raw.where(F.col(MISFIT).isNotNull()).write.mode("overwrite").parquet(zones.misfits(family, batch))
        return found

    with Scratch(spark, scratch_folder) as scratch:
        if family == "tof":
            kept = run_tof(readings, dims.metadata, zones, batch, scratch)
        elif family == "dht11":
            kept = run_dht11(readings, dims.metadata, zones, batch, dht11_sequence)
        elif family == "dps":
            kept = run_dps(readings, dims.metadata, dims.circuits, zones, batch)
        elif family == "piezo":
            try:
                kept = run_piezo(readings, dims, zones, batch, scratch, **options)
            except UnknownTrack:
                set_aside()
                raise
        else:
            kept = run_passthrough(readings, family, zones, batch)
    return RowCounts(seen()["rows_read"], kept, set_aside())


def beyond_facts(readings: DataFrame, family: str) -> Column:
    """A row as text where a measure is too large for the decimals of the fact tables, else null."""
    large = [F.abs(F.col(name)) >= TOO_LARGE for name in MEASURES.get(family, [])]
    own = [F.col(f"`{name}`").cast("string") for name in readings.columns if name not in (MISFIT, "source_row", *FILE_TYPES)]
    found = functools.reduce(operator.or_, large, F.lit(False))
    return F.when(found, F.concat_ws(",", *[F.coalesce(value, F.lit("")) for value in own]))


def run_files(spark: SparkSession, family: str, path: str | list[str], dims: Dimensions, zones: Zones,
              batch: int, **options) -> RowCounts:
    """``run_family`` over raw files, each by its own header. The batch is owned by the set of its files: the same
    files may replace it, others may not."""
    options.setdefault("owner", f"files {files_mark(spark, path)}")
    return run_family(family, read_readings(spark, path, family, misfits=True, arrival=True), dims, zones, batch, **options)


def files_mark(spark: SparkSession, path: str | list[str]) -> str:
    """A digest of the names of all files in ``path``."""
    return hashlib.sha256("\n".join(files_of(spark, path)).encode()).hexdigest()
