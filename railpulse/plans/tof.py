"""ToF depth frames: occupancy per frame and block depth maps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railpulse.functions.columns import as_decimal, below, block_of, rendered, sensor_key
from railpulse.operators.cleaning import clean_typed, render_times
from railpulse.operators.lookups import with_dimension
from railpulse.session import Scratch
from railpulse.schemas import FACT_KEYS
from railpulse.sinks.files import Zones, write_client, write_csv, write_trusted
from railpulse.sinks.keyed import put_batch
from railpulse.sinks.versions import put_version

OCCUPIED_BELOW_MM = 1750
BLOCK = 4
FRAME = ["sensor_id", "timestamp"]


def tof_block_sums(df: DataFrame, threshold_mm: int = OCCUPIED_BELOW_MM, block: int = BLOCK) -> DataFrame:
    """One pass over the points that serves both results: sums per frame and block."""
    return (
        df.groupBy(*FRAME, block_of("y", block).alias("y_block"), block_of("x", block).alias("x_block"))
        .agg(F.sum(below("dist_mm", threshold_mm)).alias("occupied_points"),
             F.count(F.lit(1)).alias("total_points"),
             F.avg("dist_mm").alias("dist"))
    )


def tof_frame_counts(df: DataFrame, threshold_mm: int = OCCUPIED_BELOW_MM) -> DataFrame:
    """Occupied and total points per frame, and the occupied share in percent."""
    counts = df.groupBy(*FRAME).agg(
        F.sum(below("dist_mm", threshold_mm)).alias("occupied_points"),
        F.count(F.lit(1)).alias("total_points"))
    return _with_share(counts)


def frame_counts_from_blocks(sums: DataFrame) -> DataFrame:
    counts = sums.groupBy(*FRAME).agg(
        F.sum("occupied_points").alias("occupied_points"), F.sum("total_points").alias("total_points"))
    return _with_share(counts)


def _with_share(counts: DataFrame) -> DataFrame:
    share = F.col("occupied_points") / F.col("total_points") * 100
    return counts.withColumn("ocupacao_media", share)


def _occupancy(counts: DataFrame, metadata: DataFrame) -> DataFrame:
    keyed = counts.withColumn("sensor_id", sensor_key("sensor_id"))
    return with_dimension(keyed, metadata, "sensor_id", "left").select(
        "sensor_id", "trem_id", "carro_id", rendered("timestamp").alias("datahora"), "ocupacao_media")


def _block_map(blocks: DataFrame, metadata: DataFrame) -> DataFrame:
    keyed = blocks.withColumn("sensor_id", sensor_key("sensor_id"))
    return with_dimension(keyed, metadata, "sensor_id").select(
        "y_block", "x_block", "dist", "timestamp", "trem_id", "carro_id")


def tof_occupancy(df: DataFrame, metadata: DataFrame, threshold_mm: int = OCCUPIED_BELOW_MM) -> DataFrame:
    """Occupancy per frame with the sensor's train and car; unknown sensors keep null."""
    return _occupancy(tof_frame_counts(df, threshold_mm), metadata)


def tof_block_mean(df: DataFrame, block: int = BLOCK) -> DataFrame:
    """Mean distance per frame and block."""
    return df.groupBy(
        *FRAME, block_of("y", block).alias("y_block"), block_of("x", block).alias("x_block")
    ).agg(F.avg("dist_mm").alias("dist"))


def tof_block_map(df: DataFrame, metadata: DataFrame, block: int = BLOCK) -> DataFrame:
    """Block means of known sensors with train and car."""
    return render_times(_block_map(tof_block_mean(df, block), metadata))


def by_block(block_map: DataFrame) -> DataFrame:
    """Sink order, which is by block. The columns after it let the ranges split a block over tasks; only blocks are sorted
    within a range, as text and doubles take long to compare."""
    ranges = block_map.repartitionByRange("y_block", "x_block", "timestamp", "trem_id", "carro_id", "dist")
    return ranges.sortWithinPartitions("y_block", "x_block")


def tof_records(occupancy: DataFrame) -> DataFrame:
    """Fact rows."""
    return occupancy.withColumn("ocupacao_media", as_decimal("ocupacao_media")).withColumnRenamed("ocupacao_media", "ocupacao")


def run_tof(readings: DataFrame, metadata: DataFrame, zones: Zones, batch: int, scratch: Scratch) -> int:
    trusted, kept = write_trusted(clean_typed(readings), zones, "tof", batch)
    sums = scratch.save(tof_block_sums(trusted), "tof-blocks")
    occupancy = scratch.save(_occupancy(frame_counts_from_blocks(sums), metadata), "tof-occupancy")
    put_version(occupancy, zones.occupancy(), write=write_csv)
    put_batch(tof_records(occupancy), zones.table("TofData"), batch, FACT_KEYS["TofData"], zones.buckets)
    write_client(by_block(_block_map(sums, metadata)), zones, "tof", batch)
    return kept
