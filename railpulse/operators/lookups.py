"""Joins of facts with dimension tables.

No side is forced into a broadcast. Dimensions are read from files, so the planner knows their
size: under ``spark.sql.autoBroadcastJoinThreshold`` it broadcasts them, beyond it both sides are
shuffled on the key and AQE splits the partitions of hot sensors. Each dimension is joined on its
own, since the estimate for a join of two dimensions is the product of their sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railpulse.functions.columns import bare_sensor, line_label


def with_dimension(df: DataFrame, dim: DataFrame, on: str, how: str = "inner") -> DataFrame:
    return df.join(dim, on, how)


def known(df: DataFrame, dim: DataFrame, on: str) -> DataFrame:
    return df.join(dim.select(on), on, "left_semi")


def unknown(df: DataFrame, dim: DataFrame, on: str) -> DataFrame:
    return df.join(dim.select(on), on, "left_anti")


def symmetric(distances: DataFrame) -> DataFrame:
    """Every edge in both directions; an edge stored both ways appears twice each way."""
    edges = distances.select("sensor_id", "sensor_id_2", "distancia")
    turned = distances.select(
        F.col("sensor_id_2").alias("sensor_id"), F.col("sensor_id").alias("sensor_id_2"),
        "distancia")
    return edges.unionByName(turned)


def with_distance(pairs: DataFrame, distances: DataFrame) -> DataFrame:
    """Add ``distancia`` between origin and destination, null where the edge is unknown.

    The sensor numbers of readings are compared with those behind the prefix in the edges, as
    numbers; an edge whose ids are no numbers fits no reading.
    """
    both_ways = symmetric(distances).select(
        bare_sensor("sensor_id").try_cast("bigint").alias("_from"),
        bare_sensor("sensor_id_2").try_cast("bigint").alias("_to"), "distancia")
    here = (F.col("ID_SENSOR_ORIGEM").cast("bigint") == F.col("_from")) & (
        F.col("ID_SENSOR_DESTINO").cast("bigint") == F.col("_to"))
    return pairs.join(both_ways, here, "left").drop("_from", "_to")


def with_track_and_line(df: DataFrame, tracks: DataFrame, lines: DataFrame) -> DataFrame:
    """Add ``trilho_id`` and the line's label by ``sensor_id``."""
    return (
        df.join(tracks.select("sensor_id", "trilho_id", "linha_id"), "sensor_id")
        .join(lines.select("linha_id", "cor"), "linha_id")
        .withColumn("linha", line_label("linha_id", "cor"))
    )
