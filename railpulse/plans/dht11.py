"""DHT11: temperature and humidity."""

from __future__ import annotations

from pyspark.sql import DataFrame

from railpulse.functions.columns import as_decimal, rendered, sensor_key
from railpulse.operators.cleaning import clean_typed, render_times
from railpulse.operators.lookups import with_dimension
from railpulse.schemas import FACT_KEYS, MEASURED
from railpulse.sinks.files import Zones, write_client, write_trusted
from railpulse.sinks.keyed import last_written, put_batch
from railpulse.sources.readings import without_arrival


def dht11_registry(df: DataFrame, metadata: DataFrame) -> DataFrame:
    """Fact rows of sensors that have metadata."""
    keyed = df.withColumn("sensor_id", sensor_key("sensor_id"))
    return with_dimension(keyed, metadata, "sensor_id").select(
        "trem_id", rendered("timestamp").alias("datahora"), "carro_id", "sensor_id",
        as_decimal("temperature_c", MEASURED).alias("temperatura"), as_decimal("humidity_percent", MEASURED).alias("umidade"))


def dht11_client(df: DataFrame, metadata: DataFrame) -> DataFrame:
    """Readings of known sensors with train and car; the sensor id stays as read."""
    keyed = df.withColumn("_key", sensor_key("sensor_id"))
    dim = metadata.withColumnRenamed("sensor_id", "_key").select("_key", "trem_id", "carro_id")
    return render_times(with_dimension(keyed, dim, "_key").drop("_key"))


def run_dht11(readings: DataFrame, metadata: DataFrame, zones: Zones, batch: int, sequence: list[str] | None = None) -> int:
    """Of rows with one key that highest in ``sequence`` is the batch's fact row, by default that written last. Readers of
    the table name the same sequence in its columns, since only they compare batches."""
    trusted, kept = write_trusted(clean_typed(readings), zones, "dht11", batch)
    latest = last_written(trusted, ["sensor_id", "timestamp"], sequence)
    put_batch(dht11_registry(latest, metadata), zones.table("DHT11Data"), batch, FACT_KEYS["DHT11Data"], zones.buckets)
    client = dht11_client(without_arrival(trusted), metadata)
    write_client(client, zones, "dht11", batch)
    return kept
