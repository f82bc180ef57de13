"""DPS: surge protector status."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railpulse.functions.columns import as_decimal, rendered, sensor_key
from railpulse.operators.cleaning import clean_typed
from railpulse.operators.lookups import known, with_dimension
from railpulse.schemas import FACT_KEYS, MEASURED
from railpulse.sinks.files import Zones, write_client, write_trusted
from railpulse.sinks.keyed import last_written, put_batch


def dps_registry(df: DataFrame, metadata: DataFrame) -> DataFrame:
    """Fact rows of sensors that have metadata; no metadata column is taken."""
    keyed = df.withColumn("sensor_id", sensor_key("sensor_id"))
    return known(keyed, metadata, "sensor_id").select(
        F.col("statusDPS").alias("status"), rendered("dataHora").alias("datahora"),
        as_decimal("picoTensao_kV", MEASURED).alias("tensao"), as_decimal("correnteSurto_kA", MEASURED).alias("corrente"), "sensor_id")


def dps_client(df: DataFrame, metadata: DataFrame, circuits: DataFrame) -> DataFrame:
    """Readings of sensors that have metadata and a circuit."""
    keyed = df.withColumn("sensor_id", sensor_key("sensor_id"))
    full = with_dimension(with_dimension(keyed, metadata, "sensor_id"), circuits, "sensor_id")
    return full.select(
        F.col("circuito_id").alias("ID_CIRCUITO"), F.col("modelo").alias("MODELO"),
        F.col("categoria").alias("CATEGORIA"), F.col("prioridade").alias("PRIORIDADE"),
        F.col("statusDPS").alias("STATUS"), F.col("carro_id").alias("NUM_CARRO"),
        F.col("trem_id").alias("NUM_TREM"), rendered("dataHora").alias("DATAHORA"),
        "picoTensao_kV", "correnteSurto_kA")


def run_dps(readings: DataFrame, metadata: DataFrame, circuits: DataFrame, zones: Zones, batch: int) -> int:
    trusted, kept = write_trusted(clean_typed(readings), zones, "dps", batch)
    latest = last_written(trusted, ["sensor_id", "dataHora"])
    put_batch(dps_registry(latest, metadata), zones.table("DpsData"), batch, FACT_KEYS["DpsData"], zones.buckets)
    write_client(dps_client(trusted, metadata, circuits), zones, "dps", batch)
    return kept
