"""The test tables in the shape of readings and dimensions. Every view takes the whole table.

Sensor ids run past the ids of the dimensions, so some lookups miss.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railpulse.sources.dumps import Dimensions

PIEZO_SENSORS = 30


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def piezo_raw(spark, sf_dir, time="ts") -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("trem_id"), (F.col("event_id") % PIEZO_SENSORS).alias("sensor_id"),
        F.col("value").alias("pressure_kpa"), F.expr(time).alias("dataHora"))


def tof_raw(spark, sf_dir) -> DataFrame:
    """Frames of a supplier and month; negative rows on purpose, whole-number distances."""
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_suppkey") + F.col("l_linenumber")).alias("sensor_id"),
        F.date_trunc("month", "l_shipdate").alias("timestamp"),
        (F.col("l_partkey") % 16 - 8).alias("y"), (F.col("l_orderkey") % 16).alias("x"),
        (F.col("l_quantity") * 70).alias("dist_mm"))


def dht11_raw(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("sensor_id"), F.lit(18).alias("min"), F.lit(24).alias("max"),
        F.col("ts").alias("timestamp"), F.col("value").alias("temperature_c"),
        (F.col("value") / 7).alias("humidity_percent"))


def dht11_damaged(spark, sf_dir) -> DataFrame:
    """Every seventh event has a temperature that is no number."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("sensor_id"), F.lit(18).alias("min"), F.lit(24).alias("max"), F.col("ts").alias("timestamp"),
        F.when(F.col("event_id") % 7 == 0, "n/a").otherwise(F.col("value").cast("string")).alias("temperature_c"),
        (F.col("value") / 7).alias("humidity_percent"))


def dps_raw(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("sensor_id"),
        F.when(F.col("value") < 20, "OK").otherwise("TROCAR").alias("statusDPS"),
        (F.col("value") / 10).alias("picoTensao_kV"), (F.col("value") / 13).alias("correnteSurto_kA"),
        F.col("ts").alias("dataHora"))


def omron_raw(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_linenumber").alias("y"), F.col("l_partkey").alias("x"),
        (F.col("l_discount") * F.col("l_tax") / 3).alias("valor-matriz"),
        F.col("l_suppkey").alias("plataforma"))


def null_cases(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", F.expr("nullif(event_type, 'error')").alias("et"),
        F.expr("nullif(user_id % 5, 3)").alias("u"), (F.col("value") / 7).alias("v"))


def date_texts(spark, sf_dir) -> DataFrame:
    """Event times as text in each of the four formats, and as text that is no date."""
    forms = [
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
        F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("+0000")),
        F.date_format("ts", "dd/MM/yyyy HH:mm:ss"),
        F.date_format("ts", "yyyy-MM-dd"),
    ]
    which = F.lit("no date")
    for at, form in enumerate(forms):
        which = F.when(F.col("event_id") % 5 == at, form).otherwise(which)
    return table(spark, sf_dir, "events").select("event_id", "value", "ts", which.alias("ReadDate"))


def route_keys(spark, sf_dir) -> DataFrame:
    """File keys of each family, some with two marks and some with none, and the family asked for."""
    names = ["dht11", "dps", "optical", "omron", "piezo", "tof", "tof_dht", "other"]
    asked = ["dht11", "dps", "optical", "omron", "piezo", "tof"]

    def nth(values, by):
        return F.element_at(F.array(*[F.lit(v) for v in values]), (F.col("event_id") % by + 1).cast("int"))

    return table(spark, sf_dir, "events").select(
        "event_id",
        F.concat(nth(names, 8), F.lit("/"), F.col("event_id").cast("string"), F.lit(".csv")).alias("key"),
        nth(asked, 6).alias("asked"))


def metadata(spark, sf_dir) -> DataFrame:
    """Train and car by sensor; some sensors are registered without either."""
    placed = F.col("s_acctbal") >= 0
    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("S"), F.col("s_suppkey")).alias("sensor_id"),
        F.when(placed, F.concat(F.lit("T"), F.col("s_nationkey"))).alias("trem_id"),
        F.when(placed, F.concat(F.lit("C"), F.col("s_suppkey") % 6)).alias("carro_id"))


def circuits(spark, sf_dir) -> DataFrame:
    """Every second sensor has a circuit."""
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("S"), F.col("p_partkey") * 2).alias("sensor_id"),
        F.concat(F.lit("CC"), F.col("p_partkey")).alias("circuito_id"),
        F.col("p_type").alias("modelo"), F.col("p_brand").alias("categoria"),
        F.col("p_size").alias("prioridade"))


def distances(spark, sf_dir) -> DataFrame:
    a, b = F.col("s_suppkey") % PIEZO_SENSORS, F.col("s_nationkey")
    edges = table(spark, sf_dir, "supplier").groupBy(a.alias("a"), b.alias("b")).count()
    return edges.select(
        F.concat(F.lit("S"), F.col("a")).alias("sensor_id"),
        F.concat(F.lit("S"), F.col("b")).alias("sensor_id_2"),
        (F.col("a") * 100 + F.col("b") * 10 + 50).cast("double").alias("distancia"))


def tracks(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.concat(F.lit("S"), F.col("n_nationkey")).alias("sensor_id"),
        F.concat(F.lit("R"), F.col("n_regionkey"), F.lit("-"), F.col("n_nationkey")).alias("trilho_id"),
        F.col("n_regionkey").cast("string").alias("linha_id"))


def lines(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "region").select(
        F.col("r_regionkey").cast("string").alias("linha_id"), F.col("r_name").alias("cor"))


def lines_without_asia(spark, sf_dir) -> DataFrame:
    """A register in which one line is missing."""
    return lines(spark, sf_dir).where("cor <> 'ASIA'")


def dimensions(spark, sf_dir) -> Dimensions:
    return Dimensions(metadata(spark, sf_dir), circuits(spark, sf_dir), distances(spark, sf_dir),
                      tracks(spark, sf_dir), lines(spark, sf_dir))
