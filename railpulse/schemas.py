"""Column contracts of the reading families, the dimensions and the fact tables.

Types are declared, never inferred: Spark infers an id such as ``T1`` as a timestamp.
"""

from __future__ import annotations

from pyspark.sql.types import StructType

# Raw columns by family. Optical files may carry any header.
READINGS = {
    "dht11": "sensor_id bigint, min double, max double, timestamp timestamp, "
             "temperature_c double, humidity_percent double",
    "dps": "sensor_id bigint, statusDPS string, picoTensao_kV double, "
           "correnteSurto_kA double, dataHora timestamp",
    "omron": "y int, x int, `valor-matriz` double, plataforma bigint",
    "piezo": "trem_id bigint, sensor_id bigint, pressure_kpa double, dataHora timestamp",
    "tof": "sensor_id bigint, timestamp timestamp, y int, x int, dist_mm double",
}

# Attributes of the dimension tables; int and double mark number attributes.
DIMENSIONS = {
    "Circuito": "sensor_id string, circuito_id string, modelo string, categoria string, "
                "prioridade int",
    "Linha": "linha_id string, cor string",
    "PiezoSensorDistancia": "sensor_id string, sensor_id_2 string, distancia double",
    "SensorMetadata": "sensor_id string, trem_id string, carro_id string",
    "Trilho": "sensor_id string, trilho_id string, linha_id string",
}

# Keys of the fact tables.
FACT_KEYS = {
    "DHT11Data": ["sensor_id", "datahora"],
    "DpsData": ["sensor_id", "datahora"],
    "PiezoData": ["trem_id"],
    "TofData": ["sensor_id", "datahora"],
}

# The fact table of each family that has one.
TABLE_OF = {"dht11": "DHT11Data", "dps": "DpsData", "piezo": "PiezoData", "tof": "TofData"}

# The column by whose day trusted rows may be laid out, of the families that have one.
EVENT_TIME = {"dht11": "timestamp", "dps": "dataHora", "piezo": "dataHora", "tof": "timestamp"}

# Fact tables hold numbers as decimals of the digits they print: measures as cleaning rounds them, to five places, and
# what is computed from them with room for all digits of a double from 1e-8 on.
MEASURED = "decimal(20,5)"
COMPUTED = "decimal(38,24)"

# The measures that go to fact tables, by family, and the least size that these do not take.
MEASURES = {"dht11": ["temperature_c", "humidity_percent"], "dps": ["picoTensao_kV", "correnteSurto_kA"], "piezo": ["pressure_kpa"]}
TOO_LARGE = 1e14

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def readings_schema(family: str) -> StructType:
    return StructType.fromDDL(READINGS[family])


def dimension_schema(table: str) -> StructType:
    return StructType.fromDDL(DIMENSIONS[table])
