"""The same results as ``queries`` in SQL that DuckDB runs on the same tables.

Doubles are either arithmetic on one row or sums of whole numbers, so no summation order shows.
"""

from __future__ import annotations

FMT = "'%Y-%m-%d %H:%M:%S'"


def shown(time: str) -> str:
    return f"strftime({time}, {FMT})"


def edge(column: str) -> str:
    return f"regexp_replace({column}, '^S', '')"


# Test tables as readings and dimensions

DISTANCES = """
dist AS (
  SELECT 'S' || a AS sensor_id, 'S' || b AS sensor_id_2,
         CAST(a * 100 + b * 10 + 50 AS DOUBLE) AS distancia
  FROM (SELECT DISTINCT s_suppkey % 30 AS a, s_nationkey AS b FROM supplier)),
sym AS (
  SELECT sensor_id, sensor_id_2, distancia FROM dist
  UNION ALL SELECT sensor_id_2, sensor_id, distancia FROM dist)"""

METADATA = """
meta AS (
  SELECT 'S' || s_suppkey AS sensor_id,
         CASE WHEN s_acctbal >= 0 THEN 'T' || s_nationkey END AS trem_id,
         CASE WHEN s_acctbal >= 0 THEN 'C' || (s_suppkey % 6) END AS carro_id
  FROM supplier)"""

CIRCUITS = """
circ AS (
  SELECT 'S' || (p_partkey * 2) AS sensor_id, 'CC' || p_partkey AS circuito_id, p_type AS modelo,
         p_brand AS categoria, p_size AS prioridade
  FROM part)"""

TRACKS = """
track AS (
  SELECT 'S' || n_nationkey AS sensor_id, 'R' || n_regionkey || '-' || n_nationkey AS trilho_id,
         CAST(n_regionkey AS VARCHAR) AS linha_id
  FROM nation),
line AS (SELECT CAST(r_regionkey AS VARCHAR) AS linha_id, r_name AS cor FROM region)"""


def piezo_clean(time: str = "date_trunc('second', ts)") -> str:
    return f"""
piezo AS (
  SELECT user_id AS trem_id, event_id % 30 AS sensor_id, round(value, 5) AS pressure_kpa,
         {time} AS t
  FROM events
  WHERE user_id IS NOT NULL AND event_id IS NOT NULL AND value IS NOT NULL AND ts IS NOT NULL),
numbered AS (
  SELECT *, row_number() OVER w AS row_num, lag(sensor_id) OVER w AS prev_sensor,
         lag(pressure_kpa) OVER w AS prev_pressure, lag(t) OVER w AS prev_t
  FROM piezo
  WINDOW w AS (PARTITION BY trem_id ORDER BY t, sensor_id, pressure_kpa)),
pairs AS (
  SELECT trem_id AS ID_TREM, prev_sensor AS ID_SENSOR_ORIGEM, sensor_id AS ID_SENSOR_DESTINO,
         (prev_pressure + pressure_kpa) / 2 AS PRESSAO, prev_t AS t1, t AS t2,
         CAST(epoch(t) AS BIGINT) - CAST(epoch(prev_t) AS BIGINT) AS took
  FROM numbered WHERE row_num % 2 = 0)"""


WITH_DISTANCE = f"""
measured AS (
  SELECT p.*, s.distancia
  FROM pairs p LEFT JOIN sym s
    ON CAST(p.ID_SENSOR_ORIGEM AS VARCHAR) = {edge('s.sensor_id')}
   AND CAST(p.ID_SENSOR_DESTINO AS VARCHAR) = {edge('s.sensor_id_2')}),
speeds AS (
  SELECT *, CASE WHEN took = 0 THEN NULL ELSE distancia / took END * 3.6 AS VELOCIDADE
  FROM measured),
segments AS (SELECT * FROM speeds WHERE ID_SENSOR_ORIGEM <> ID_SENSOR_DESTINO)"""

HEADWAYS = """
lagged AS (
  SELECT *, lag(t2) OVER (PARTITION BY ID_SENSOR_ORIGEM
                          ORDER BY t1, ID_TREM, t2, ID_SENSOR_DESTINO, PRESSAO, VELOCIDADE) AS prev_end
  FROM segments),
headways AS (
  SELECT *, CAST(CAST(epoch(t1) AS BIGINT) - CAST(epoch(prev_end) AS BIGINT) AS DOUBLE) AS HEADWAY
  FROM lagged)"""

TOF_CLEAN = """
tof AS (
  SELECT l_suppkey + l_linenumber AS sensor_id, date_trunc('month', l_shipdate) AS t,
         l_partkey % 16 - 8 AS y, l_orderkey % 16 AS x, round(l_quantity * 70, 5) AS dist_mm
  FROM lineitem
  WHERE l_suppkey IS NOT NULL AND l_linenumber IS NOT NULL AND l_shipdate IS NOT NULL
    AND l_partkey IS NOT NULL AND l_orderkey IS NOT NULL AND l_quantity IS NOT NULL),
frames AS (
  SELECT sensor_id, t, CAST(sum(CASE WHEN dist_mm < 1750 THEN 1 ELSE 0 END) AS BIGINT) AS occupied_points,
         count(*) AS total_points
  FROM tof GROUP BY sensor_id, t),
shares AS (
  SELECT *, CAST(occupied_points AS DOUBLE) / CAST(total_points AS DOUBLE) * 100 AS ocupacao_media
  FROM frames),
blocks AS (
  SELECT sensor_id, t, CAST(floor(y / 4.0) AS INTEGER) AS y_block,
         CAST(floor(x / 4.0) AS INTEGER) AS x_block, avg(dist_mm) AS dist
  FROM tof GROUP BY ALL)"""

DHT11_CLEAN = f"""
dht AS (
  SELECT user_id AS sensor_id, 18 AS "min", 24 AS "max", {shown('ts')} AS "timestamp",
         round(value, 5) AS temperature_c, round(value / 7, 5) AS humidity_percent
  FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL AND value IS NOT NULL),
dht_keyed AS (SELECT * REPLACE ('S' || sensor_id AS sensor_id) FROM dht)"""

DPS_CLEAN = f"""
dps AS (
  SELECT 'S' || user_id AS sensor_id, CASE WHEN value < 20 THEN 'OK' ELSE 'TROCAR' END AS statusDPS,
         round(value / 10, 5) AS picoTensao_kV, round(value / 13, 5) AS correnteSurto_kA,
         {shown('ts')} AS dataHora
  FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL AND value IS NOT NULL)"""

DATE_TEXTS = f"""
dates AS (
  SELECT event_id, round(value, 5) AS value, {shown('ts')} AS ts,
         CASE WHEN event_id % 5 = 4 THEN NULL
              WHEN event_id % 5 = 3 THEN date_trunc('day', ts)
              ELSE date_trunc('second', ts) END AS parsed
  FROM events WHERE event_id IS NOT NULL AND value IS NOT NULL AND ts IS NOT NULL)"""

ROUTE_KEYS = """
named AS (
  SELECT event_id,
         (['dht11', 'dps', 'optical', 'omron', 'piezo', 'tof', 'tof_dht', 'other'])[event_id % 8 + 1]
           || '/' || event_id || '.csv' AS "key",
         (['dht11', 'dps', 'optical', 'omron', 'piezo', 'tof'])[event_id % 6 + 1] AS asked
  FROM events)"""

# 2024 lies wholly in standard time there, three hours behind UTC.
LOCAL = "parsed - INTERVAL 3 HOUR"

PAIR_COLUMNS = f"""ID_TREM, ID_SENSOR_ORIGEM, ID_SENSOR_DESTINO, PRESSAO,
  {shown('t1')} AS DATAHORA_INICIO, {shown('t2')} AS DATAHORA_FIM"""

REGISTRY = f"""
registry AS (
  SELECT 'T' || ID_TREM AS trem_id, 'S' || ID_SENSOR_ORIGEM AS sensor_id_origem,
         'S' || ID_SENSOR_DESTINO AS sensor_id_destino, PRESSAO AS pressao, VELOCIDADE AS velocidade,
         {shown('t1')} AS datahora_inicio, {shown('t2')} AS datahora_fim
  FROM segments)"""

LATEST = """
SELECT * EXCLUDE (place) FROM (
  SELECT *, row_number() OVER (PARTITION BY trem_id ORDER BY datahora_inicio DESC, sensor_id_origem DESC,
                               sensor_id_destino DESC, pressao DESC, velocidade DESC NULLS LAST) AS place
  FROM registry) WHERE place = 1"""


def with_(*parts: str) -> str:
    return "WITH" + ",".join(parts)


def oracle() -> dict[str, str]:
    pairs = with_(piezo_clean())
    measured = with_(piezo_clean(), DISTANCES, WITH_DISTANCE)
    by_day = with_(piezo_clean("date_trunc('day', ts)"), DISTANCES, WITH_DISTANCE)
    headways = with_(piezo_clean(), DISTANCES, WITH_DISTANCE, HEADWAYS)
    tof, dht = with_(TOF_CLEAN), with_(DHT11_CLEAN)
    numbered = f"""{pairs} SELECT trem_id, sensor_id, pressure_kpa, {shown('t')} AS dataHora, row_num
                   FROM numbered"""
    all_pairs = f"{pairs} SELECT {PAIR_COLUMNS} FROM pairs"
    segments = f"{measured} SELECT {PAIR_COLUMNS}, VELOCIDADE FROM segments"
    with_gap = f"{headways} SELECT {PAIR_COLUMNS}, VELOCIDADE, HEADWAY FROM headways"
    counts = f"""{tof} SELECT sensor_id, {shown('t')} AS "timestamp", occupied_points, total_points,
                 ocupacao_media FROM shares"""

    sql = {
        "csv_scan": f"""SELECT CAST(user_id AS BIGINT) AS trem_id,
                        CAST(event_id % 30 AS BIGINT) AS sensor_id, value AS pressure_kpa,
                        {shown('ts')} AS dataHora FROM events""",
        "csv_roundtrip": f"""{dht} SELECT CAST(sensor_id AS VARCHAR) AS sensor_id,
            CAST("min" AS VARCHAR) AS "min", CAST("max" AS VARCHAR) AS "max", "timestamp",
            CAST(temperature_c AS VARCHAR) AS temperature_c,
            CAST(humidity_percent AS VARCHAR) AS humidity_percent FROM dht""",
        "optical_scan": """SELECT * REPLACE (CAST(c_custkey AS DOUBLE) AS c_custkey, CAST(c_nationkey AS DOUBLE) AS c_nationkey)
            FROM customer""",
        "optical_batches": """SELECT CAST(c_custkey AS VARCHAR) AS level, CAST(c_custkey AS BIGINT) AS serie, CAST(c_custkey AS DOUBLE) AS share,
            CAST(0 AS BIGINT) AS batch FROM customer
            UNION ALL SELECT c_name, c_custkey + 9007199254740992, c_custkey / 4, 1 FROM customer WHERE c_name IS NOT NULL
            UNION ALL SELECT CAST(c_custkey + 9007199254740992 AS VARCHAR), c_custkey + 9007199254740992, NULL, 2 FROM customer""",
        "row_count": "SELECT count(*) AS rows_read FROM events",
        "typed_attr_unwrap": """SELECT 'S' || c_custkey AS sensor_id,
            CASE WHEN c_acctbal >= 0 THEN 'S' || c_nationkey END AS sensor_id_2,
            c_acctbal AS distancia FROM customer""",
        "dump_split": """SELECT 'S' || c_custkey AS sensor_id, concat_ws('}, {"', c_mktsegment, c_name) AS sensor_id_2,
            c_acctbal AS distancia FROM customer WHERE c_custkey IS NOT NULL""",
        "clean_drop_nulls": """SELECT event_id, et, u FROM (
            SELECT event_id, nullif(event_type, 'error') AS et, nullif(user_id % 5, 3) AS u, value
            FROM events) WHERE et IS NOT NULL AND u IS NOT NULL AND value IS NOT NULL""",
        "clean_round": "SELECT event_id, round(value / 7, 5) AS v FROM events WHERE value IS NOT NULL",
        "clean_format_ts": f"""SELECT o_orderkey, {shown('o_orderdate')} AS o_orderdate FROM orders
            WHERE o_orderkey IS NOT NULL AND o_orderdate IS NOT NULL""",
        "clean_parse_dates": f"{with_(DATE_TEXTS)} SELECT event_id, {shown('parsed')} AS parsed FROM dates",
        "clean_utc_to_local": f"""{with_(DATE_TEXTS)} SELECT event_id, {shown(LOCAL)} AS "ReadDate"
            FROM dates""",
        "clean_full": f"""{with_(DATE_TEXTS)} SELECT event_id, value, ts, {shown(LOCAL)} AS "ReadDate"
            FROM dates""",
        "tof_threshold_flag": """SELECT l_suppkey + l_linenumber AS sensor_id, l_quantity * 70 AS dist_mm,
            CASE WHEN l_quantity * 70 < 1750 THEN 1 ELSE 0 END AS is_occupied FROM lineitem""",
        "even_row_filter": f"{pairs} SELECT trem_id, row_num, sensor_id FROM numbered WHERE row_num % 2 = 0",
        "distinct_endpoints": f"{all_pairs} WHERE ID_SENSOR_ORIGEM <> ID_SENSOR_DESTINO",
        "id_prefix": "SELECT 'T' || user_id AS trem_id, 'S' || (event_id % 30) AS sensor_id FROM events",
        "id_strip_prefix": f"""{with_(METADATA)} SELECT sensor_id, {edge('sensor_id')} AS sensor_num
            FROM meta""",
        "fact_decimals": f'{dht} SELECT sensor_id, "timestamp", temperature_c AS temperatura FROM dht',
        "block_ids": """SELECT y, x, CAST(floor(y / 4.0) AS INTEGER) AS y_block,
            CAST(floor(x / 4.0) AS INTEGER) AS x_block
            FROM (SELECT l_partkey % 16 - 8 AS y, l_orderkey % 16 AS x FROM lineitem)""",
        "lookup_existing": f"""{with_(DHT11_CLEAN, METADATA)} SELECT d.* FROM dht_keyed d
            WHERE EXISTS (SELECT 1 FROM meta m WHERE m.sensor_id = d.sensor_id)""",
        "lookup_missing": f"""{with_(DHT11_CLEAN, METADATA)} SELECT d.* FROM dht_keyed d
            WHERE NOT EXISTS (SELECT 1 FROM meta m WHERE m.sensor_id = d.sensor_id)""",
        "pair_lag": all_pairs,
        "pair_sliced": all_pairs,
        "pair_mixed": f"""{with_(piezo_clean().replace('SELECT user_id AS trem_id', 'SELECT CASE WHEN value < 10 THEN 0 ELSE user_id END AS trem_id', 1))}
            SELECT {PAIR_COLUMNS} FROM pairs""",
        "pair_self_join": f"""{pairs} SELECT e.trem_id AS ID_TREM, o.sensor_id AS ID_SENSOR_ORIGEM,
            e.sensor_id AS ID_SENSOR_DESTINO, (o.pressure_kpa + e.pressure_kpa) / 2 AS PRESSAO,
            {shown('o.t')} AS DATAHORA_INICIO, {shown('e.t')} AS DATAHORA_FIM
            FROM numbered e JOIN numbered o ON e.trem_id = o.trem_id AND e.row_num = o.row_num + 1
            WHERE e.row_num % 2 = 0""",
        "pair_pressure": f"{pairs} SELECT ID_TREM, PRESSAO FROM pairs",
        "piezo_distance_join": f"{measured} SELECT {PAIR_COLUMNS}, distancia FROM measured",
        "symmetric_union": f"{with_(DISTANCES)} SELECT * FROM sym",
        "line_label": f"""{with_(TRACKS)} SELECT t.sensor_id, e.value AS pressure_kpa, t.trilho_id,
            l.linha_id || ' - ' || l.cor AS linha
            FROM events e JOIN track t ON t.sensor_id = 'S' || (e.event_id % 30)
            JOIN line l ON l.linha_id = t.linha_id""",
        "sql_scalar_subquery": f"""{with_(TRACKS)} SELECT t.sensor_id, t.trilho_id, l.linha_id || ' - ' || l.cor AS linha
            FROM track t LEFT JOIN line l ON l.linha_id = t.linha_id AND l.cor <> 'ASIA'""",
        "tof_frame_counts": counts,
        "tof_counts_from_blocks": counts,
        "tof_occupancy": f"""{with_(TOF_CLEAN, METADATA)} SELECT 'S' || s.sensor_id AS sensor_id, m.trem_id,
            m.carro_id, {shown('s.t')} AS datahora, s.ocupacao_media
            FROM shares s LEFT JOIN meta m ON m.sensor_id = 'S' || s.sensor_id""",
        "tof_block_mean": f"""{tof} SELECT sensor_id, {shown('t')} AS "timestamp", y_block, x_block, dist
            FROM blocks""",
        "tof_client": f"""{with_(TOF_CLEAN, METADATA)} SELECT b.y_block, b.x_block, b.dist,
            {shown('b.t')} AS "timestamp", m.trem_id, m.carro_id
            FROM blocks b JOIN meta m ON m.sensor_id = 'S' || b.sensor_id""",
        "row_number_per_train": numbered,
        "row_number_sliced": numbered,
        "lag_previous_end": f"""{headways} SELECT {PAIR_COLUMNS}, VELOCIDADE,
            {shown('prev_end')} AS DATAHORA_FIM_ANTERIOR FROM headways""",
        "headway": with_gap,
        "headway_sliced": with_gap,
        "first_row": """SELECT event_id % 30 AS sensor_id, user_id AS trem_id FROM events
            ORDER BY ts, event_id % 30 LIMIT 1""",
        "time_order": segments,
        "segment_speed": f"{by_day} SELECT {PAIR_COLUMNS}, VELOCIDADE FROM speeds",
        "piezo_segments": segments,
        "piezo_registry": f"{with_(piezo_clean(), DISTANCES, WITH_DISTANCE, REGISTRY)} SELECT * FROM registry",
        "piezo_client": f"""{with_(piezo_clean(), DISTANCES, WITH_DISTANCE, HEADWAYS, TRACKS)}
            SELECT h.ID_TREM AS "Trem ID", h.ID_SENSOR_ORIGEM AS "Sensor ID - Origem",
            h.ID_SENSOR_DESTINO AS "Sensor ID - Destino", h.PRESSAO AS "Pressão (kPa)",
            {shown('h.t1')} AS "Data hora - Inicio", {shown('h.t2')} AS "Data hora - Fim",
            h.VELOCIDADE AS "Velocidade (km/h)", h.HEADWAY AS "Headway(s)", t.trilho_id AS "Trilho",
            l.linha_id || ' - ' || l.cor AS "Linha"
            FROM headways h JOIN track t ON t.sensor_id = 'S' || h.ID_SENSOR_ORIGEM
            JOIN line l ON l.linha_id = t.linha_id""",
        "piezo_unknown_tracks": f"""{with_(piezo_clean(), DISTANCES, WITH_DISTANCE, TRACKS)}
            SELECT {PAIR_COLUMNS}, VELOCIDADE, 'S' || ID_SENSOR_ORIGEM AS sensor_id FROM segments
            WHERE 'S' || ID_SENSOR_ORIGEM NOT IN (SELECT sensor_id FROM track)""",
        "piezo_unknown_lines": f"""{with_(piezo_clean(), DISTANCES, WITH_DISTANCE, TRACKS)}
            SELECT {PAIR_COLUMNS}, VELOCIDADE, 'S' || ID_SENSOR_ORIGEM AS sensor_id FROM segments
            WHERE 'S' || ID_SENSOR_ORIGEM NOT IN (
                SELECT t.sensor_id FROM track t JOIN line l ON l.linha_id = t.linha_id AND l.cor <> 'ASIA')""",
        "csv_rejects": f"""SELECT user_id AS sensor_id, {shown('ts')} AS "timestamp",
            CASE WHEN event_id % 7 <> 0 THEN round(value, 5) END AS temperature_c,
            CASE WHEN event_id % 7 <> 0 THEN round(value / 7, 5) ELSE value / 7 END AS humidity_percent,
            CASE WHEN event_id % 7 = 0 THEN 'misfit' ELSE 'kept' END AS state
            FROM events, range(2) WHERE user_id IS NOT NULL AND ts IS NOT NULL AND value IS NOT NULL""",
        "batch_then_stream": f"""{dht} SELECT sensor_id, "timestamp", temperature_c, humidity_percent FROM dht, range(3)""",
        "trusted_day": f"""{dht} SELECT sensor_id, "timestamp", temperature_c, humidity_percent, substr("timestamp", 1, 10) AS trusted_day
            FROM dht""",
        "batch_taken": f"""{dht} SELECT sensor_id, "timestamp", temperature_c, humidity_percent FROM dht""",
        "stream_bad_file": f"""{dht} SELECT 'dht11' AS family, CAST(sensor_id AS DOUBLE) AS id, temperature_c AS value, 'taken' AS reason FROM dht
            UNION ALL SELECT 'omron', CAST(l_suppkey AS DOUBLE), round(l_discount * l_tax / 3, 5), 'taken' FROM lineitem
            UNION ALL SELECT 'dps', NULL, NULL, 'dps file lacks the columns correnteSurto_kA'""",
        "csv_mixed_headers": f"""{pairs} SELECT trem_id, sensor_id, pressure_kpa, {shown('t')} AS dataHora FROM piezo""",
        "dimension_load": f"{with_(METADATA)} SELECT * FROM meta",
        "dimension_upsert": f"""{with_(METADATA)} SELECT sensor_id, trem_id,
            CASE WHEN CAST(substr(sensor_id, 2) AS BIGINT) % 2 = 0 THEN carro_id ELSE 'C0' END AS carro_id
            FROM meta WHERE CAST(substr(sensor_id, 2) AS BIGINT) % 2 = 0 OR CAST(substr(sensor_id, 2) AS BIGINT) % 3 <> 0""",
        "dht11_registry": f"""{with_(DHT11_CLEAN, METADATA)} SELECT m.trem_id, d."timestamp" AS datahora,
            m.carro_id, d.sensor_id, d.temperature_c AS temperatura, d.humidity_percent AS umidade
            FROM dht_keyed d JOIN meta m ON m.sensor_id = d.sensor_id""",
        "dht11_client": f"""{with_(DHT11_CLEAN, METADATA)} SELECT d.*, m.trem_id, m.carro_id
            FROM dht d JOIN meta m ON m.sensor_id = 'S' || d.sensor_id""",
        "dps_registry": f"""{with_(DPS_CLEAN, METADATA)} SELECT statusDPS AS status, dataHora AS datahora,
            picoTensao_kV AS tensao, correnteSurto_kA AS corrente, sensor_id FROM dps
            WHERE sensor_id IN (SELECT sensor_id FROM meta)""",
        "dps_client": f"""{with_(DPS_CLEAN, METADATA, CIRCUITS)} SELECT c.circuito_id AS ID_CIRCUITO,
            c.modelo AS MODELO, c.categoria AS CATEGORIA, c.prioridade AS PRIORIDADE,
            d.statusDPS AS STATUS, m.carro_id AS NUM_CARRO, m.trem_id AS NUM_TREM,
            d.dataHora AS DATAHORA, d.picoTensao_kV, d.correnteSurto_kA
            FROM dps d JOIN meta m ON m.sensor_id = d.sensor_id
            JOIN circ c ON c.sensor_id = d.sensor_id""",
        "omron_passthrough": """SELECT l_linenumber AS y, l_partkey AS x,
            round(l_discount * l_tax / 3, 5) AS "valor-matriz", l_suppkey AS plataforma FROM lineitem
            WHERE l_linenumber IS NOT NULL AND l_partkey IS NOT NULL AND l_discount IS NOT NULL
              AND l_tax IS NOT NULL AND l_suppkey IS NOT NULL""",
        "optical_passthrough": """SELECT c_custkey, c_name, c_nationkey, round(c_acctbal, 5) AS c_acctbal,
            c_mktsegment FROM customer WHERE c_custkey IS NOT NULL AND c_name IS NOT NULL
              AND c_nationkey IS NOT NULL AND c_acctbal IS NOT NULL AND c_mktsegment IS NOT NULL""",
        "route_family": f"""{with_(ROUTE_KEYS)} SELECT event_id, "key", CASE
            WHEN contains("key", 'dht') THEN 'dht11' WHEN contains("key", 'dps') THEN 'dps'
            WHEN contains("key", 'optical') THEN 'optical' WHEN contains("key", 'omron') THEN 'omron'
            WHEN contains("key", 'piezo') THEN 'piezo' WHEN contains("key", 'tof') THEN 'tof'
            END AS family FROM named""",
        "route_reject": f"""{with_(ROUTE_KEYS)} SELECT event_id, "key", asked FROM named
            WHERE NOT contains("key", CASE asked WHEN 'dht11' THEN 'dht' ELSE asked END)""",
        "file_stream_ingest": f"""{pairs} SELECT CAST(trem_id AS BIGINT) AS trem_id,
            CAST(sensor_id AS BIGINT) AS sensor_id, pressure_kpa,
            {shown('t')} AS dataHora FROM piezo""",
    }
    registry = with_(piezo_clean(), DISTANCES, WITH_DISTANCE, REGISTRY)
    sql["upsert_latest_by_key"] = f"{registry}{LATEST}"
    sql["compact_by_bucket"] = """SELECT user_id AS sensor_id, count(*) AS n_rows, max(high) AS high, CAST(max(day(ts) % 3) AS INTEGER) AS last_batch
        FROM (SELECT user_id, ts, max(value) AS high FROM events WHERE ts IS NOT NULL GROUP BY ALL) GROUP BY ALL"""
    sql["piezo_run"] = registry.replace("FROM segments)", """FROM segments
        QUALIFY row_number() OVER (PARTITION BY ID_TREM ORDER BY t1 DESC, ID_SENSOR_ORIGEM DESC,
            ID_SENSOR_DESTINO DESC, PRESSAO DESC, VELOCIDADE DESC NULLS LAST) = 1)""") + "SELECT * FROM registry"
    sql["occupancy_snapshot"] = sql["tof_occupancy"]
    sql["tof_run"] = f"SELECT * RENAME (ocupacao_media AS ocupacao) FROM ({sql['tof_occupancy']})"
    sql["dps_run"] = f"""{sql['dps_registry']} QUALIFY row_number() OVER (
        PARTITION BY sensor_id, dataHora ORDER BY picoTensao_kV DESC) = 1"""
    sql["stream_upsert"] = f"""{sql['dht11_registry']} QUALIFY row_number() OVER (
        PARTITION BY d.sensor_id, d."timestamp" ORDER BY d.temperature_c DESC) = 1"""
    measured, computed = (lambda c: f"CAST(CAST({c} AS DECIMAL(20,5)) AS VARCHAR)"), (lambda c: f"CAST(CAST(CAST({c} AS VARCHAR) AS DECIMAL(38,24)) AS VARCHAR)")

    def facts(table, key, time, form, rows, **columns):
        return "".join(f""" UNION ALL SELECT '{table}' AS fact_table, {key} AS id, {time} AS "time", '{name}' AS attribute, {form(c)} AS digits
            FROM {rows} WHERE {c} IS NOT NULL""" for name, c in columns.items())

    all_facts = (
        facts("DHT11Data", "sensor_id", '"timestamp"', measured, "dht_keyed JOIN meta USING (sensor_id)", temperatura="temperature_c", umidade="humidity_percent")
        + facts("DpsData", "sensor_id", "dataHora", measured, "dps JOIN meta USING (sensor_id)", tensao="picoTensao_kV", corrente="correnteSurto_kA")
        + facts("PiezoData", "trem_id", "datahora_inicio", computed, "registry", pressao="pressao", velocidade="velocidade")
        + facts("TofData", "'S' || sensor_id", shown("t"), computed, "shares", ocupacao="ocupacao_media"))
    parts = with_(DHT11_CLEAN, DPS_CLEAN, METADATA, TOF_CLEAN, piezo_clean(), DISTANCES, WITH_DISTANCE, REGISTRY)
    sql["fact_digits"] = f"{parts}{all_facts.removeprefix(' UNION ALL')}"
    sql["stream_nested_keys"] = sql["file_stream_ingest"]
    return sql
