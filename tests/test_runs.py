"""Whole runs per family from raw CSV, as batches and as a stream."""

import gzip
import os
from decimal import Decimal

import duckdb
import pytest
from pyspark.sql import functions as F

from railpulse.functions.routing import accepted, key_within, rejected, route_family
from railpulse.plans.piezo import UnknownTrack
from railpulse.plans.runs import RowCounts, run_family, run_files
from railpulse.schemas import FACT_KEYS
from railpulse.session import Scratch, shared_folder
from railpulse.sinks.files import BatchTaken, Zones, read_days
from railpulse.sinks.keyed import compact, last_written, put_batch, read_latest, upsert_latest
from railpulse.sinks.versions import current
from railpulse.sources.dumps import Dimensions, dimension_from_rows
from railpulse.streaming.ingest import start_all, start_ingest, start_routed
from railpulse.workload.oracle import oracle
from railpulse.workload.queries import QUERIES
from tests.compare import duck_rows, spark_rows
from tests.conftest import SF
from tests.test_sources import put


@pytest.fixture
def dims(spark):
    def table(name, *rows):
        return dimension_from_rows(spark, list(rows), name)

    return Dimensions(
        table("SensorMetadata", ("S1", "T1", "C1"), ("S2", None, None)),
        table("Circuito", ("S1", "CC1", "m", "c", 1)),
        table("PiezoSensorDistancia", ("S6", "S9", 500.0)),
        table("Trilho", ("S6", "R7-1", "7")),
        table("Linha", ("7", "Rubi")))


@pytest.fixture
def zones(tmp_path):
    return Zones(f"{tmp_path}/lake")


def latest(spark, zones, name):
    def plain(value):
        return float(value) if isinstance(value, Decimal) else value

    rows = read_latest(spark, zones.table(name), FACT_KEYS[name]).collect()
    return sorted([tuple(map(plain, r)) for r in rows], key=str)


def csv(spark, path):
    df = spark.read.option("header", True).csv(path)
    return df.columns, sorted([tuple(r) for r in df.collect()], key=str)


@pytest.mark.parametrize("files", [1, 2])
def test_the_highest_in_a_named_sequence_wins_a_key(spark, dims, zones, tmp_path, files):
    """The lower temperature comes later, in the same file or in a later micro-batch."""
    header, rows = "sensor_id,min,max,timestamp,temperature_c,humidity_percent\n", ["1,18,24,2024-01-01 10:00:00,27.1,2\n", "1,18,24,2024-01-01 10:00:00,17.5,3\n"]
    for at in range(files):
        path = put(f"{tmp_path}/raw/dht11_{at}.csv", header + "".join(rows if files == 1 else rows[at:at + 1]))
        os.utime(path, (at + 1, at + 1))
    start_ingest(spark, f"{tmp_path}/raw", "dht11", dims, zones, f"{tmp_path}/state", files_per_batch=1,
                 dht11_sequence=["temperature_c", "humidity_percent"]).awaitTermination(120)
    got = read_latest(spark, zones.table("DHT11Data"), FACT_KEYS["DHT11Data"], ["temperatura", "umidade"])
    assert [(float(r.temperatura), float(r.umidade)) for r in got.collect()] == [(27.1, 2.0)]


def test_stream_upsert_of_events_with_one_key(spark, tmp_path):
    """A sensor's second holds several events, of which the first in the table is the highest."""
    con = duckdb.connect()
    for name in ("supplier", "part", "nation", "region"):
        os.symlink(f"{SF}/{name}.parquet", f"{tmp_path}/{name}.parquet")
    con.execute(f"""COPY (SELECT * REPLACE (event_id // 3 % 5 + 1 AS user_id, date_trunc('minute', ts) AS ts, 500.25 - event_id AS value)
        FROM '{SF}/events.parquet' WHERE event_id < 400 AND value IS NOT NULL AND ts IS NOT NULL ORDER BY event_id) TO '{tmp_path}/events.parquet' (FORMAT parquet)""")
    for name in ("supplier", "events"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet'")
    ours, theirs = spark_rows(QUERIES["stream_upsert"](spark, str(tmp_path))), duck_rows(con, oracle()["stream_upsert"])
    assert ours == theirs and 0 < len(ours[1]) < con.execute("SELECT count(*) FROM events").fetchone()[0]


def test_measures_too_large_for_the_fact_tables_are_misfits(spark, dims, zones, tmp_path):
    path = put(f"{tmp_path}/dht11.csv", "sensor_id,min,max,timestamp,temperature_c,humidity_percent\n"
               "1,18,24,2024-01-01 10:00:00,23.4000001,50.123456\n1,18,24,2024-01-01 10:00:01,1e300,50\n1,18,24,2024-01-01 10:00:02,5,-Infinity\n")
    assert run_files(spark, "dht11", path, dims, zones, 1) == RowCounts(read=3, kept=1, misfits=2)
    fact = read_latest(spark, zones.table("DHT11Data"), FACT_KEYS["DHT11Data"]).first()
    assert (str(fact.temperatura), str(fact.umidade)) == ("23.40000", "50.12346")
    lines = sorted(r[0] for r in spark.read.parquet(zones.misfits("dht11", 1)).select("_misfit").collect())
    assert [line.split(",")[4:] for line in lines] == [["1.0E300", "50.0"], ["5.0", "-Infinity"]]


def test_days_are_pruned_and_a_batch_replaces_its_own(spark, dims, tmp_path):
    zones = Zones(f"{tmp_path}/lake", days=True)

    def readings(name, *times):
        rows = "".join(f"1,18,24,{t},{n},50\n" for n, t in enumerate(times))
        return put(f"{tmp_path}/{name}.csv", "sensor_id,min,max,timestamp,temperature_c,humidity_percent\n" + rows)

    one = readings("a", "2024-01-01 23:59:59", "2024-01-02 00:00:00", "2024-01-02 09:00:00", "2024-01-03 00:00:00")
    for _ in range(2):
        assert run_files(spark, "dht11", one, dims, zones, 0).kept == 4
    assert run_files(spark, "dht11", readings("b", "2024-01-02 10:00:00", "2024-02-01 00:00:00"), dims, zones, 1).kept == 2
    assert run_files(spark, "dht11", readings("none"), dims, zones, 2) == RowCounts(0, 0)
    assert run_files(spark, "dht11", readings("bad", "no time", ""), dims, zones, 3) == RowCounts(read=2, kept=0, misfits=1)
    assert run_files(spark, "tof", put(f"{tmp_path}/tof.csv", "sensor_id,timestamp,y,x,dist_mm\n,2024-01-01 10:00:00,0,0,1\n"), dims, zones, 0) == RowCounts(1, 0)
    day = read_days(spark, zones, "dht11", "2024-01-02", "2024-01-02")
    assert sorted((str(r.timestamp), r.batch) for r in day.collect()) == [
        ("2024-01-02 00:00:00", 0), ("2024-01-02 09:00:00", 0), ("2024-01-02 10:00:00", 1)]
    plan = day._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(trusted_day" in plan
    read = {r.f for r in day.select(F.col("_metadata.file_path").alias("f")).distinct().collect()}
    assert len(read) == 2 and all("trusted_day=2024-01-02" in f for f in read)
    assert read_days(spark, zones, "dht11").count() == 6 and read_days(spark, zones, "dht11", first="2024-01-03").count() == 2
    assert len(csv(spark, zones.client("dht11", 0))[1]) == 4
    with pytest.raises(ValueError, match="not laid out by day"):
        read_days(spark, Zones(zones.root), "dht11")


def test_tof(spark, dims, zones, tmp_path):
    head = "sensor_id,timestamp,y,x,dist_mm\n"
    points = "".join(f"1,2024-01-01 10:00:00,{y},{x},{1750 if x == 0 else 1000}\n" for y in range(4) for x in range(8))
    path = put(f"{tmp_path}/tof.csv", head + points + "3,2024-01-01 10:00:00,-1,0,10\n,2024-01-01 10:00:00,0,0,1\n")
    assert run_files(spark, "tof", path, dims, zones, 1) == RowCounts(read=34, kept=33)
    assert csv(spark, current(spark, zones.occupancy())[1]) == (
        ["sensor_id", "trem_id", "carro_id", "datahora", "ocupacao_media"],
        [("S1", "T1", "C1", "2024-01-01 10:00:00", "87.5"), ("S3", None, None, "2024-01-01 10:00:00", "100.0")])
    assert csv(spark, zones.client("tof", 1)) == (
        ["y_block", "x_block", "dist", "timestamp", "trem_id", "carro_id"],
        [("0", "0", "1187.5", "2024-01-01 10:00:00", "T1", "C1"),
         ("0", "1", "1000.0", "2024-01-01 10:00:00", "T1", "C1")])
    assert latest(spark, zones, "TofData") == [
        ("S1", "T1", "C1", "2024-01-01 10:00:00", 87.5), ("S3", None, None, "2024-01-01 10:00:00", 100.0)]
    assert spark.read.parquet(zones.trusted("tof")).count() == 33


def test_dht11_last_written_row_wins(spark, dims, zones, tmp_path):
    head = "sensor_id,min,max,timestamp,temperature_c,humidity_percent\n"
    path = put(f"{tmp_path}/dht11.csv", head + "1,18,24,2024-01-01 10:00:00,30.123456,50\n"
               "1,18,24,2024-01-01 10:00:00,20.5,40\n2,18,24,2024-01-01 10:00:00,1,1\n"
               "5,18,24,2024-01-01 10:00:00,1,1\n")
    run_files(spark, "dht11", path, dims, zones, 1)
    assert latest(spark, zones, "DHT11Data") == sorted([
        ("T1", "2024-01-01 10:00:00", "C1", "S1", 20.5, 40.0),
        (None, "2024-01-01 10:00:00", None, "S2", 1.0, 1.0)], key=str)
    columns, rows = csv(spark, zones.client("dht11", 1))
    assert columns == ["sensor_id", "min", "max", "timestamp", "temperature_c", "humidity_percent",
                       "trem_id", "carro_id"]
    assert ("1", "18.0", "24.0", "2024-01-01 10:00:00", "30.12346", "50.0", "T1", "C1") in rows and len(rows) == 3


def test_dps(spark, dims, zones, tmp_path):
    head = "sensor_id,statusDPS,picoTensao_kV,correnteSurto_kA,dataHora\n"
    path = put(f"{tmp_path}/dps.csv", head + "1,OK,7.76,7.54,2024-01-01 10:00:00\n2,TROCAR,1,1,2024-01-01 10:00:00\n"
               "5,OK,1,1,2024-01-01 10:00:00\n")
    run_files(spark, "dps", path, dims, zones, 1)
    assert latest(spark, zones, "DpsData") == [
        ("OK", "2024-01-01 10:00:00", 7.76, 7.54, "S1"), ("TROCAR", "2024-01-01 10:00:00", 1.0, 1.0, "S2")]
    assert csv(spark, zones.client("dps", 1)) == (
        ["ID_CIRCUITO", "MODELO", "CATEGORIA", "PRIORIDADE", "STATUS", "NUM_CARRO", "NUM_TREM", "DATAHORA",
         "picoTensao_kV", "correnteSurto_kA"],
        [("CC1", "m", "c", "1", "OK", "C1", "T1", "2024-01-01 10:00:00", "7.76", "7.54")])


def test_omron_and_optical_pass_through(spark, dims, zones, tmp_path):
    path = put(f"{tmp_path}/omron.csv", "y,x,valor-matriz,plataforma\n0,1,0.4030712,2\n1,1,,2\n")
    assert run_files(spark, "omron", path, dims, zones, 1) == RowCounts(read=2, kept=1)
    assert csv(spark, zones.client("omron", 1)) == (["y", "x", "valor-matriz", "plataforma"], [("0", "1", "0.40307", "2")])
    path = put(f"{tmp_path}/optical.csv", "trem_id,level,at\nT1,0.1234567,2024-01-01 10:00:00\n")
    run_files(spark, "optical", path, dims, zones, 1)
    assert csv(spark, zones.client("optical", 1)) == (["trem_id", "level", "at"], [("T1", "0.12346", "2024-01-01 10:00:00")])


PIEZO = ("trem_id,sensor_id,pressure_kpa,dataHora\n1,6,10,2024-01-01 10:00:00\n1,9,20,2024-01-01 10:00:50\n"
         "2,6,1,2024-01-01 10:01:00\n2,9,2,2024-01-01 10:01:25\n")
BACK = "1,9,3,2024-01-01 11:00:00\n1,6,5,2024-01-01 11:00:50\n"
SEGMENTS = [("T1", "S6", "S9", 15.0, 36.0, "2024-01-01 10:00:00", "2024-01-01 10:00:50"),
            ("T2", "S6", "S9", 1.5, 72.0, "2024-01-01 10:01:00", "2024-01-01 10:01:25")]


@pytest.mark.parametrize("sizes", [{}, {"max_group_rows": 0, "rows_per_slice": 2}], ids=["whole", "sliced"])
def test_piezo(spark, dims, zones, tmp_path, sizes):
    run_files(spark, "piezo", put(f"{tmp_path}/piezo.csv", PIEZO), dims, zones, 1, **sizes)
    assert latest(spark, zones, "PiezoData") == SEGMENTS
    columns, rows = csv(spark, zones.client("piezo", 1))
    assert columns[-3:] == ["Headway(s)", "Trilho", "Linha"]
    assert [r[-3:] for r in rows] == [(None, "R7-1", "7 - Rubi"), ("10", "R7-1", "7 - Rubi")]


def test_piezo_at_an_unknown_track(spark, dims, zones, tmp_path):
    path = put(f"{tmp_path}/piezo.csv", PIEZO + BACK)
    with pytest.raises(UnknownTrack):
        run_files(spark, "piezo", path, dims, zones, 1)
    run_files(spark, "piezo", path, dims, zones, 1, strict=False)
    assert spark.read.parquet(zones.rejects("piezo", 1)).count() == 1
    assert len(csv(spark, zones.client("piezo", 1))[1]) == 2


def test_a_batch_run_again_replaces_itself(spark, dims, zones, tmp_path):
    path = put(f"{tmp_path}/piezo.csv", PIEZO)
    for _ in range(2):
        run_files(spark, "piezo", path, dims, zones, 1)
    assert spark.read.parquet(zones.trusted("piezo")).count() == 4
    assert latest(spark, zones, "PiezoData") == SEGMENTS


def test_empty_files_give_empty_results_with_all_columns(spark, dims, zones, tmp_path):
    run_files(spark, "piezo", put(f"{tmp_path}/piezo.csv", PIEZO.splitlines()[0] + "\n"), dims, zones, 1)
    assert latest(spark, zones, "PiezoData") == []


def test_scratch_tables_are_gone_after_a_run(spark, dims, zones, tmp_path):
    folder = f"{tmp_path}/scratch"
    run_files(spark, "piezo", put(f"{tmp_path}/piezo.csv", PIEZO), dims, zones, 1, scratch_folder=folder)
    assert os.listdir(folder) == []


def test_unknown_family(spark, dims, zones):
    with pytest.raises(ValueError, match="sonar"):
        run_family("sonar", spark.range(1), dims, zones, 1)


def test_stream_equals_batch_and_takes_each_file_once(spark, dims, zones, tmp_path):
    inbox = f"{tmp_path}/in"
    put(f"{inbox}/piezo_1.csv", PIEZO)
    put(f"{inbox}/notes.csv", "a,b\n1,2\n")

    def ingest():
        stream = start_ingest(spark, inbox, "piezo", dims, zones, f"{tmp_path}/state", files_per_batch=1, strict=False)
        assert stream.awaitTermination(300)
        return [p["numInputRows"] for p in stream.recentProgress if p["numInputRows"]]

    assert ingest() and latest(spark, zones, "PiezoData") == SEGMENTS
    assert ingest() == []
    put(f"{inbox}/piezo/late.csv", PIEZO.splitlines()[0] + "\n" + BACK)
    assert ingest()
    assert latest(spark, zones, "PiezoData") == [
        ("T1", "S9", "S6", 4.0, 36.0, "2024-01-01 11:00:00", "2024-01-01 11:00:50"), SEGMENTS[1]]
    assert spark.read.parquet(zones.trusted("piezo")).count() == 6


def test_all_families_side_by_side(spark, dims, zones, tmp_path):
    inbox = f"{tmp_path}/in"
    put(f"{inbox}/piezo.csv", PIEZO)
    put(f"{inbox}/dht11.csv", "sensor_id,min,max,timestamp,temperature_c,humidity_percent\n"
                              "1,18,24,2024-01-01 10:00:00,20.5,40\n")
    put(f"{inbox}/dps.csv", "sensor_id,statusDPS,picoTensao_kV,correnteSurto_kA,dataHora\n"
                            "1,OK,7.76,7.54,2024-01-01 10:00:00\n")
    put(f"{inbox}/tof.csv", "sensor_id,timestamp,y,x,dist_mm\n1,2024-01-01 10:00:00,0,0,10\n")
    put(f"{inbox}/omron.csv", "y,x,valor-matriz,plataforma\n0,1,0.4,2\n")
    put(f"{inbox}/optical.csv", "trem_id,level\nT1,0.5\n")
    streams = start_all(spark, inbox, dims, zones, f"{tmp_path}/state", "trem_id string, level double")
    assert sorted(streams) == ["dht11", "dps", "omron", "optical", "piezo", "tof"]
    assert all(s.awaitTermination(300) for s in streams.values())
    assert latest(spark, zones, "PiezoData") == SEGMENTS
    assert [latest(spark, zones, n)[0][-1] for n in ("DHT11Data", "DpsData", "TofData")] == [40.0, "S1", 100.0]
    assert csv(spark, zones.client("optical", 0))[1] == [("T1", "0.5")]
    assert csv(spark, zones.client("omron", 0))[1] == [("0", "1", "0.4", "2")]


def test_the_file_written_last_wins_or_the_latest_event(spark, dims, zones, tmp_path):
    early = PIEZO.splitlines()[0] + "\n" + BACK.replace("11:00", "09:00")
    first, last = put(f"{tmp_path}/piezo_a.csv", PIEZO), put(f"{tmp_path}/piezo_b.csv", early)
    os.utime(first, (1_700_000_000, 1_700_000_000))
    run_files(spark, "piezo", [first, last], dims, zones, 1, strict=False)
    assert latest(spark, zones, "PiezoData")[0][:3] == ("T1", "S9", "S6")
    run_files(spark, "piezo", [first, last], dims, zones, 1, strict=False, by_event_time=True)
    assert latest(spark, zones, "PiezoData") == SEGMENTS


def test_files_at_any_depth_however_old_below_a_folder_with_a_mark(spark, dims, zones, tmp_path):
    inbox = f"{tmp_path}/dht in"

    def ingest():
        stream = start_ingest(spark, inbox, "piezo", dims, zones, f"{tmp_path}/state", strict=False)
        assert stream.awaitTermination(300)
        return spark.read.parquet(zones.trusted("piezo")).count()

    put(f"{inbox}/2024/01/piezo_b.csv", PIEZO)
    put(f"{inbox}/2024/01/other.csv", "a,b\n1,2\n")
    assert ingest() == 4
    old = put(f"{inbox}/piezo/deep/er/x.csv", PIEZO.splitlines()[0] + "\n" + BACK)
    os.utime(old, (1_000_000_000, 1_000_000_000))
    assert ingest() == 6


def test_batches_and_ingests_do_not_replace_each_other(spark, dims, zones, tmp_path):
    path = put(f"{tmp_path}/in/piezo.csv", PIEZO)
    run_files(spark, "piezo", path, dims, zones, 1)
    for state in "ab":
        assert start_ingest(spark, f"{tmp_path}/in", "piezo", dims, zones, f"{tmp_path}/{state}").awaitTermination(300)
    assert spark.read.parquet(zones.trusted("piezo")).count() == 12
    with pytest.raises(BatchTaken):
        run_files(spark, "piezo", path, dims, zones, 2)


def test_rows_that_do_not_fit_are_set_aside(spark, dims, zones, tmp_path):
    path = put(f"{tmp_path}/piezo.csv", PIEZO + "x1,6,1,2024-01-01 10:00:00\n3,6,1,01/01/2024 10:00:00\n3,,1,2024-01-01 10:00:00\n" + BACK)
    with pytest.raises(UnknownTrack):
        run_files(spark, "piezo", path, dims, zones, 1)
    assert spark.read.parquet(zones.misfits("piezo", 1)).count() == 2
    assert run_files(spark, "piezo", path, dims, zones, 1, strict=False) == RowCounts(read=9, kept=6, misfits=2)
    lines = [r[0] for r in spark.read.parquet(zones.misfits("piezo", 1)).select("_misfit").collect()]
    assert sorted(lines) == ["3,6,1,01/01/2024 10:00:00", "x1,6,1,2024-01-01 10:00:00"]


def test_another_time_zone_is_refused(spark, dims, zones, tmp_path):
    path = put(f"{tmp_path}/piezo.csv", PIEZO)
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        with pytest.raises(ValueError, match="UTC"):
            run_files(spark, "piezo", path, dims, zones, 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


# Keyed tables

def test_later_batches_win_and_replays_change_nothing(spark, tmp_path):
    table, keys = f"{tmp_path}/t", ["k"]

    def batch(*rows):
        return spark.createDataFrame(list(rows), "k int, v int")

    first = last_written(batch((1, 10), (1, 11), (2, 20)), keys)
    put_batch(first, table, 1, keys)
    put_batch(batch((1, 5)), table, 2, keys)
    put_batch(first, table, 1, keys)
    want = [(1, 5), (2, 20)]
    assert sorted(tuple(r) for r in read_latest(spark, table, keys).collect()) == want
    by_value = read_latest(spark, table, keys, ["v"])
    assert sorted(tuple(r) for r in by_value.collect()) == [(1, 11), (2, 20)]
    compact(spark, table, f"{tmp_path}/t2", keys)
    assert sorted(tuple(r) for r in read_latest(spark, f"{tmp_path}/t2", keys).collect()) == want
    compact(spark, table, f"{tmp_path}/t3", keys, ["v"])
    assert sorted(tuple(r) for r in read_latest(spark, f"{tmp_path}/t3", keys, ["v"]).collect()) == [(1, 11), (2, 20)]
    put_batch(batch((2, 1)), f"{tmp_path}/t2", 3, keys)
    assert sorted(tuple(r) for r in read_latest(spark, f"{tmp_path}/t2", keys).collect()) == [(1, 5), (2, 1)]


def test_upsert(spark):
    old = spark.createDataFrame([(1, 1, "a"), (2, 5, "b")], "k int, s int, v string")
    new = spark.createDataFrame([(1, 2, "c"), (2, 4, "d"), (3, 1, "e")], "k int, s int, v string")
    assert sorted(tuple(r) for r in upsert_latest(old, new, ["k"], ["s"]).collect()) == [
        (1, 2, "c"), (2, 5, "b"), (3, 1, "e")]


# Routing

def test_the_name_of_a_bucket_does_not_count(spark):
    df = spark.createDataFrame([("s3a://rail-optical-raw/piezo_1.csv",)], "p string")
    assert df.select(route_family(key_within(F.col("p"), "s3a://rail-optical-raw/"))).first()[0] == "piezo"


def test_routes(spark):
    keys = [("dht_tof.csv", "dht11"), ("tof/1.csv", "tof"), ("a/optical.csv", "optical"), ("x.csv", None),
            ("omron-dps", "dps"), ("TOF.csv", None)]
    df = spark.createDataFrame(keys, "key string, want string")
    assert [r.got for r in df.select(route_family(F.col("key")).alias("got")).collect()] == [w for _, w in keys]


def test_keys_must_name_the_family_asked_for(spark):
    df = spark.createDataFrame([("dht_1.csv", "dht11"), ("tof.csv", "dps"), ("x", None), ("piezo", "sonar")],
                               "key string, asked string")
    assert [r.key for r in accepted(df, "key", "asked").collect()] == ["dht_1.csv"]
    assert sorted(r.key for r in rejected(df, "key", "asked").collect()) == ["piezo", "tof.csv", "x"]


def test_marks_in_the_folder_itself_do_not_count(spark):
    df = spark.createDataFrame([("file:///dht/in/piezo.csv",)], "p string")
    assert df.select(route_family(key_within(F.col("p"), "/dht/in"))).first()[0] == "piezo"


def test_scratch_lies_in_the_checkpoint_folder(spark):
    folder = shared_folder(spark)
    assert Scratch(spark).path.startswith(folder)
    assert folder == shared_folder(spark)


# One ingest for all families

DHT = "sensor_id,min,max,timestamp,temperature_c,humidity_percent\n1,18,24,2024-01-01 10:00:00,20.5,40\n"


def routed(spark, tmp_path, dims, zones, state="state", **options):
    stream = start_routed(spark, f"{tmp_path}/in", dims, zones, f"{tmp_path}/{state}", **options)
    assert stream.awaitTermination(300)
    rows = spark.read.parquet(zones.outcomes()).collect()
    return {row.path.rsplit("/in/")[1]: (row.family, row.outcome, row.reason) for row in rows}


def test_a_bad_file_is_set_aside_and_the_others_go_on(spark, dims, zones, tmp_path):
    inbox = f"{tmp_path}/in"
    put(f"{inbox}/piezo 1.csv", PIEZO)
    put(f"{inbox}/piezo_back.csv", PIEZO.splitlines()[0] + "\n" + BACK)
    put(f"{inbox}/piezo_lacking.csv", "trem_id,sensor_id,dataHora\n1,6,2024-01-01 10:00:00\n")
    put(f"{inbox}/piezo_twice.csv", "trem_id,trem_id,sensor_id,pressure_kpa,dataHora\n1,1,6,5,2024-01-01 10:00:00\n")
    put(f"{inbox}/piezo_empty.csv", "")
    put(f"{inbox}/deep/piezo_turned.csv", "dataHora,pressure_kpa,sensor_id,trem_id\n2024-01-01 10:00:00,1,6,5\n2024-01-01 10:00:50,2,9,5\n")
    put(f"{inbox}/piezo_damaged.csv.gz", "no gzip")
    with gzip.open(f"{inbox}/dht11_cut.csv.gz", "wb") as out:
        out.write((DHT + DHT.splitlines()[1] + "\n" * 3).encode() + os.urandom(100_000))
    with open(f"{inbox}/dht11_cut.csv.gz", "r+b") as file:
        file.truncate(60_000)
    put(f"{inbox}/dht11_good.csv", DHT)
    put(f"{inbox}/notes.csv", "a,b\n1,2\n")
    got = routed(spark, tmp_path, dims, zones)
    taken = {name for name, (_, outcome, _) in got.items() if outcome == "taken"}
    assert taken == {"piezo 1.csv", "deep/piezo_turned.csv", "dht11_good.csv"} and "piezo_empty.csv" not in got
    assert got["notes.csv"] == (None, "no family", None)
    assert got["piezo_back.csv"][1:] == ("set aside", "segments at unknown tracks: 1")
    assert got["piezo_lacking.csv"][1:] == ("set aside", "piezo file lacks the columns pressure_kpa")
    assert "repeats the columns trem_id" in got["piezo_twice.csv"][2]
    assert "cannot be read" in got["piezo_damaged.csv.gz"][2] and "cannot be read" in got["dht11_cut.csv.gz"][2]
    assert [row[0] for row in latest(spark, zones, "PiezoData")] == ["T1", "T2", "T5"]
    assert spark.read.parquet(zones.trusted("piezo")).count() == 6 and spark.read.parquet(zones.trusted("dht11")).count() == 1
    put(f"{inbox}/piezo_late.csv", PIEZO.replace("\n1,", "\n8,"))
    assert routed(spark, tmp_path, dims, zones)["piezo_late.csv"][1] == "taken"
    assert spark.read.parquet(zones.trusted("piezo")).count() == 10 and len(routed(spark, tmp_path, dims, zones)) == 10


def test_only_bad_files_leave_nothing_behind(spark, dims, zones, tmp_path):
    put(f"{tmp_path}/in/piezo_back.csv", PIEZO.splitlines()[0] + "\n" + BACK)
    assert routed(spark, tmp_path, dims, zones)["piezo_back.csv"][1] == "set aside"
    assert not os.path.exists(zones.trusted("piezo", 0)) and not os.path.exists(f"{zones.table('PiezoData')}/batch=000000000")
    put(f"{tmp_path}/in/piezo_good.csv", PIEZO)
    routed(spark, tmp_path, dims, zones)
    assert latest(spark, zones, "PiezoData") == SEGMENTS


def test_a_micro_batch_that_is_repeated_replaces_itself(spark, dims, zones, tmp_path, monkeypatch):
    """Outcomes fail to be written once, after the families have run."""
    put(f"{tmp_path}/in/piezo.csv", PIEZO)
    put(f"{tmp_path}/in/dht11.csv", DHT)
    place = zones.outcomes
    monkeypatch.setattr(Zones, "outcomes", lambda self, batch=None: "nowhere://x" if batch is not None else place())
    with pytest.raises(Exception):
        routed(spark, tmp_path, dims, zones)
    monkeypatch.undo()
    assert {outcome for _, outcome, _ in routed(spark, tmp_path, dims, zones).values()} == {"taken"}
    assert spark.read.parquet(zones.trusted("piezo")).count() == 4 and spark.read.parquet(zones.trusted("dht11")).count() == 1


def test_a_failure_of_no_file_stops_the_ingest(spark, dims, zones, tmp_path):
    put(f"{tmp_path}/in/piezo.csv", PIEZO)
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        with pytest.raises(Exception, match="UTC"):
            routed(spark, tmp_path, dims, zones)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_a_batch_belongs_to_its_files(spark, dims, zones, tmp_path):
    first, other = put(f"{tmp_path}/piezo_a.csv", PIEZO), put(f"{tmp_path}/piezo_b.csv", PIEZO.replace("\n1,", "\n3,"))
    run_files(spark, "piezo", first, dims, zones, 1)
    with pytest.raises(BatchTaken):
        run_files(spark, "piezo", other, dims, zones, 1)
    run_files(spark, "piezo", [first], dims, zones, 1)
    assert latest(spark, zones, "PiezoData") == SEGMENTS
