import datetime as dt
import math
import random

import pytest
from railpulse.functions.columns import block_of, km_per_hour, as_decimal, bare_sensor, below
from railpulse.operators.cleaning import clean, clean_typed, drop_nulls, render_times, rounded
from pyspark.sql import functions as F


def one(df):
    return [tuple(r) for r in df.collect()]


def test_a_null_in_any_column_drops_the_row(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, None)], "x int, y string")
    assert one(drop_nulls(df)) == [(1, "a")]


def test_nan_counts_as_null(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x double")
    assert one(drop_nulls(df)) == one(df.na.drop()) == [(1.0,)]


def test_null_tests_reach_the_scan(spark, scratch):
    rows = scratch.save(spark.createDataFrame([(1, 2.0), (None, 3.0)], "a int, b double"), "rows")
    plan = clean(rows)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(a), IsNotNull(b)]" in plan


def test_doubles_round_half_up_to_five_places_and_other_numbers_stay(spark):
    df = spark.sql("SELECT 1.0000050D AS a, -2.123456789D AS b, 1.123456789BD AS c, 7 AS d, "
                   "CAST(0.1234567 AS FLOAT) AS e")
    row = clean(df).first()
    assert (row.a, row.b, row.d) == (1.00001, -2.12346, 7)
    assert str(row.c) == "1.123456789"
    assert abs(row.e - 0.1234567) < 1e-8


def test_rounding_equals_round_bit_for_bit(spark):
    rng = random.Random(3)
    values = [0.0, -0.0, 1e-9, -1e-9, 1e9, 999999999.99999, 1e9 + 1e-5, 1e15, 1e300, 5e-6, 1.5e-5, 2.5e-5,
              -1.000005, 0.1 + 0.2, float("inf"), float("-inf"), float("nan"), None]
    values += [rng.uniform(-1, 1) * 10 ** rng.randint(-8, 17) for _ in range(20000)]
    values += [rng.randint(-10**14, 10**14) / 10**rng.randint(0, 7) for _ in range(20000)]
    values += [math.nextafter(rng.randint(-10**9, 10**9) / 10**5, rng.choice([-1e9, 1e9])) for _ in range(20000)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for places in (0, 2, 5):
        same = F.hex(F.round("x", places).cast("string").cast("binary")).eqNullSafe(
            F.hex(rounded(F.col("x"), places).cast("string").cast("binary")))
        assert df.filter(~same).count() == 0


def test_dates_and_timestamps_of_every_type_become_text(spark):
    df = spark.sql("SELECT DATE'2024-03-01' AS d, TIMESTAMP'2024-03-01 10:20:30.987' AS t, "
                   "TIMESTAMP_NTZ'2024-03-01 10:20:30.987' AS n")
    text = ("2024-03-01 00:00:00", "2024-03-01 10:20:30", "2024-03-01 10:20:30")
    assert one(clean(df)) == [text]
    assert one(render_times(clean_typed(df))) == [text]


def test_date_text_is_parsed_in_four_formats_and_shown_in_local_time(spark):
    rows = [("2024-03-01 10:20:30",), ("2024-03-01T10:20:30.123+0000",), ("01/03/2024 10:20:30",),
            ("2024-03-01",), ("soon",)]
    df = spark.createDataFrame(rows, "ReadDate string").withColumn("dataHora", F.col("ReadDate"))
    got = one(clean(df))
    local = "2024-03-01 07:20:30"
    assert [r[0] for r in got] == [local, local, local, "2024-02-29 21:00:00", None]
    assert [r[1] for r in got] == [r[0] for r in rows]


def test_local_time_follows_summer_time_of_its_year(spark):
    df = spark.createDataFrame([("2018-12-01 12:00:00",)], "date string")
    assert one(clean(df)) == [("2018-12-01 10:00:00",)]


def test_unusual_column_names_survive(spark):
    df = spark.createDataFrame([(1.123456789, 2.0)], "`valor-matriz` double, `a.b` double")
    assert clean(df).columns == ["valor-matriz", "a.b"]
    assert one(clean(df)) == [(1.12346, 2.0)]


def test_expressions(spark):
    df = spark.createDataFrame([(-1, 1750.0, 500.0, 10, "S12"), (7, 1749.9, None, 0, "12S")],
                               "y int, d double, m double, s int, k string")
    assert one(df.select(block_of("y", 4))) == [(-1,), (1,)]
    assert one(df.select(below("d", 1750))) == [(0,), (1,)]
    assert one(df.select(km_per_hour(F.lit(500.0), F.col("s")))) == [(180.0,), (None,)]
    assert one(df.select(bare_sensor("k"))) == [("12",), ("12S",)]
    assert str(df.select(as_decimal("d")).first()[0]).startswith("1750.000")


def test_decimals_hold_all_digits_or_fail(spark):
    values = [0.1 + 0.2, 1e-7 / 3, -0.0, 2.0 ** 46 + 0.25, -99999999999999.98, 100 / 3, 23.40001, None]
    df = spark.createDataFrame([(v,) for v in values], "d double")
    assert [r[0] if r[0] is None else float(r[0]) for r in df.select(as_decimal("d")).collect()] == [v if v else v and 0.0 for v in values]
    for value, kind in [(1e14, "decimal(38,24)"), (float("inf"), "decimal(20,5)"), (0.123456, "decimal(20,5)")]:
        with pytest.raises(Exception, match="does not fit"):
            spark.createDataFrame([(value,)], "d double").select(as_decimal("d", kind)).collect()


def test_typed_times_group_like_their_text(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 0, 0, 1, 5),), (dt.datetime(2024, 1, 1, 0, 0, 1, 900000),)], "t timestamp")
    assert clean_typed(df).distinct().count() == 1 == clean(df).distinct().count()
