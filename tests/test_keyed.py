"""Fact tables in key buckets."""

import glob

import pytest
from pyspark.sql import functions as F

from railpulse.sinks import keyed
from railpulse.sinks.keyed import OtherForm, Unfinished, compact, put_batch, read_keys, read_latest
from tests.test_scale import final_plan

KEYS = ["k", "at"]


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), "k long, at timestamp, v string")


@pytest.fixture
def many(spark):
    return spark.range(2_000).select("id", F.timestamp_seconds(F.col("id") % 7).alias("at"), F.col("id").cast("string").alias("v")).withColumnRenamed("id", "k")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_one_key_reads_one_bucket(spark, many, tmp_path):
    table = f"{tmp_path}/t"
    for number in range(3):
        put_batch(many.withColumn("v", F.concat("v", F.lit(f"-{number}"))), table, number, KEYS, buckets=8)
    one = read_keys(spark, table, KEYS, [(700, "1970-01-01 00:00:00")])
    assert [r.v for r in one.collect()] == ["700-2"]
    plan = final_plan(one)
    assert "key_bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    scan = one._jdf.queryExecution().executedPlan().toString()
    assert "EqualNullSafe(k,700)" in scan or "EqualTo(k,700)" in scan
    # With the files of all other buckets spoiled the key is still read.
    bucket = many.where("k = 700").select(keyed.bucket_of([F.col("k"), F.col("at")], 8)).first()[0]
    others = [f for f in glob.glob(f"{table}/batch=*/key_bucket=*/*.parquet") if f"key_bucket={bucket}/" not in f]
    assert others
    for file in others:
        open(file, "wb").close()
    assert [r.v for r in read_keys(spark, table, KEYS, [(700, "1970-01-01 00:00:00")]).collect()] == ["700-2"]


def test_null_and_unknown_keys(spark, tmp_path):
    table = f"{tmp_path}/t"
    put_batch(batch(spark, (None, None, "none"), (1, None, "one")), table, 0, KEYS)
    assert [r.v for r in read_keys(spark, table, KEYS, [(None, None)]).collect()] == ["none"]
    assert rows_of(read_keys(spark, table, KEYS, [(9, None)])) == []
    assert rows_of(read_keys(spark, table, KEYS, [])) == []
    assert {r.v for r in read_keys(spark, table, KEYS, [(1, None), (None, None), (1, None)]).collect()} == {"none", "one"}
    with pytest.raises(OtherForm):
        read_keys(spark, table, ["k"], [(1,)])


def test_empty_batches_can_be_read(spark, tmp_path):
    put_batch(batch(spark), f"{tmp_path}/t", 0, KEYS)
    read = read_latest(spark, f"{tmp_path}/t", KEYS)
    assert read.columns == ["k", "at", "v"] and read.collect() == []


def test_a_batch_of_other_columns_or_keys_is_refused(spark, tmp_path):
    put_batch(batch(spark, (1, None, "a")), f"{tmp_path}/t", 0, KEYS)
    with pytest.raises(OtherForm):
        put_batch(batch(spark, (1, None, "a")).withColumn("v", F.lit(1)), f"{tmp_path}/t", 1, KEYS)
    with pytest.raises(OtherForm):
        put_batch(batch(spark, (1, None, "a")), f"{tmp_path}/t", 1, ["k"])


def test_a_replay_leaves_no_bucket_of_its_first_try(spark, many, tmp_path):
    table = f"{tmp_path}/t"
    put_batch(many, table, 0, KEYS, buckets=8)
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        put_batch(many.where("k = 5"), table, 0, KEYS, buckets=8)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert read_latest(spark, table, KEYS).count() == 1


@pytest.mark.parametrize("fail_at", [0, 1, 3])
def test_a_folding_that_stops_goes_on_with_the_batches_it_began_with(spark, many, tmp_path, monkeypatch, fail_at):
    table, into = f"{tmp_path}/t", f"{tmp_path}/new"
    put_batch(many, table, 0, KEYS, buckets=4)
    put_batch(many.where("k < 500").withColumn("v", F.lit("late")), table, 1, KEYS)
    want = rows_of(read_latest(spark, table, KEYS))
    real, calls = keyed._in_buckets, []

    def failing(*args):
        calls.append(args)
        if len(calls) == fail_at + 1:
            raise RuntimeError("stopped")
        return real(*args)

    monkeypatch.setattr(keyed, "_in_buckets", failing)
    with pytest.raises(RuntimeError):
        compact(spark, table, into, KEYS, buckets=8, at_once=1)
    with pytest.raises(Unfinished):
        read_latest(spark, into, KEYS)
    monkeypatch.setattr(keyed, "_in_buckets", real)
    put_batch(many.where("k = 7").withColumn("v", F.lit("later still")), table, 2, KEYS)
    compact(spark, table, into, KEYS, buckets=8, at_once=1)
    assert rows_of(read_latest(spark, into, KEYS)) == want
    assert len(glob.glob(f"{into}/batch=000000001/key_bucket=*")) == 8
    with pytest.raises(FileExistsError):
        compact(spark, table, into, KEYS)


def test_a_table_without_buckets_is_folded_into_one_with_them(spark, many, tmp_path):
    table = f"{tmp_path}/t"
    many.write.parquet(f"{table}/batch=000000000")
    assert read_latest(spark, table, KEYS).count() == 2_000
    with pytest.raises(OtherForm):
        put_batch(many, table, 1, KEYS)
    compact(spark, table, f"{tmp_path}/new", KEYS)
    put_batch(many.where("k = 1").withColumn("v", F.lit("x")), f"{tmp_path}/new", 1, KEYS)
    assert {r.v for r in read_keys(spark, f"{tmp_path}/new", KEYS, [(1, "1970-01-01 00:00:01")]).collect()} == {"x"}
