"""Tables replaced whole, with a failure after every step."""

import json

import pytest
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from railpulse.schemas import dimension_schema
from railpulse.sinks import versions as V
from railpulse.sinks.files import stored, write_csv
from railpulse.sources.dumps import load_dimensions, read_dimension
from tests.test_sources import put

KV = StructType([StructField("k", IntegerType()), StructField("v", StringType())])


class Stopped(Exception):
    """The writer ends here."""


def stop(*_, **__):
    raise Stopped


def rows(spark, table):
    return sorted(tuple(r) for r in V.read_version(spark, table, KV).collect())


def frame(spark, *values):
    return spark.createDataFrame(list(values), KV)


def half_written(spark, path, name):
    """A pointer that is there, without its name."""
    place, store = stored(spark, path)
    store.create(place, False).close()
    raise Stopped


def after_the_pointer(spark, path, name, write=V.write_note):
    write(spark, path, name)
    raise Stopped


def after_the_rows(df, path):
    df.write.parquet(path)
    raise Stopped


def half_of_the_rows(df, path):
    df.limit(1).write.parquet(path)
    raise Stopped


@pytest.mark.parametrize("step, broken, new", [
    ("write_parquet", stop, False), ("write_parquet", half_of_the_rows, False), ("write_parquet", after_the_rows, False),
    ("write_note", stop, False), ("write_note", half_written, False), ("write_note", after_the_pointer, True), ("_clean", stop, True)])
def test_a_writer_that_stops_leaves_old_or_new_rows(spark, tmp_path, monkeypatch, step, broken, new):
    """And the next writer is not held up by what it left."""
    table, old = f"{tmp_path}/t", frame(spark, (1, "a"), (2, "b"))
    V.put_version(old, table)
    whole = [(1, "c"), (3, "d")]
    with monkeypatch.context() as patch:
        patch.setattr(V, step, broken)
        with pytest.raises(Stopped):
            V.put_version(frame(spark, *whole), table, write=V.write_parquet)    # the patched one
    assert rows(spark, table) == (whole if new else [(1, "a"), (2, "b")])
    V.put_version(frame(spark, (9, "z")), table, after=V.current(spark, table)[0])
    assert rows(spark, table) == [(9, "z")]


def test_a_load_that_stops_keeps_every_key(spark, tmp_path, monkeypatch):
    """Keys 1 and 2 are there, a load of 3 stops anywhere, and is run again."""
    def dump(*keys):
        return put(f"{tmp_path}/{'-'.join(keys)}.json", json.dumps({"Items": [{"linha_id": {"S": k}, "cor": {"S": f"c{k}"}} for k in keys]}))

    for n, (step, broken) in enumerate([("write_note", stop), ("write_note", half_written), ("write_note", after_the_pointer), ("_clean", stop)]):
        tables = f"{tmp_path}/dims{n}"
        load_dimensions(spark, {"Linha": dump("1", "2")}, tables)
        with monkeypatch.context() as patch:
            patch.setattr(V, step, broken)
            with pytest.raises(Stopped):
                load_dimensions(spark, {"Linha": dump("3")}, tables)
        keys = sorted(r.linha_id for r in read_dimension(spark, tables, "Linha").collect())
        assert keys in (["1", "2"], ["1", "2", "3"])
        load_dimensions(spark, {"Linha": dump("3")}, tables)
        assert sorted(r.linha_id for r in read_dimension(spark, tables, "Linha").collect()) == ["1", "2", "3"]


def test_of_two_writers_from_one_version_the_first_succeeds(spark, tmp_path):
    table = f"{tmp_path}/t"
    start = V.put_version(frame(spark, (1, "a")), table)

    def meanwhile(df, path):
        df.write.parquet(path)
        V.put_version(frame(spark, (2, "first")), table, after=start)

    with pytest.raises(V.VersionTaken):
        V.put_version(frame(spark, (3, "second")), table, after=start, write=meanwhile)
    assert rows(spark, table) == [(2, "first")]


def test_a_pointer_that_is_finished_late_is_noticed(spark, tmp_path, monkeypatch):
    """The first writer's pointer is empty while the second puts a version; the first then is told."""
    table, write = f"{tmp_path}/t", V.write_note
    start = V.put_version(frame(spark, (1, "a")), table)

    def slow(spark, path, name):
        monkeypatch.setattr(V, "write_note", write)
        place, store = stored(spark, path)
        stream = store.create(place, False)
        V.put_version(frame(spark, (2, "second")), table, after=start)
        stream.writeUTF(name)
        stream.close()

    monkeypatch.setattr(V, "write_note", slow)
    with pytest.raises(V.VersionTaken):
        V.put_version(frame(spark, (3, "first")), table, after=start)
    assert rows(spark, table) == [(2, "second")]


def test_old_versions_go_but_one(spark, tmp_path):
    table = tmp_path / "t"
    for n in range(5):
        V.put_version(frame(spark, (n, "x")), str(table))
        first = V.current(spark, str(table))[1]
    assert len(list(table.glob("version-*"))) == 2 == len([p for p in (table / V.POINTERS).iterdir() if p.name.isdigit()])
    planned = spark.read.schema(KV).parquet(first)
    V.put_version(frame(spark, (9, "y")), str(table))
    assert [tuple(r) for r in planned.collect()] == [(4, "x")] and rows(spark, str(table)) == [(9, "y")]


def test_no_version_and_other_formats(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        V.read_version(spark, f"{tmp_path}/none", KV)
    with pytest.raises(FileNotFoundError):
        read_dimension(spark, f"{tmp_path}/none", "Linha")
    V.put_version(frame(spark, (1, "a")), f"{tmp_path}/c", write=write_csv)
    assert spark.read.option("header", True).csv(V.current(spark, f"{tmp_path}/c")[1]).first().v == "a"
    assert dimension_schema("Linha").names == ["linha_id", "cor"]
