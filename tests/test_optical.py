"""Kinds of columns whose files may have any header."""

import itertools
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from railpulse.plans.runs import run_files
from railpulse.sinks.files import Zones
from railpulse.sources import optical
from railpulse.sources.dumps import Dimensions
from railpulse.sources.optical import TYPES, joined, kind_of_value, kinds_in, read_optical, read_trusted
from tests.test_sources import put

NO_DIMS = Dimensions(*[None] * 5)


@pytest.mark.parametrize("text, kind", [
    ("0", "whole"), ("-7", "whole"), ("9007199254740992", "whole"), ("9007199254740993", "long"), ("-9223372036854775808", "long"),
    ("9223372036854775808", "text"), ("99999999999999999999", "text"), ("007", "text"), ("-0", "fraction"), ("0.5", "fraction"), (".5", "fraction"),
    ("5.", "fraction"), ("1.0E-5", "fraction"), ("1E20", "fraction"), ("1e999", "text"), ("9007199254740993.5", "text"), ("00.5", "text"), ("NaN", "fraction"),
    ("T1", "text"), ("12:30", "text"), (" 5", "text"), ("1,5", "text"), (".", "text"), ("1d", "text"), (None, None)])
def test_kind_of_a_value(spark, text, kind):
    assert spark.range(1).select(kind_of_value(F.lit(text).cast("string"))).first()[0] == kind


def test_kinds_are_a_lattice():
    for a, b, c in itertools.product(TYPES, repeat=3):
        assert joined(a, a) == a and joined(a, b) == joined(b, a) and joined(joined(a, b), c) == joined(a, joined(b, c))
    assert joined("none", "whole") == "whole" and joined("long", "fraction") == "text" and joined("time", "whole") == "text"


def batch(spark, zones, tmp_path, number, text):
    run_files(spark, "optical", put(f"{tmp_path}/in-{number}-{abs(hash(text))}.csv", text), NO_DIMS, zones, number)


def rows(spark, zones):
    read = read_trusted(spark, zones, "optical")
    return read.columns, sorted((tuple(r) for r in read.collect()), key=str)


def test_number_then_text_then_long(spark, tmp_path):
    zones = Zones(f"{tmp_path}/lake")
    batch(spark, zones, tmp_path, 0, "trem,level,serie\nT1,1,7\nT2,2,8\n")
    assert read_trusted(spark, zones, "optical").dtypes[1:3] == [("level", "double"), ("serie", "double")]
    batch(spark, zones, tmp_path, 1, "trem,level,serie\nT3,high,9007199254740993\n")
    assert read_trusted(spark, zones, "optical").dtypes[1:3] == [("level", "string"), ("serie", "bigint")]
    batch(spark, zones, tmp_path, 2, "level,trem,extra\n9223372036854775807,T4,0.123456789\n")
    columns, found = rows(spark, zones)
    assert columns == ["trem", "level", "serie", "extra", "batch"]
    by_train = {r[columns.index("trem")]: tuple(r[columns.index(c)] for c in ("level", "serie", "extra", "batch")) for r in found}
    assert by_train == {"T1": ("1", 7, None, 0), "T2": ("2", 8, None, 0), "T3": ("high", 9007199254740993, None, 1),
                        "T4": ("9223372036854775807", None, 0.12346, 2)}


def test_a_long_and_a_fraction_meet_in_text(spark, tmp_path):
    path = put(f"{tmp_path}/a.csv", "v,w\n9007199254740993,1\n0.1,2\n")
    read = read_optical(spark, path)
    assert [tuple(r) for r in read.collect()] == [("9007199254740993", 1.0), ("0.1", 2.0)]
    assert kinds_in(read.schema) == {"v": "text", "w": "whole"}
    assert {Decimal(r.v) for r in read.collect()} == {Decimal("9007199254740993"), Decimal("0.1")}


def test_a_replay_and_a_stop_between_rows_and_note(spark, tmp_path, monkeypatch):
    zones = Zones(f"{tmp_path}/lake")
    path = put(f"{tmp_path}/a.csv", "v\n5\n")
    run_files(spark, "optical", path, NO_DIMS, zones, 0)
    with open(path, "w") as file:
        file.write("v\nfive\n")
    monkeypatch.setattr("railpulse.plans.passthrough.put_kinds", lambda *a: (_ for _ in ()).throw(RuntimeError("stopped")))
    with pytest.raises(RuntimeError):
        run_files(spark, "optical", path, NO_DIMS, zones, 0)
    # The rows are there without their note, and never with the note of the rows before.
    assert optical.noted_kinds(spark, zones, "optical") == {}
    assert [r.v for r in read_trusted(spark, zones, "optical").collect()] == ["five"]
    monkeypatch.undo()
    run_files(spark, "optical", path, NO_DIMS, zones, 0)
    assert optical.noted_kinds(spark, zones, "optical")[0]["v"] == "text"


def test_odd_column_names_and_files_without_rows(spark, tmp_path):
    zones = Zones(f"{tmp_path}/lake")
    batch(spark, zones, tmp_path, 0, "a.b,level\n1,2\n")
    batch(spark, zones, tmp_path, 1, "a.b,level\n")
    assert rows(spark, zones) == (["a.b", "level", "batch"], [(1.0, 2.0, 0)])
    with pytest.raises(ValueError):
        read_trusted(spark, Zones(f"{tmp_path}/none"), "optical")
