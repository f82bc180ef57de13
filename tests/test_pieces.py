"""Dumps cut at item boundaries, against the plain JSON parser."""

import gzip
import json
import random

import pytest
from pyspark.sql import functions as F

from railpulse.sources.dumps import read_typed_dump
from railpulse.sources.pieces import dump_items, read_pieces, sound_files, split_items, with_depth

SPLIT = "spark.sql.files.maxPartitionBytes"
ODD = ['}', '{', '"', '\\', '\\"', '}\\', ',', ': [', '"Items": [{', '\n', '\t', 'é', ' ', '😀', "'", ' ', 'x', '}']


def texts(seed, n):
    draw = random.Random(seed)
    return ["".join(draw.choice(ODD) for _ in range(draw.randint(0, 12))) for _ in range(n)]


def dump(path, body, encoding="utf-8", **form):
    path.write_text(body if isinstance(body, str) else json.dumps(body, **form), encoding=encoding, newline="")
    return str(path)


@pytest.fixture
def split_into(spark):
    old, at_once = spark.conf.get(SPLIT), spark.conf.get("spark.sql.files.openCostInBytes")

    def cut(size, splits):
        spark.conf.set(SPLIT, str(max(1, -(-size // splits))))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")

    yield cut
    spark.conf.set(SPLIT, old)
    spark.conf.set("spark.sql.files.openCostInBytes", at_once)


@pytest.mark.parametrize("splits", [1, 3, 50])
@pytest.mark.parametrize("form", [{}, {"indent": 2}, {"ensure_ascii": False, "separators": (",", ":")}])
def test_items_are_those_of_a_plain_parser(spark, scratch, split_into, tmp_path, splits, form):
    names = texts(splits, 300)
    items = [{"linha_id": {"S": f"{n}"}, "cor": {"S": name}, **({"extra": {"M": {"a": {"S": name}}}} if n % 3 else {})} for n, name in enumerate(names)]
    body = {"Name": "a{b}\"[", "Meta": {"a": {"b": 1}}, "Items": items, "Count": 300, "After": {"c": "}"}}
    path = dump(tmp_path / "d d.json", body, **form)
    split_into((tmp_path / "d d.json").stat().st_size, splits)
    pieces = read_pieces(spark, path)
    assert splits == 1 or pieces.select("block").distinct().count() >= splits // 2
    longest = max(len(json.dumps(i, **form)) for i in items)
    assert pieces.agg(F.max(F.length("value"))).first()[0] <= longest + 200
    found = split_items(spark, path, scratch)[0].collect()
    assert [json.loads(r.text) for r in sorted(found, key=lambda r: r.place)] == items
    rows = read_typed_dump(spark, path, "Linha", scratch).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, read_typed_dump(spark, path, "Linha").collect()))
    assert sorted(r.cor for r in rows) == sorted(names)


@pytest.mark.parametrize("splits", [1, 6])
def test_files_of_all_kinds_together(spark, scratch, split_into, tmp_path, splits):
    folder = tmp_path / "in"
    folder.mkdir()
    expected = []
    for n, encoding in enumerate(["utf-8", "utf-8-sig", "utf-16", "utf-16-le"]):
        items = [{"linha_id": {"S": f"{n}-{i}"}, "cor": {"S": name}} for i, name in enumerate(texts(n, 20))]
        expected += [(i["linha_id"]["S"], i["cor"]["S"]) for i in items]
        dump(folder / f"{n}.json", json.dumps({"Items": items}) + ("\n \n" if n < 2 else ""), encoding)
    dump(folder / "none.json", {"Items": []})
    dump(folder / "other.json", '{"Count": 0\n}')
    split_into(2000, splits)
    assert sorted(map(tuple, read_typed_dump(spark, str(folder), "Linha", scratch).collect())) == sorted(expected)


def test_any_cut_of_a_dump_is_found(spark, scratch, tmp_path):
    items = [{"linha_id": {"S": f"{n}"}, "cor": {"S": "}{"}} for n in range(2)]
    body = json.dumps({"Items": items, "Count": 2})
    for end in range(1, len(body)):
        dump(tmp_path / f"{end}.json", body[:end], "utf-8-sig" if end % 2 else "utf-8")
    for n, (end, encoding) in enumerate([("", "utf-8"), (" ", "utf-8"), ("", "utf-8-sig"), ("\r\n", "utf-8-sig")]):
        dump(tmp_path / f"whole{n}.json", body + end, encoding)
    pieces = scratch.save(read_pieces(spark, str(tmp_path)), "pieces")
    sound = {r.file.rsplit("/", 1)[1]: r.sound for r in sound_files(with_depth(pieces)).collect()}
    assert len(sound) == len(body) + 3 and sorted(f for f in sound if sound[f]) == [f"whole{n}.json" for n in range(4)]
    with pytest.raises(Exception, match="damaged dump"):
        dump_items(pieces).collect()
    with gzip.open(tmp_path / "p.json.gz", "wt") as packed:
        packed.write(body + "\n")
    assert dump_items(read_pieces(spark, str(tmp_path / "p.json.gz"))).count() == 2


def test_other_arrays_of_objects_are_refused(spark, tmp_path):
    path = dump(tmp_path / "d.json", {"Items": [{"a": {"S": "1"}}], "Others": [{"a": {"S": "2"}}]})
    with pytest.raises(Exception, match="not an array of items"):
        dump_items(read_pieces(spark, path)).collect()
