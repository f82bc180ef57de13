"""Exact duplicates through recipes of content-defined chunks.

A text is lower-cased (A to Z only) and cut where a rolling hash of its last bytes says so, so equal
stretches of text are cut alike wherever they stand. A chunk has a 128-bit fingerprint; every different
chunk moves to one place once, where the chunks of a fingerprint are compared byte by byte. Chunks that
differ under one fingerprint are told apart by number, all others are identified by the fingerprint. A
text then is its recipe, the ordered list of its chunks' identifiers: equal texts have equal recipes and
different texts different ones. Only recipes, a small part of the text, are grouped and joined.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from railpulse.session import Scratch

LEAST, MOST = 512, 16_384
# A cut follows where this many leading bits of the rolling hash are zero: one byte in 2,048.
CUT_BITS = 11
# Bytes that the rolling hash looks back on; bytes of a text that are hashed at a time.
REACH, BLOCK = 16, 1 << 20
DIGEST = 16
# Rows that a task sends on at a time, by their bytes.
SEND = 4 << 20

GEAR = np.array([zlib.crc32(bytes([byte])) >> 16 for byte in range(256)], np.uint16)
LOWER = bytes(byte + 32 if 65 <= byte <= 90 else byte for byte in range(256))


def fingerprint(chunk: bytes) -> bytes:
    return xxhash.xxh3_128_digest(chunk)


def _marks(data: bytes) -> list[int]:
    """Places after which the rolling hash asks for a cut, in ascending order."""
    found = []
    for at in range(0, len(data), BLOCK):
        start = max(0, at - REACH)
        rolled = GEAR[np.frombuffer(data, np.uint8, min(len(data), at + BLOCK) - start, start)]
        for step in (1, 2, 4, 8):
            rolled[step:] += rolled[:-step] << np.uint16(step)
        hits = np.flatnonzero(rolled[at - start:] >> np.uint16(16 - CUT_BITS) == 0)
        found.extend((hits + at + 1).tolist())
    return found


def chunks(data: bytes) -> list[bytes]:
    """Consecutive parts of ``LEAST`` to ``MOST`` bytes (the last may be shorter), cut by their content."""
    if len(data) <= LEAST:
        return [data] if data else []
    marks, out, at, place = _marks(data), [], 0, 0
    while at < len(data):
        place = bisect_left(marks, at + LEAST, place)
        end = min(marks[place] if place < len(marks) else len(data), at + MOST, len(data))
        out.append(data[at:end])
        at = end
    return out


def normalised(text: pa.StringScalar) -> bytes:
    """Lower-cased bytes; none for null."""
    return text.as_buffer().to_pybytes().translate(LOWER) if text.is_valid else b""


def _sent(schema: pa.Schema, rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """Rows as batches of about ``SEND`` bytes."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(value) for value in row if isinstance(value, (bytes, str))) + 32
        if size >= SEND:
            yield pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*held), schema.types)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*held), schema.types)], schema=schema)


def numbered(docs: DataFrame) -> DataFrame:
    """``row, doc_id, text``; ``row`` tells rows apart."""
    return docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")


def recipes(rows: DataFrame, mark: Callable[[bytes], bytes] = fingerprint) -> DataFrame:
    """``row, doc_id, text_sha256, recipe`` of numbered rows; ``recipe`` holds the fingerprints of the chunks."""
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("text_sha256", pa.string()), ("recipe", pa.binary())])

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for row, doc_id, text in zip(batch["row"].to_pylist(), batch["doc_id"].to_pylist(), batch["text"]):
                data = normalised(text)
                yield row, doc_id, hashlib.sha256(data).hexdigest(), b"".join(map(mark, chunks(data)))

    return rows.mapInArrow(lambda batches: _sent(schema, made(batches)), "row long, doc_id long, text_sha256 string, recipe binary")


def bodies(texts: DataFrame, mark: Callable[[bytes], bytes] = fingerprint) -> DataFrame:
    """``mark, body`` of the chunks of ``texts(text)``, those a batch repeats once."""
    schema = pa.schema([("mark", pa.binary()), ("body", pa.binary())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            seen = set()
            for text in batch["text"]:
                for chunk in chunks(normalised(text)):
                    key = mark(chunk), chunk
                    if key not in seen:
                        seen.add(key)
                        yield key

    return texts.select("text").mapInArrow(lambda batches: _sent(schema, rows(batches)), "mark binary, body binary")


def meant_chunks(rows: DataFrame, shared: DataFrame, mark: Callable[[bytes], bytes]) -> DataFrame:
    """``row, meant``: which of the chunks ``shared(mark, body, number)`` stand where in a row's text, as ``place:number,...``."""
    schema = pa.schema([("row", pa.int64()), ("place", pa.int64()), ("mark", pa.binary()), ("body", pa.binary())])

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for row, text in zip(batch["row"].to_pylist(), batch["text"]):
                for place, chunk in enumerate(chunks(normalised(text))):
                    yield row, place, mark(chunk), chunk

    placed = rows.select("row", "text").mapInArrow(lambda batches: _sent(schema, made(batches)), "row long, place long, mark binary, body binary")
    found = placed.join(shared, ["mark", "body"]).groupBy("row").agg(F.array_sort(F.collect_list(F.struct("place", "number"))).alias("found"))
    return found.select("row", F.concat_ws(",", F.transform("found", lambda x: F.concat_ws(":", x["place"], x["number"]))).alias("meant"))


def identified(docs: DataFrame, scratch: Scratch, mark: Callable[[bytes], bytes] = fingerprint) -> DataFrame:
    """``recipes`` of verified identifiers, written down.

    Where chunks share a fingerprint, which a 128-bit one is not known to bring about, a recipe also says
    which of them are meant.
    """
    store = bodies(docs, mark).distinct()
    several = scratch.save(store.groupBy("mark").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("mark"), "shared-marks")
    if several.isEmpty():
        return scratch.save(recipes(numbered(docs), mark).withColumn("meant", F.lit("")), "recipes")
    number = F.row_number().over(Window.partitionBy("mark").orderBy("body")).alias("number")
    shared = scratch.save(store.join(several, "mark").select("mark", "body", number), "shared-bodies")
    rows = scratch.save(numbered(docs), "numbered")
    told = recipes(rows, mark).join(meant_chunks(rows, shared, mark), "row", "left")
    return scratch.save(told.withColumn("meant", F.coalesce("meant", F.lit(""))), "recipes")


def duplicates(docs: DataFrame, scratch: Scratch, mark: Callable[[bytes], bytes] = fingerprint) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row of ``docs(doc_id, text)``.

    Rows whose texts are equal but for the case of A to Z form a group; a null text is empty. The row
    with the largest doc_id stays; a null doc_id is smaller than all others. Where rows repeat that doc_id
    one of them stays, and the others carry ``kept`` false. Other columns are ignored; an empty table
    gives an empty result. Groups are aggregated in the map tasks and written, and rows meet them in an
    equi-join, which AQE splits where a group is hot.
    """
    rows = identified(docs, scratch, mark)
    first = F.max(F.struct("doc_id", (-F.col("row")).alias("turn"))).alias("first")
    groups = scratch.save(rows.groupBy("recipe", "meant").agg(F.count(F.lit(1)).alias("group_size"), first), "groups")
    return (rows.join(groups, ["recipe", "meant"])
            .select("doc_id", F.col("first.doc_id").alias("keep_id"), "group_size",
                    (F.col("row") == -F.col("first.turn")).alias("kept"), "text_sha256"))
