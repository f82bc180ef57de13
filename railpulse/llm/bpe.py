"""Byte-level BPE over whole texts by overlapping chunks.

A text longer than ``CHUNK`` characters is cut into chunks that overlap. All chunks are pre-tokenised
in parallel; a chunk that begins inside a pre-token is wrong at first, but as the pattern only looks
ahead, two neighbours agree on everything after the first boundary they share in their overlap.
There they are stitched, and the pieces between two such places are encoded in parallel too. Texts
without a shared boundary (a pre-token longer than the overlap) are stitched over more chunks, in the
extreme the whole text. Shorter texts are one chunk. Decoding joins the bytes of the ids.

Ids are kept as little-endian unsigned 32-bit numbers in a binary column.
"""

from __future__ import annotations

import base64
import functools
import uuid
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

CHUNK = 65_536
OVERLAP = 1_024
MARGIN = 8
CACHED = 50_000
IDS = np.dtype("<u4")


class Pieces(dict):
    """The ids of each pre-token met so far, as bytes; emptied when full."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self._encode = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})._encode_single_piece

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= CACHED:
            self.clear()
        ids = np.asarray(self._encode(piece), IDS).tobytes()
        if len(piece) <= 64:
            self[piece] = ids
        return ids


@functools.lru_cache(maxsize=2)
def _ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@functools.lru_cache(maxsize=2)
def _coder(path: str, pattern: str):
    return regex.compile(pattern), Pieces(_ranks(path), pattern)


@functools.lru_cache(maxsize=2)
def _bytes_of(path: str) -> list[bytes]:
    ranks = _ranks(path)
    table = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    return table


def encode_text(text: str | None, path: str, pattern: str) -> bytes:
    """The ids of a whole text, pre-tokenised in one go."""
    pre, pieces = _coder(path, pattern)
    return b"".join(map(pieces.__getitem__, pre.findall(text or "")))


def encode_udf(path: str, pattern: str):
    @F.arrow_udf(BinaryType())
    def encode(texts: pa.Array) -> pa.Array:
        return pa.array((encode_text(text.as_py(), path, pattern) for text in texts), pa.binary())

    return encode


def decode_ids(ids: bytes | None, path: str) -> bytes:
    """Bytes of the ids; an id that is not in the vocabulary fails."""
    table = _bytes_of(path)
    return b"".join(map(table.__getitem__, np.frombuffer(ids or b"", IDS).tolist()))


def decode_udf(path: str):
    @F.arrow_udf(BinaryType())
    def decode(ids: pa.Array) -> pa.Array:
        return pa.array((decode_ids(own.as_py(), path) for own in ids), pa.binary())

    return decode


def with_decoded_udf(path: str):
    """The ids and what they decode to. As the ids are handed on, the function that makes them and
    this one run in one Python worker."""

    @F.arrow_udf("ids binary, decoded binary")
    def with_decoded(ids: pa.Array) -> pa.Array:
        ids = ids.cast(pa.binary())
        decoded = pa.array((decode_ids(own.as_py(), path) for own in ids), pa.binary())
        return pa.StructArray.from_arrays([ids, decoded], ["ids", "decoded"])

    return with_decoded


def _cut(chunk: int, overlap: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for key, text in zip(batch["key"], batch["text"]):
                for no, at in enumerate(range(0, len(text), chunk)):
                    yield pd.DataFrame({"key": [key], "no": [no], "at": [at], "text": [text[at:at + chunk + overlap]]})

    return run


def boundaries(text: str, pattern: regex.Pattern) -> list[int]:
    """Ends of pre-tokens after a character that is no white space, from where a cut is safe.

    Those at the very end are left out: they may be the chunk's and not a pre-token's.
    """
    ends = [m.end() for m in pattern.finditer(text) if not text[m.end() - 1].isspace()]
    return ends[:bisect_left(ends, len(text) - MARGIN)]


def _pretokenise(path: str, pattern: str, chunk: int, overlap: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pre = _coder(path, pattern)[0]
        for batch in batches:
            heads, tails = [], []
            for at, text in zip(batch["at"], batch["text"]):
                ends = boundaries(text, pre)
                heads.append([at + e for e in ends[:bisect_left(ends, overlap)]])
                tails.append([at + e for e in ends[bisect_left(ends, chunk):]])
            yield batch.assign(head=heads, tail=tails)

    return run


def encode_long(texts: DataFrame, path: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``(key, ids)`` for texts ``(key, text)`` with distinct keys, by stitched chunks."""
    if not 0 < overlap < chunk:
        raise ValueError("the overlap must be shorter than a chunk")
    n = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = texts.mapInPandas(_cut(chunk, overlap), "key string, no int, at int, text string")
    marked = cut.repartition(n, "key", "no").mapInPandas(
        _pretokenise(path, pattern, chunk, overlap), "key string, no int, at int, text string, head array<int>, tail array<int>")
    along = Window.partitionBy("key").orderBy("no")
    stitch = F.array_min(F.array_intersect("tail", F.lead("head").over(along)))
    marked = marked.withColumn("stitch", stitch).withColumn("begin", F.coalesce(F.lag("stitch").over(along), F.lit(0)))
    last = F.lead("no").over(along).isNull()
    marked = marked.withColumn("final", last)
    # Where two chunks do not meet, nothing after them is known to be right: the rest is one piece.
    lost = F.coalesce(F.max(F.col("stitch").isNull().cast("int")).over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    marked = marked.withColumn("lost", lost)
    piece = F.when(F.col("lost") == 0, F.col("no")).otherwise(
        F.min(F.when(F.col("stitch").isNull(), F.col("no"))).over(along.rowsBetween(Window.unboundedPreceding, -1)))
    upto = F.when(F.col("final") | F.col("stitch").isNull() | (F.col("lost") == 1), F.col("at") + F.when(F.col("final"), F.length("text")).otherwise(chunk)).otherwise(F.col("stitch"))
    begin = F.when(F.col("lost") == 1, F.col("at")).otherwise(F.col("begin"))
    own = F.substring(F.col("text"), begin - F.col("at") + 1, F.greatest(upto - begin, F.lit(0)))
    pieces = marked.select("key", piece.alias("piece"), F.struct("no", own.alias("own")).alias("part"))
    joined = pieces.groupBy("key", "piece").agg(F.array_join(F.transform(F.array_sort(F.collect_list("part")), lambda p: p["own"]), "").alias("text"))
    coded = joined.repartition(n, "key", "piece").select("key", F.struct("piece", encode_udf(path, pattern)("text").alias("ids")).alias("part"))

    @F.arrow_udf(BinaryType())
    def join_ids(parts: pa.Array) -> pa.Array:
        return pa.array((b"".join(own.as_py()) for own in parts), pa.binary())

    ordered = coded.groupBy("key").agg(F.array_sort(F.collect_list("part")).alias("parts"))
    return ordered.select("key", join_ids(F.transform("parts", lambda p: p["ids"])).alias("ids"))


def encode(docs: DataFrame, path: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``docs`` with a column ``ids`` for the whole of ``text``; a null text counts as empty.

    Long texts are encoded once for all their copies and joined back by a digest; all other rows stay
    where they are. All columns and repeated rows are kept; a column ``ids`` is replaced.
    """
    docs = docs.drop("ids")
    long = F.length("text") > chunk
    short = docs.where(~F.coalesce(long, F.lit(False))).withColumn("ids", encode_udf(path, pattern)("text"))
    key = f"key-{uuid.uuid4().hex[:8]}"
    keyed = docs.where(long).withColumn(key, F.sha2("text", 256))
    texts = keyed.groupBy(F.col(key).alias("key")).agg(F.min("text").alias("text"))
    coded = encode_long(texts, path, pattern, chunk, overlap).withColumnRenamed("key", key)
    return short.unionByName(keyed.join(coded, key).drop(key))


def encode_and_decode(docs: DataFrame, path: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``docs`` without ``text``, with ``coded``: a struct of the ``ids`` of each text and the bytes they decode to.

    Columns ``ids`` and ``coded`` are replaced.
    """
    coded = encode(docs, path, pattern, chunk, overlap)
    return coded.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("text", "ids", "coded")], with_decoded_udf(path)("ids").alias("coded"))


def token_count(ids: Column) -> Column:
    return (F.octet_length(ids) / IDS.itemsize).cast("long")


def report(docs: DataFrame, path: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` for every row of ``docs(doc_id, text)``."""
    both = encode_and_decode(docs.select("doc_id", "text"), path, pattern, chunk, overlap)
    return both.select("doc_id", token_count(F.col("coded.ids")).alias("n_tokens"), F.sha2("coded.ids", 256).alias("ids_sha256"),
                       F.sha2("coded.decoded", 256).alias("decoded_sha256"))
