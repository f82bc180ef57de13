"""Near duplicates by 64-bit SimHash, found through a Gray-order hierarchical index.

Two fingerprints with at most three differing bits agree in one of four 16-bit blocks. The value
of that block is the root pattern of a group. All groups are laid out by one distributed sort by
(block, value, Gray rank of the fingerprint), in which similar bit patterns lie side by side. Runs
of a group become chunks; within a chunk, nodes over ``FANOUT`` neighbours each hold the bits that
all of them share and that their parent does not hold yet. A search adds up the differing bits
from the top and drops a whole node once there are too many. Chunks of the same group meet in
pairs, unless the bits that all of one share already differ too much from those of the other.

Only which fingerprints hang together is passed on: each search emits a spanning forest, never all
pairs of a group, and does not descend where everything below is connected with the query already.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import LongType

from railpulse.llm.components import components
from railpulse.session import Scratch

SHINGLE = 3
SEED = 42
MAX_BITS = 3
BLOCKS = 4
FANOUT = 16
CHUNK = 16_384
QUERIES_AT_ONCE = 64

FOUND = pa.schema([
    ("u", pa.int64()), ("v", pa.int64()), ("block", pa.int32()), ("value", pa.int32()), ("chunk", pa.string()),
    ("size", pa.int32()), ("mask", pa.int64()), ("pattern", pa.int64()), ("members", pa.binary()), ("roots", pa.binary())])


def simhash(text: str | None) -> int:
    """The fingerprint of a text, as a signed 64-bit number; zero for a text without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    width = min(SHINGLE, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(line[a:b], SEED) for a, b in zip(starts, ends[width - 1:].tolist())),
                         np.uint64, len(words) - width + 1)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 65_536):
        octets = hashes[i:i + 65_536].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(0, np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)[0])


@F.arrow_udf(LongType())
def simhash_udf(texts: pa.Array) -> pa.Array:
    return pa.array((simhash(text.as_py()) for text in texts), pa.int64())


def bits(words: np.ndarray) -> np.ndarray:
    return np.bitwise_count(words)


def gray_rank(words: np.ndarray) -> np.ndarray:
    """The place of each word in the reflected Gray code."""
    words = words.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        words ^= words >> np.uint64(shift)
    return words


class GrayIndex:
    """Levels of masked bit patterns over fingerprints in Gray order, leaves first."""

    def __init__(self, members: np.ndarray):
        self.members = members
        full = np.full(len(members), ~np.uint64(0))
        levels = [(members, full)]
        while len(levels[-1][0]) > FANOUT:
            pattern, mask = levels[-1]
            at = np.arange(0, len(pattern), FANOUT)
            first = np.repeat(pattern[at], np.diff(np.append(at, len(pattern))))
            mask = np.bitwise_and.reduceat(mask & ~(pattern ^ first), at)
            levels.append((pattern[at] & mask, mask))
        self.levels = []
        for i, (pattern, mask) in enumerate(levels):
            above = levels[i + 1][1] if i + 1 < len(levels) else np.zeros(1, np.uint64)
            held = above[np.minimum(np.arange(len(mask)) // FANOUT, len(above) - 1)]
            self.levels.append((pattern, mask & ~held))

    def shared(self) -> tuple[np.uint64, np.uint64]:
        """The bits on which all members agree, and their values."""
        differ = np.bitwise_or.reduce(self.members ^ self.members[0])
        return ~differ, self.members[0] & ~differ

    def near(self, queries: np.ndarray, most: int, query_part=None, member_part=None) -> tuple[np.ndarray, np.ndarray]:
        """Indices of queries and members with at most ``most`` differing bits.

        With parts given, a node is also dropped where all its members are of the query's part.
        """
        parts = None
        if member_part is not None:
            parts = [member_part]
            for pattern, _ in self.levels[1:]:
                at = np.arange(0, len(parts[-1]), FANOUT)
                low, high = np.minimum.reduceat(parts[-1], at), np.maximum.reduceat(parts[-1], at)
                parts.append(np.where((low == high), low, -1))
        top = len(self.levels) - 1
        nodes = len(self.levels[top][0])
        q = np.repeat(np.arange(len(queries)), nodes)
        node = np.tile(np.arange(nodes), len(queries))
        so_far = np.zeros(len(q), np.uint8)
        for level in range(top, -1, -1):
            pattern, mask = self.levels[level]
            so_far = so_far + bits((queries[q] ^ pattern[node]) & mask[node])
            keep = so_far <= most
            if parts is not None:
                keep &= parts[level][node] != query_part[q]
            q, node, so_far = q[keep], node[keep], so_far[keep]
            if level:
                below = len(self.levels[level - 1][0])
                q, so_far = np.repeat(q, FANOUT), np.repeat(so_far, FANOUT)
                node = (node[:, None] * FANOUT + np.arange(FANOUT)).ravel()
                keep = node < below
                q, node, so_far = q[keep], node[keep], so_far[keep]
        return q, node


def join_parts(part: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``part`` (the smallest member of each member's part) after linking ``a`` with ``b``."""
    while True:
        left, right = part[a], part[b]
        if (left == right).all():
            return part
        np.minimum.at(part, np.maximum(left, right), np.minimum(left, right))
        while not (part == (further := part[part])).all():
            part = further


def parts_within(index: GrayIndex, most: int) -> np.ndarray:
    part = np.arange(len(index.members))
    for i in range(0, len(part), QUERIES_AT_ONCE):
        j = min(i + QUERIES_AT_ONCE, len(part))
        q, m = index.near(index.members[i:j], most, part[i:j], part)
        part = join_parts(part, q + i, m)
    return part


def links_between(one: np.ndarray, one_part: np.ndarray, two: np.ndarray, two_part: np.ndarray, most: int):
    """Links that join the parts of two chunks, one for each part joined."""
    part = np.concatenate([one_part, two_part + len(one)])
    before, index = part.copy(), GrayIndex(two)
    for i in range(0, len(one), QUERIES_AT_ONCE):
        j = min(i + QUERIES_AT_ONCE, len(one))
        q, m = index.near(one[i:j], most, part[i:j], part[len(one):])
        part = join_parts(part, q + i, m + len(one))
    moved = np.flatnonzero((before == np.arange(len(part))) & (part != before))
    both = np.concatenate([one, two])
    return both[part[moved]], both[moved]


def _chunks(most: int, chunk: int):
    """Search in runs of sorted rows ``(block, value, fp)``; emit links, and groups in several runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, key, rows, first, cut = uuid.uuid4().hex, None, [], True, False
        links, chunks = [], []

        def close(shared: bool) -> None:
            """End a run. The first and last group of a partition may go on in another one."""
            nonlocal rows
            words = np.concatenate(rows) if rows else np.empty(0, np.uint64)
            rows = []
            if len(words) == 0 or len(words) == 1 and not shared:
                return
            index = GrayIndex(words)
            part = parts_within(index, most)
            linked = np.flatnonzero(part != np.arange(len(part)))
            links.append((words[linked], words[part[linked]]))
            if shared:
                mask, pattern = index.shared()
                chunks.append({
                    "block": key[0], "value": key[1], "chunk": f"{name}-{uuid.uuid4().hex}", "size": len(words),
                    "mask": int(mask.view(np.int64)), "pattern": int(pattern.view(np.int64)),
                    "members": words.tobytes(), "roots": part.astype(np.int32).tobytes()})

        def emit() -> Iterator[pa.RecordBatch]:
            if links:
                u, v = (np.concatenate(x).view(np.int64) for x in zip(*links))
                rest = [pa.nulls(len(u), field.type) for field in list(FOUND)[2:]]
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v), *rest], schema=FOUND)
            if chunks:
                yield pa.RecordBatch.from_pylist(chunks, schema=FOUND)
            links.clear()
            chunks.clear()

        for batch in batches:
            block, value, words = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            at = np.flatnonzero(np.append(True, (np.diff(block) != 0) | (np.diff(value) != 0))) if len(block) else []
            for a, b in zip(at, [*at[1:], len(block)]):
                if (this := (int(block[a]), int(value[a]))) != key:
                    close(first or cut)
                    first, key, cut = key is None, this, False
                piece = words[a:b].view(np.uint64)
                while (room := chunk - sum(map(len, rows))) < len(piece):
                    rows.append(piece[:room])
                    piece, cut = piece[room:], True
                    close(True)
                rows.append(piece)
            yield from emit()
        close(True)
        yield from emit()

    return run


def _pairs(most: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                u, v = links_between(
                    np.frombuffer(row.members, np.uint64), np.frombuffer(row.roots, np.int32).astype(np.int64),
                    np.frombuffer(row.other_members, np.uint64), np.frombuffer(row.other_roots, np.int32).astype(np.int64), most)
                yield pd.DataFrame({"u": u.view(np.int64), "v": v.view(np.int64)})

    return run


@F.pandas_udf(LongType())
def gray_rank_udf(words: pd.Series) -> pd.Series:
    """The Gray rank, shifted so that signed order is rank order."""
    rank = gray_rank(words.to_numpy().view(np.uint64)) ^ np.uint64(1 << 63)
    return pd.Series(rank.view(np.int64))


def fingerprint_links(nodes: DataFrame, scratch: Scratch, most: int = MAX_BITS, chunk: int = CHUNK) -> DataFrame:
    """Links ``(u, v)`` that connect all fingerprints ``fp`` at ``most`` or fewer differing bits.

    ``nodes`` holds each fingerprint once. The links span the same components as all pairs
    would. ``most`` must be below ``BLOCKS``. Memory: one chunk, at most ``chunk`` fingerprints.
    """
    if most >= BLOCKS:
        raise ValueError(f"at most {BLOCKS - 1} differing bits")
    width = 64 // BLOCKS
    keys = F.array(*[
        F.struct(F.lit(i).alias("block"), F.shiftrightunsigned("fp", width * i).bitwiseAND(2**width - 1).cast("int").alias("value"))
        for i in range(BLOCKS)])
    keyed = nodes.select("fp", gray_rank_udf("fp").alias("rank")).select("fp", "rank", F.inline(keys))
    n = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = scratch.save(
        keyed.repartitionByRange(n, "block", "value", "rank").sortWithinPartitions("block", "value", "rank")
        .select("block", "value", "fp").mapInArrow(_chunks(most, chunk), from_arrow_schema(FOUND)), "found")
    chunks = found.where("chunk is not null")
    told = chunks.select("block", "value", "chunk", "mask", "pattern")
    other = told.select("block", "value", F.col("chunk").alias("other"), F.col("mask").alias("m"), F.col("pattern").alias("p"))
    meets = told.join(other, ["block", "value"]).where(
        (F.col("chunk") < F.col("other"))
        & (F.bit_count(F.col("mask").bitwiseAND(F.col("m")).bitwiseAND(F.col("pattern").bitwiseXOR(F.col("p")))) <= most)
    ).select("chunk", "other")
    held = chunks.select("chunk", "members", "roots")
    pairs = meets.join(held, "chunk").join(
        held.select(F.col("chunk").alias("other"), F.col("members").alias("other_members"), F.col("roots").alias("other_roots")), "other")
    across = pairs.select("members", "roots", "other_members", "other_roots").mapInPandas(_pairs(most), "u long, v long")
    return found.where("u is not null").select("u", "v").unionAll(across)


def fingerprint_groups(prints: DataFrame, scratch: Scratch, most: int = MAX_BITS) -> DataFrame:
    """``(fp, component_id)`` for the distinct fingerprints of ``prints(doc_id, fp)``.

    ``component_id`` is the smallest ``doc_id`` reachable over links; rows without a doc_id count
    only where all are without, and then it is null.
    """
    nodes = scratch.save(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    root = components(fingerprint_links(nodes, scratch, most), scratch).withColumnRenamed("node", "fp")
    rooted = nodes.join(root, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(least, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, scratch: Scratch, most: int = MAX_BITS) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs(doc_id, text)``.

    Null and empty texts have fingerprint zero and link like any other. Equal rows give equal
    rows. Other columns are ignored. An empty table gives an empty one.
    """
    prints = scratch.save(docs.select("doc_id", simhash_udf("text").alias("fp")), "prints")
    groups = fingerprint_groups(prints, scratch, most).select("fp", "component_id")
    return prints.join(groups, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, scratch: Scratch, most: int = MAX_BITS) -> DataFrame:
    """One row of each group of near duplicates, with all its columns.

    The smallest doc_id stays, of rows with equal ids that with the smallest hash of its text, of
    equal rows any one. Rows without a doc_id come last. All columns of ``docs`` are kept.
    """
    names = docs.columns
    prints = scratch.save(docs.select("doc_id", F.xxhash64("text").alias("hash"), simhash_udf("text").alias("fp")), "prints")
    groups = fingerprint_groups(prints, scratch, most).select("fp", "root")
    # The choice is made on narrow rows: one map-side combined minimum per group.
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "hash")
    chosen = prints.join(groups, "fp").groupBy("root").agg(F.min(order).alias("first")).select("first.*")
    keys = docs.select("*", F.xxhash64("text").alias("#hash"))
    chosen = chosen.select(F.col("doc_id").alias("#id"), F.col("hash").alias("#of"))
    stay = keys.join(chosen, F.col("doc_id").eqNullSafe(F.col("#id")) & (F.col("#hash") == F.col("#of")))
    # Rows that are alike in id and text can only be told apart by counting them.
    turn = F.row_number().over(Window.partitionBy("#id", "#of").orderBy("#hash"))
    return stay.withColumn("#turn", turn).where("`#turn` = 1").select(*[F.col(f"`{c}`") for c in names])
