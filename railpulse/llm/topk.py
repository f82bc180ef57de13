"""Exact top-k inner products by a three-phase uniform threshold.

A vector's score is a sum over slices of its components, and every slice has its own list of
partial scores. First, each list's highest entries are gathered, and only their scores are made whole: the k-th
best of a query is a safe cutoff. Second, the cutoff goes out with the queries: a vector that
reaches it has at least an m-th of it in one of m lists, so each list gives up its entries from there
on, and they are sufficient. Third, the other slices of these entries alone are fetched and added, and those that reach the
cutoff compete. No other pair is ever summed.

Queries meet the vectors in blocks. A cutoff travels with its query in its block, never all at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from railpulse.llm.vectors import best, meet, pack, rows_of, usable
from railpulse.session import Scratch

BLOCK = 8_192
QUERY_BLOCK = 1_024
AT_ONCE = 128
# Of 2,000 vectors of the test table two lists leave 7 % of the pairs to be summed, four lists 37 %.
SLICES = 2
# A list's highest entries that phase one gathers, as a multiple of k: with k alone the cutoff leaves twice as many pairs.
DEPTH = 4
SCALE = 1024
LOWEST = np.iinfo(np.int64).min


def _lists(row, slices: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, list[np.ndarray]]]:
    """For some queries at a time: their place, ids, and the partial scores of each slice.

    Sums beyond 64 bits wrap, as long arithmetic in SQL does without ANSI checks.
    """
    mine = np.frombuffer(row.data, np.int64).reshape(row.n, row.dims)
    asked = np.frombuffer(row.q_data, np.int64).reshape(row.q_n, row.q_dims)
    ids, q_ids = np.frombuffer(row.ids, np.int64), np.frombuffer(row.q_ids, np.int64)
    small = float(np.abs(mine.astype(float)).max()) * float(np.abs(asked.astype(float)).max()) * row.dims < 2**53
    if small:  # the products of doubles are then exact
        mine, asked = mine.astype(float), asked.astype(float)
    cuts = [(row.dims * i // slices, row.dims * (i + 1) // slices) for i in range(slices)]
    for at in range(0, row.q_n, AT_ONCE):
        own = q_ids[at:at + AT_ONCE]
        parts = [(asked[at:at + AT_ONCE, a:b] @ mine[:, a:b].T).astype(np.int64) for a, b in cuts]
        yield at, own, own[:, None] == ids[None, :], parts


def heads(parts: list[np.ndarray], self_: np.ndarray, k: int) -> np.ndarray:
    """Of each query, the columns of the ``k`` highest entries of every list, in order; some may come twice."""
    some = min(k, self_.shape[1])
    tops = [np.argpartition(np.where(self_, LOWEST, part), -some, axis=1)[:, -some:] for part in parts]
    return np.sort(np.concatenate(tops, axis=1), axis=1)


def sufficient(parts: list[np.ndarray], self_: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs that some list gives up: those with an even share of their query's cutoff, or more, in it."""
    share = -(-cut[:, None] // len(parts))
    given = parts[0] >= share
    for part in parts[1:]:
        given |= part >= share
    return np.nonzero(given & ~self_)


def resolved(parts: list[np.ndarray], q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The whole scores of some pairs."""
    return sum(part[q, v] for part in parts)


def _gather(k: int, slices: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in rows_of(batch):
                for _, own, self_, parts in _lists(row, slices):
                    cols = heads(parts, self_, DEPTH * k)
                    q = np.arange(len(own))[:, None]
                    scores = np.where(self_[q, cols], LOWEST, resolved(parts, q, cols))
                    # An entry of several lists counts once.
                    scores[:, 1:][cols[:, 1:] == cols[:, :-1]] = LOWEST
                    at, col = best(scores, np.arange(scores.shape[1]), k)
                    yield pd.DataFrame({"id": own[at], "score": scores[at, col]})

    return run


def _collect(k: int, slices: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in rows_of(batch):
                ids, cutoff = np.frombuffer(row.ids, np.int64), np.frombuffer(row.q_cutoff, np.int64)
                for at, own, self_, parts in _lists(row, slices):
                    cut = cutoff[at:at + len(own)]
                    q, v = sufficient(parts, self_, cut)
                    whole = resolved(parts, q, v)
                    # The highest of each query, smaller ids first.
                    reach = whole >= cut[q]
                    q, v, whole = q[reach], v[reach], whole[reach]
                    order = np.lexsort((ids[v], -whole, q))
                    q, v, whole = q[order], v[order], whole[order]
                    first = np.arange(len(q)) - np.searchsorted(q, q) < k
                    yield pd.DataFrame({"query_id": own[q[first]], "vec_id": ids[v[first]], "score": whole[first]})

    return run


def top_k(vectors: DataFrame, is_query, scratch: Scratch, k: int = 10, slices: int = SLICES) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` highest integer inner products.

    ``vectors(vec_id, embedding)``, components turned into floor(1024 * x); ``is_query`` says which
    rows are queries. Candidates are all rows with another vec_id and as many components. Vectors
    that are null or empty, or hold null or non-finite components, take no part, nor do rows without a
    vec_id. A repeated row is a candidate as often as it comes; a repeated query id asks once, with its
    smallest vector. Ties go to the smaller vec_id.
    """
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("long"))
    rows = vectors.where(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).select(F.col("vec_id").alias("id"), whole.alias("vector"))
    blocks = scratch.save(pack(rows, BLOCK, "int64"), "vectors")
    asked = scratch.save(rows.where(is_query(F.col("id"))).groupBy("id").agg(F.min("vector").alias("vector")), "queries")
    plain = scratch.save(pack(asked, QUERY_BLOCK, "int64"), "asked")
    tops = meet(blocks, plain).mapInPandas(_gather(k, slices), "id long, score long")
    place = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("score")))
    cutoff = tops.withColumn("place", place).where(F.col("place") <= k).groupBy("id").agg(
        F.min("score").alias("score"), F.count("*").alias("n"))
    safe = F.coalesce(F.when(F.col("n") >= k, F.col("score")), F.lit(LOWEST + slices)).alias("cutoff")
    armed = scratch.save(pack(asked.join(cutoff, "id", "left").select("id", "vector", safe), QUERY_BLOCK, "int64", ("cutoff",)), "armed")
    found = meet(blocks, armed).mapInPandas(_collect(k, slices), "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
