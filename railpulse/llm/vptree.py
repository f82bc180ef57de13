"""Approximate nearest neighbours with a vantage-point tree per shard.

Nearness is the inner product. With one more component that brings all vectors of a shard to the same
length, the nearest by Euclidean distance is that with the largest inner product, and the triangle
inequality holds. A node's vantage point parts the others at the median distance. A subtree is left
out if its nearest possible point lies beyond the k-th best so far; ``factor`` stretches that gap, so
above 1 more is left out and a few neighbours may be missed, and 1 restores exact search.

A tree is kept as its vectors in depth-first order with two radii for each vantage point. Many
queries go through a tree together; a first descent to one leaf each gives a safe bound to start from.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from railpulse.llm.vectors import meet, pack, rows_of, usable
from railpulse.session import Scratch

SHARD = 8_192
QUERY_BLOCK = 512
LEAF = 64
FACTOR = 1.5


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products in double precision; each by the same steps, wherever its vectors stand."""
    return np.einsum("ij,kj->ik", a, b)


def plant(block: dict) -> dict:
    """Order a block's vectors as a tree and add ``inner`` and ``outer`` radii."""
    n = block["n"]
    vectors = np.frombuffer(block["data"], np.float32).reshape(n, block["dims"])
    doubles = vectors.astype(float)
    squares = np.einsum("ij,ij->i", doubles, doubles)
    lifted = np.concatenate([doubles, np.sqrt(squares.max() - squares)[:, None]], axis=1)
    order, inner, outer = np.arange(n), np.zeros(n), np.zeros(n)
    todo = [(0, n)]
    while todo:
        a, b = todo.pop()
        if b - a <= LEAF:
            continue
        away = np.linalg.norm(lifted[order[a:b]] - lifted[order[a]], axis=1)
        # The point farthest from an arbitrary one sees the others best.
        first = a + int(away.argmax())
        order[a], order[first] = order[first], order[a]
        rest = order[a + 1:b]
        away = np.linalg.norm(lifted[rest] - lifted[order[a]], axis=1)
        by = np.argsort(away, kind="stable")
        order[a + 1:b], away = rest[by], away[by]
        half = len(rest) // 2
        inner[a], outer[a] = away[half - 1], away[half]
        todo += [(a + 1, a + 1 + half), (a + 1 + half, b)]
    ids = np.frombuffer(block["ids"], np.int64)
    return block | {"ids": ids[order].tobytes(), "data": vectors[order].tobytes(), "top": float(squares.max()),
                    "inner": inner.tobytes(), "outer": outer.tobytes()}


def search(ids, vectors, top, inner, outer, q_ids, queries, k: int, factor: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(query, id, score)`` of the nearest found in one tree, at most ``k`` a query."""
    lengths = np.einsum("ij,ij->i", queries, queries)
    bound = np.full(len(queries), -np.inf)
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def scores(active: np.ndarray, a: int, b: int) -> np.ndarray:
        out = products(queries[active], vectors[a:b])
        out[q_ids[active][:, None] == ids[None, a:b]] = -np.inf
        return out

    def away(active: np.ndarray, product: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(lengths[active] + top - 2 * product, 0))

    def kth(all_: np.ndarray) -> np.ndarray:
        return np.partition(all_, -k, axis=1)[:, -k] if all_.shape[1] >= k else np.full(len(all_), -np.inf)

    def seek(active: np.ndarray, a: int, b: int) -> None:
        if not len(active):
            return
        if b - a <= max(LEAF, k):
            bound[active] = kth(scores(active, a, b))
            return
        half = (b - a - 1) // 2
        d = away(active, products(queries[active], vectors[a:a + 1])[:, 0])
        near = d <= (inner[a] + outer[a]) / 2
        seek(active[near], a + 1, a + 1 + half)
        seek(active[~near], a + 1 + half, b)

    best_so_far = np.full((len(queries), k), -np.inf)

    def offer(active: np.ndarray, a: int, b: int) -> None:
        got = scores(active, a, b)
        row, col = np.nonzero((got >= bound[active][:, None]) & (got > -np.inf))
        if len(row):
            held.append((active[row], ids[a + col], got[row, col]))
            touched = np.unique(row)
            best_so_far[active[touched]] = np.sort(np.concatenate([best_so_far[active[touched]], got[touched]], axis=1), axis=1)[:, -k:]
            bound[active[touched]] = np.maximum(bound[active[touched]], best_so_far[active[touched], 0])

    def visit(active: np.ndarray, a: int, b: int) -> None:
        if not len(active):
            return
        if b - a <= LEAF:
            offer(active, a, b)
            return
        half = (b - a - 1) // 2
        d = away(active, products(queries[active], vectors[a:a + 1])[:, 0])
        offer(active, a, a + 1)
        reach = lambda: away(active, np.maximum(bound[active], -1e300)) * (1 + 1e-9) + 1e-9
        visit(active[(d - inner[a]) * factor <= reach()], a + 1, a + 1 + half)
        visit(active[(outer[a] - d) * factor <= reach()], a + 1 + half, b)

    everyone = np.arange(len(queries))
    seek(everyone, 0, len(ids))
    visit(everyone, 0, len(ids))
    if not held:
        return np.empty(0, int), np.empty(0, np.int64), np.empty(0)
    q, v, s = (np.concatenate(x) for x in zip(*held))
    order = np.lexsort((v, -s, q))
    q, v, s = q[order], v[order], s[order]
    first = np.arange(len(q)) - np.searchsorted(q, q) < k
    return q[first], v[first], s[first]


def _search(k: int, factor: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in rows_of(batch):
                q_ids = np.frombuffer(row.q_ids, np.int64)
                q, v, s = search(
                    np.frombuffer(row.ids, np.int64), np.frombuffer(row.data, np.float32).reshape(row.n, row.dims).astype(float), row.top,
                    np.frombuffer(row.inner, float), np.frombuffer(row.outer, float),
                    q_ids, np.frombuffer(row.q_data, np.float32).reshape(row.q_n, row.q_dims).astype(float), k, factor)
                yield pd.DataFrame({"query_id": q_ids[q], "vec_id": v, "score": s})

    return run


def nearest(vectors: DataFrame, is_query, scratch: Scratch, k: int = 20, factor: float = FACTOR) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of each query, nearest first.

    ``vectors(vec_id, embedding array<float>)``; ``is_query`` says which rows are queries. Every row is
    indexed. Candidates are all rows with another vec_id and as many components. Vectors that are
    null, empty or zero, or hold null or non-finite components, take no part, nor do rows without a
    vec_id. A repeated row is a candidate as often as it comes; a repeated query id asks once, with its
    smallest vector. Ties go to the smaller vec_id.
    """
    vector = F.col("embedding").cast("array<float>")
    rows = vectors.where(F.col("vec_id").isNotNull() & usable(vector) & F.exists(vector, lambda x: x != 0)).select(F.col("vec_id").alias("id"), vector.alias("vector"))
    trees = scratch.save(pack(rows, SHARD, "float32", finish=plant, schema="top double, inner binary, outer binary"), "trees")
    asked = rows.where(is_query(F.col("id"))).groupBy("id").agg(F.min("vector").alias("vector"))
    asked = scratch.save(pack(asked, QUERY_BLOCK, "float32"), "asked")
    found = meet(trees, asked).mapInPandas(_search(k, factor), "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
