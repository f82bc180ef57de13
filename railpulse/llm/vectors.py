"""Vectors in blocks: rows packed for matrix products, and query blocks dealt to them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Blocks of vectors and blocks of queries meet in so many cells at most.
MOST_CELLS = 1_024


def usable(vector: Column) -> Column:
    """Neither null nor empty, without null or non-finite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(vector) > 0) & ~bad, F.lit(False))


def pack(rows: DataFrame, size: int, kind: str, extra: tuple[str, ...] = (), finish: Callable | None = None, schema: str = "") -> DataFrame:
    """Blocks ``(dims, n, ids, data, ...)`` of at most ``size`` rows of ``(id, vector, extra...)``.

    Each task packs what it reads, so a block holds neighbours of one partition and nothing is
    shuffled. Vectors of different lengths never share a block. ``data`` holds them row by row as
    ``kind``, each extra column is an array of longs. ``finish`` may add to a block's columns.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, list[pd.DataFrame]] = {}

        def block(dims: int) -> pd.DataFrame:
            own = pd.concat(held.pop(dims))
            out = {"dims": dims, "n": len(own), "ids": own["id"].to_numpy(np.int64).tobytes(),
                   "data": np.stack(own["vector"].to_list()).astype(kind).tobytes()}
            out |= {c: own[c].to_numpy(np.int64).tobytes() for c in extra}
            return pd.DataFrame([finish(out) if finish else out])

        for batch in batches:
            for dims, own in batch.groupby(batch["vector"].map(len)):
                for i in range(0, len(own), size):
                    part = own.iloc[i:i + size]
                    if dims in held and sum(map(len, held[dims])) + len(part) > size:
                        yield block(dims)
                    held.setdefault(dims, []).append(part)
        for dims in list(held):
            yield block(dims)

    columns = ", ".join(["dims int", "n int", "ids binary", "data binary", *(f"{c} binary" for c in extra)])
    return rows.mapInPandas(run, columns + (", " + schema if schema else ""))


def grid(blocks: int, rows: int, query_blocks: int, queries: int) -> tuple[int, int]:
    """How many bands of vectors and of queries make the cells in which they meet.

    A vector is sent to every band of queries and a query to every band of vectors. For a given number of cells that is
    least where both sides send as much: the number of vector bands over that of query bands is
    the number of vectors over that of queries. There are as many cells as the longer side has blocks, since more would
    only be sent more.
    """
    cells = min(MOST_CELLS, max(blocks, query_blocks))
    bands = max(1, min(blocks, round((cells * rows / max(1, queries)) ** 0.5)))
    return bands, max(1, min(query_blocks, cells // bands))


def meet(blocks: DataFrame, queries: DataFrame) -> DataFrame:
    """Every block with every block of queries of the same length, query columns prefixed ``q_``.

    Both are written tables of few rows, dealt to the bands of a grid; the join is on its cells. The planner knows a
    side's size before it is dealt, not how often each row then comes, so it may not choose a broadcast by it.
    """
    def size(table: DataFrame) -> tuple[int, int]:
        return tuple(table.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first())

    bands, q_bands = grid(*size(blocks), *size(queries))

    def each(number: int):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(number - 1).cast("long")))

    def band(ids: str, number: int):
        return F.pmod(F.xxhash64(ids), F.lit(number).cast("long"))

    dealt = blocks.withColumn("band", band("ids", bands)).withColumn("q_band", each(q_bands))
    asked = queries.select(*[F.col(c).alias(f"q_{c}") for c in queries.columns])
    asked = asked.withColumn("to_q_band", band("q_ids", q_bands)).withColumn("to_band", each(bands))
    cell = (F.col("band") == F.col("to_band")) & (F.col("q_band") == F.col("to_q_band")) & (F.col("dims") == F.col("q_dims"))
    return dealt.join(asked.hint("merge"), cell).drop("band", "q_band", "to_band", "to_q_band")


def rows_of(batch: pd.DataFrame) -> Iterator:
    return batch.itertuples(index=False)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of each row's ``k`` highest scores (all, if fewer), smaller ids first.

    Entries at the lowest value of their type do not count.
    """
    lowest = -np.inf if scores.dtype.kind == "f" else np.iinfo(scores.dtype).min
    cut = np.partition(scores, -k, axis=1)[:, -k] if scores.shape[1] > k else np.full(len(scores), lowest, scores.dtype)
    row, col = np.nonzero((scores >= cut[:, None]) & (scores > lowest))
    order = np.lexsort((ids[col], -scores[row, col], row))
    row, col = row[order], col[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    return row[place < k], col[place < k]
