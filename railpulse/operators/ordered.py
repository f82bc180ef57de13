"""Row numbers and previous-row values inside ordered groups of any size.

``Window.partitionBy(group)`` puts a whole group in one task. A line has few sensors and a busy
train or sensor may hold a third of all rows, so that task would not end at scale. Groups of a
checked size take the plain window, with one shuffle. The rows of larger groups are range-cut by (group, order) into
slices of bounded size, each slice is numbered by itself, and one extra row per (group, slice)
carries the running count and the last row on from slice to slice. Both ways give the same result.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from railpulse.session import Scratch

MAX_GROUP_ROWS = 10_000_000
ROWS_PER_SLICE = 10_000_000

TIE, SLICE, POS, REAL, BEFORE = "_tie", "_slice", "_pos", "_real", "_before"


def largest_group(df: DataFrame, keys: list[str]) -> int:
    """Rows in the largest group; counts are combined before the shuffle."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.max("n")).first()[0] or 0


def heavy_groups(df: DataFrame, keys: list[str], max_group_rows: int) -> DataFrame:
    """The keys of groups above the limit, at most one for every ``max_group_rows`` rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > max_group_rows).select(*keys)


def number_and_lag(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    lag: dict[str, str] | None = None,
    number: str | None = None,
    scratch: Scratch | None = None,
    written: bool = False,
    max_group_rows: int = MAX_GROUP_ROWS,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Add ``number`` (1, 2, … per group) and, for each ``new: old`` in ``lag``, the previous
    row's ``old`` as ``new`` (null on the first row of a group).

    Rows equal in all of ``order`` are told apart by their other columns, so only equal rows are taken in any
    order. One job counts the group sizes, at the time of the call, so ``df`` should be a written table where it is
    dear to compute. Only if a group is above ``max_group_rows`` are rows written to ``scratch`` (one of its own, if none is given,
    which stays in the checkpoint folder), and only the rows of such groups take the sliced way. With ``max_group_rows=0``
    nothing is counted and all rows take it. ``written`` says that ``df`` reads straight from files and
    need not be written once more.
    """
    lag = lag or {}
    if set(lag.values()) & set(keys):
        raise ValueError("a group's keys are the same on the previous row")
    order = [*order, *(c for c, kind in df.dtypes if c not in {*keys, *order} and "map<" not in kind)]
    if max_group_rows and largest_group(df, keys) <= max_group_rows:
        return _whole_groups(df, keys, order, lag, number)
    scratch = scratch or Scratch(df.sparkSession)
    rows = df if written else scratch.save(df, "rows")
    if not max_group_rows:
        return _sliced(rows, keys, order, lag, number, scratch, rows_per_slice)
    # Written, so that the planner sees how small it is; beyond a broadcast both sides are sorted and merged.
    heavy = scratch.save(heavy_groups(rows, keys, max_group_rows).select(*[F.col(k).alias(f"_heavy_{k}") for k in keys]), "heavy-groups")
    same = [F.col(k).eqNullSafe(F.col(f"_heavy_{k}")) for k in keys]
    hot = scratch.save(rows.join(heavy, same, "left_semi"), "heavy-rows")
    cold = rows.join(heavy, same, "left_anti")
    return _sliced(hot, keys, order, lag, number, scratch, rows_per_slice).unionByName(_whole_groups(cold, keys, order, lag, number))


def _whole_groups(df, keys, order, lag, number):
    w = Window.partitionBy(*keys).orderBy(*order)
    added = [F.lag(old).over(w).alias(new) for new, old in lag.items()]
    if number:
        added.append(F.row_number().over(w).cast("long").alias(number))
    return df.select("*", *added)


def _sliced(rows, keys, order, lag, number, scratch, rows_per_slice):
    cut = cut_in_slices(rows, keys, order, scratch, rows_per_slice)
    with_edges = cut.withColumn(REAL, F.lit(True)).unionByName(
        _edges(cut, keys, sorted(set(lag.values()))), allowMissingColumns=True)

    inside = Window.partitionBy(*keys, SLICE).orderBy(POS, REAL)
    added = [F.lag(old).over(inside).alias(new) for new, old in lag.items()]
    if number:
        before = F.first(BEFORE).over(inside.rowsBetween(Window.unboundedPreceding, 0))
        added.append((before + F.row_number().over(inside) - 1).alias(number))
    return with_edges.select("*", *added).filter(REAL).drop(SLICE, POS, REAL, BEFORE)


def cut_in_slices(rows, keys, order, scratch, rows_per_slice) -> DataFrame:
    """The rows in range slices over (keys, order), with slice and position written down.

    The tie column lets even copies of one row spread over slices. It numbers rows of written
    files, so a repeated task numbers them the same way again.
    """
    slices = max(2, math.ceil(rows.count() / rows_per_slice))
    cut = (
        rows.withColumn(TIE, F.monotonically_increasing_id())
        .repartitionByRange(slices, *keys, *order, TIE)
        .sortWithinPartitions(*keys, *order, TIE)
        .withColumn(SLICE, F.spark_partition_id())
        .withColumn(POS, F.monotonically_increasing_id())
        .drop(TIE)
    )
    return scratch.save(cut, "slices")


def _edges(cut, keys, carried) -> DataFrame:
    """One row ahead of each (group, slice): the count of the group's rows before the slice, and
    the carried values of the last of them.

    It is placed at the slice's first position, ahead of the real row there, so that the slice's
    window finds it as the row before its first. A group has one such row per slice it spans.
    """
    heads = cut.groupBy(*keys, SLICE).agg(
        F.count(F.lit(1)).alias("_n"), F.min(POS).alias(POS),
        *[F.max_by(c, POS).alias(c) for c in carried])
    along = Window.partitionBy(*keys).orderBy(SLICE)
    before = F.sum("_n").over(along.rowsBetween(Window.unboundedPreceding, -1))
    return heads.select(
        *keys, SLICE, POS, F.lit(False).alias(REAL), F.coalesce(before, F.lit(0)).alias(BEFORE),
        *[F.lag(c).over(along).alias(c) for c in carried])


def latest_by_key(df: DataFrame, keys: list[str], sequence: list) -> DataFrame:
    """The row with the highest sequence per key.

    Spark keeps one row per key in each map task before the shuffle, so a hot key costs no more
    than any other.
    """
    w = Window.partitionBy(*keys).orderBy(*[F.desc(s) if isinstance(s, str) else s for s in sequence])
    return df.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")
