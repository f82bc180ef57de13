"""Numbering and lag against a plain sort in Python, by both ways."""

import os
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from railpulse.operators.ordered import cut_in_slices, largest_group, latest_by_key, number_and_lag

SCHEMA = "k int, t int, v double"


def brute(rows):
    out, last = [], {}
    for k, t, v in sorted(rows, key=lambda r: (r[0] is not None, r)):
        n, prev = last.get(k, (0, None))
        out.append((k, t, v, n + 1, prev))
        last[k] = (n + 1, v)
    return sorted(out, key=str)


def run(spark, rows, **sizes):
    df = spark.createDataFrame(rows, SCHEMA)
    out = number_and_lag(df, ["k"], ["t", "v"], lag={"prev": "v"}, number="n", **sizes)
    assert out.columns == ["k", "t", "v", "prev", "n"]
    return sorted([tuple(r) for r in out.select("k", "t", "v", "n", "prev").collect()], key=str)


def hot_rows():
    """One key with a third of the rows, one row copied as often, the rest spread."""
    rng = random.Random(7)
    rows = [(1, rng.randrange(50), float(rng.randrange(9))) for _ in range(400)]
    rows += [(2, 5, 1.5)] * 400
    rows += [(rng.randrange(3, 60), rng.randrange(50), float(rng.randrange(9))) for _ in range(400)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("sizes", [
    {}, {"max_group_rows": 10, "rows_per_slice": 60}, {"max_group_rows": 0, "rows_per_slice": 5000},
    {"max_group_rows": 0, "rows_per_slice": 17}])
def test_both_ways_equal_a_plain_sort(spark, sizes):
    rows = hot_rows()
    assert run(spark, rows, **sizes) == brute(rows)


def test_written_rows_are_not_written_again(spark, scratch):
    rows = scratch.save(spark.createDataFrame(hot_rows(), SCHEMA), "rows")
    out = number_and_lag(rows, ["k"], ["t", "v"], lag={"prev": "v"}, number="n", scratch=scratch, written=True,
                         max_group_rows=0, rows_per_slice=60)
    assert sorted([tuple(r) for r in out.select("k", "t", "v", "n", "prev").collect()], key=str) == brute(hot_rows())
    assert sorted(os.listdir(scratch.path.removeprefix("file:"))) == ["001-rows", "002-slices"]


def test_slices_are_joined_to_nothing(spark, scratch):
    rows = scratch.save(spark.createDataFrame(hot_rows(), SCHEMA), "rows")
    out = number_and_lag(rows, ["k"], ["t", "v"], lag={"prev": "v"}, number="n", scratch=scratch, written=True,
                         max_group_rows=0, rows_per_slice=60)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "SortAggregate" not in plan


def test_only_hot_groups_are_sliced(spark, scratch):
    """Keys 1 and 2 hold a third of the rows each; all others are shuffled once, by a plain window."""
    rows = scratch.save(spark.createDataFrame(hot_rows(), SCHEMA), "rows")
    out = number_and_lag(rows, ["k"], ["t", "v"], lag={"prev": "v"}, number="n", scratch=scratch, written=True,
                         max_group_rows=100, rows_per_slice=60)
    assert sorted([tuple(r) for r in out.select("k", "t", "v", "n", "prev").collect()], key=str) == brute(hot_rows())
    tables = sorted(os.listdir(scratch.path.removeprefix("file:")))
    assert tables == ["001-rows", "002-heavy-groups", "003-heavy-rows", "004-slices"]
    read = lambda name: spark.read.parquet(f"{scratch.path}/{name}")
    assert sorted(r[0] for r in read(tables[1]).collect()) == [1, 2]
    assert {r.k for r in read(tables[3]).select("k").distinct().collect()} == {1, 2} and read(tables[3]).count() == 800
    cold = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].split("LeftAnti")[0].rsplit("Union", 1)[-1].rsplit("Window", 1)[-1]
    assert cold.count("Exchange") - cold.count("BroadcastExchange") == 1


def test_heavy_groups_with_null_keys_and_ties(spark):
    """A null key is a group like any other, and rows equal in the order go by their other columns either way."""
    rows = [(None, 1, float(i % 7)) for i in range(60)] + [(3, 1, float(i % 5)) for i in range(40)] + [(None, 2, 0.0)]

    def both(**sizes):
        df = spark.createDataFrame(rows, SCHEMA)
        return sorted([tuple(r) for r in number_and_lag(df, ["k"], ["t"], lag={"prev": "v"}, number="n", **sizes).collect()], key=str)

    assert both() == both(max_group_rows=50, rows_per_slice=9) == both(max_group_rows=0, rows_per_slice=9)
    assert run(spark, rows, max_group_rows=50, rows_per_slice=9) == brute(rows)


def test_null_keys_form_a_group(spark):
    rows = [(None, 3, 1.0), (None, 1, 2.0), (4, 1, 3.0), (None, 2, 4.0)] * 5
    assert run(spark, rows, max_group_rows=0, rows_per_slice=3) == brute(rows)


def test_no_rows(spark):
    assert run(spark, []) == []
    assert run(spark, [], max_group_rows=0) == []


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.integers(0, 3), st.integers(0, 4),
                               st.sampled_from([0.0, 1.0, 2.5])), min_size=1, max_size=40))
def test_any_rows(spark, rows):
    assert run(spark, rows, max_group_rows=0, rows_per_slice=4) == brute(rows)


def test_hot_groups_and_copies_spread_over_slices(spark, scratch):
    rows = scratch.save(spark.createDataFrame(hot_rows(), SCHEMA), "rows")
    cut = cut_in_slices(rows, ["k"], ["t", "v"], scratch, 60)
    sizes = [r["count"] for r in cut.groupBy("_slice").count().collect()]
    assert sum(sizes) == 1200
    assert len(sizes) >= 15
    assert max(sizes) < 200


def test_largest_group(spark):
    assert largest_group(spark.createDataFrame(hot_rows(), SCHEMA), ["k"]) == 400
    assert largest_group(spark.createDataFrame([], SCHEMA), ["k"]) == 0


def test_latest_by_key_keeps_one_row_per_key_before_the_shuffle(spark):
    df = spark.createDataFrame(hot_rows(), SCHEMA)
    out = latest_by_key(df, ["k"], ["t", "v"])
    best = {}
    for k, t, v in hot_rows():
        best[k] = max(best.get(k, (t, v)), (t, v))
    assert {r.k: (r.t, r.v) for r in out.collect()} == best
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
