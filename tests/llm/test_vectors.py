"""Exact top-k and the vantage-point trees, against brute force."""

import numpy as np
import pytest

from railpulse.llm import topk, vptree
from railpulse.llm.common import table
from railpulse.llm.queries import op6_vp_tree
from railpulse.llm.vectors import MOST_CELLS, grid, meet
from tests.conftest import SF

SCHEMA = "vec_id long, embedding array<float>, label int, slot long"


def vectors(n=500, dims=12, seed=1):
    rng = np.random.default_rng(seed)
    rows = [(i, rng.normal(size=dims).astype(np.float32).tolist(), 0, 9) for i in range(n)]
    same = rows[3][1]
    rows += [(n + i, same, 0, 9) for i in range(60)]
    odd = [(n + 100, None, 0, 9), (n + 101, [], 0, 9), (n + 102, [None] * dims, 0, 9), (n + 103, [float("nan")] * dims, 0, 9),
           (n + 104, [float("inf")] + same[1:], 0, 9), (None, same, 0, 9), (7, rows[7][1], 0, 9), (n + 105, [1.0, 2.0], 0, 9), (n + 110, [0.5, -2.0], 0, 9)]
    return rows + odd, [*rows, (7, rows[7][1], 0, 9)], [(n + 105, [1.0, 2.0]), (n + 110, [0.5, -2.0])]


def slow(rows, query_ids, k, score):
    out = []
    by = {i: v for i, v, *_ in rows}
    for q in sorted(query_ids):
        found = sorted((-score(by[q], v), i) for i, v, *_ in rows if i != q and len(v) == len(by[q]))[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found)]
    return out


def test_top_k_against_brute_force(spark, scratch, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 64)
    rows, good, short = vectors()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = topk.top_k(df, lambda i: i % 5 == 0, scratch, k=10)

    def score(a, b):
        whole = [[int(np.floor(1024 * float(np.float32(x)))) for x in v] for v in (a, b)]
        return sum(x * y for x, y in zip(*whole))

    every = good + [(*x, 0, 9) for x in short]
    assert sorted(map(tuple, got.collect())) == slow(every, {r[0] for r in every if r[0] % 5 == 0}, 10, score)


@pytest.mark.parametrize("factor", [1.0, vptree.FACTOR])
def test_trees_against_brute_force(spark, scratch, monkeypatch, factor):
    monkeypatch.setattr(vptree, "SHARD", 200)
    monkeypatch.setattr(vptree, "LEAF", 16)
    rows, good, short = vectors()
    df = spark.createDataFrame(rows + [(1000, [0.0] * 12, 0, 9)], SCHEMA).repartition(3)
    got = sorted(map(tuple, vptree.nearest(df, lambda i: i % 5 == 0, scratch, k=20, factor=factor).collect()))
    every = good + [(*x, 0, 9) for x in short]
    want = slow(every, {r[0] for r in every if r[0] % 5 == 0}, 20, lambda a, b: float(products(a, b)))
    if factor == 1:
        assert [r[:3] for r in got] == [r[:3] for r in want]
        assert [r[3] for r in got] == pytest.approx([r[3] for r in want])
    else:
        assert len({(q, v) for q, _, v, _ in got} & {(q, v) for q, _, v, _ in want}) >= 0.9 * len(want)


def products(a, b):
    return vptree.products(np.array([a], float), np.array([b], float))[0, 0]


def test_recall_on_the_test_table(spark):
    rows = table(spark, SF, "embeddings").collect()
    want = slow([(r.vec_id, r.embedding) for r in rows], {r.vec_id for r in rows if r.vec_id % 20 == 0}, 20, lambda a, b: float(np.dot(np.array(a, float), np.array(b, float))))
    got = {(r.query_id, r.vec_id) for r in op6_vp_tree(spark, SF).collect()}
    assert len(got & {(q, v) for q, _, v, _ in want}) >= 0.9 * len(want)


def test_few_rows_and_none(spark, scratch):
    df = spark.createDataFrame([(0, [1.0, 2.0], 0, 9), (100, [3.0, 1.0], 0, 9), (1, [2.0**62, 1.0], 0, 9)], SCHEMA)
    assert topk.top_k(df, lambda i: i % 100 == 0, scratch).count() == 4
    assert vptree.nearest(df, lambda i: i % 100 == 0, scratch).count() == 4
    assert topk.top_k(df.limit(0), lambda i: i % 100 == 0, scratch).collect() == []
    assert vptree.nearest(df.limit(0), lambda i: i % 100 == 0, scratch).collect() == []


def test_most_pairs_are_never_summed():
    rng = np.random.default_rng(2)
    slices, k, depth = topk.SLICES, 10, topk.DEPTH * 10
    vectors_, asked = rng.integers(-1024, 1024, (8_000, 64)), rng.integers(-1024, 1024, (20, 64))
    parts = [a @ v.T for a, v in zip(np.split(asked, slices, axis=1), np.split(vectors_, slices, axis=1))]
    self_ = np.zeros(parts[0].shape, bool)
    self_[0, 5] = True
    whole = np.where(self_, topk.LOWEST, sum(parts))
    cols = topk.heads(parts, self_, depth)
    assert cols.shape == (20, slices * depth)
    # As phase one: the heads alone, each once.
    cut = np.array([sorted(set(zip(whole[q, own], own)))[-k][0] for q, own in enumerate(cols)])
    best = np.sort(whole, axis=1)[:, -k]
    assert (cut <= best).all()
    q, v = topk.sufficient(parts, self_, cut)
    assert len(q) < 0.1 * whole.size and (0, 5) not in set(zip(q, v))
    assert (topk.resolved(parts, q, v) == whole[q, v]).all()
    for query in range(20):
        kept = np.sort(whole[query, v[q == query]])[-k:]
        assert (kept == np.sort(whole[query])[-k:]).all()


@pytest.mark.parametrize("blocks, rows, query_blocks, queries", [(1, 5, 1, 1), (12_000, 10**8, 1_000, 10**6), (12_000, 10**8, 5_000, 5 * 10**6), (3, 20_000, 400, 400_000), (7, 51_000, 6, 2_565), (0, 0, 0, 0)])
def test_neither_side_is_sent_to_every_cell(blocks, rows, query_blocks, queries):
    bands, q_bands = grid(blocks, rows, query_blocks, queries)
    assert 1 <= bands <= max(1, blocks) and 1 <= q_bands <= max(1, query_blocks) and bands * q_bands <= MOST_CELLS
    if blocks > MOST_CELLS:
        sent = rows * q_bands + queries * bands
        assert bands * q_bands > MOST_CELLS / 2 and sent < 0.6 * (rows + queries * MOST_CELLS)
    elif blocks >= query_blocks:
        assert q_bands == 1


def test_every_block_meets_every_query_block_once(spark, scratch):
    kind = "dims int, n int, ids binary"
    mine = scratch.save(spark.createDataFrame([(d, 3, bytes([i, d])) for i in range(9) for d in (2, 3)], kind), "mine")
    asked = scratch.save(spark.createDataFrame([(d, 2, bytes([i, d])) for i in range(5) for d in (3, 4)], kind), "asked")
    met = sorted((bytes(r.ids), bytes(r.q_ids)) for r in meet(mine, asked).collect())
    assert met == sorted((bytes([i, 3]), bytes([j, 3])) for i in range(9) for j in range(5))


def test_what_is_dealt_to_many_bands_is_never_broadcast(spark, scratch):
    kind = "dims int, n int, ids binary"
    mine = scratch.save(spark.createDataFrame([(2, 8_000, bytes([i])) for i in range(60)], kind), "mine")
    asked = scratch.save(spark.createDataFrame([(2, 500, bytes([i])) for i in range(50)], kind), "asked")
    met = meet(mine, asked)
    assert len(met.collect()) == 60 * 50
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
