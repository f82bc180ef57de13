"""Mixing sources: targets, quotas and what is taken."""

import random

import pytest

from railpulse.llm import mixing, oracle
from railpulse.llm.queries import op2_mix_sources
from tests.compare import connect, duck_rows, spark_rows
from tests.conftest import SF

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, shard string"


def make(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), 1, "x") for i, t, s in rows], SCHEMA)


def reshared(sizes, weights):
    """Targets by sharing out the excess again and again."""
    goal, full, total = [0.0] * len(sizes), set(), 1.5 * sum(sizes)
    while True:
        rest = total - sum(2.0 * sizes[i] for i in full)
        open_ = [i for i in range(len(sizes)) if i not in full]
        for i in open_:
            goal[i] = rest * weights[i] / sum(weights[j] for j in open_)
        over = {i for i in open_ if goal[i] > 2 * sizes[i]}
        if not over:
            return [2.0 * sizes[i] if i in full else goal[i] for i in range(len(sizes))]
        full |= over


def test_query_against_sql(spark):
    assert spark_rows(op2_mix_sources(spark, SF)) == duck_rows(connect(SF), oracle.MIX)


def test_targets_and_what_is_taken(spark, scratch):
    rng = random.Random(2)
    names = ["b", "a", None, "", "é", "z", "tiny"]
    rows = [(i, " ".join("w" * rng.randrange(1, 60)), names[min(6, int(rng.expovariate(0.5)))]) for i in range(900)]
    rows += [(5_000, "long " * 30_000, "a"), (5_001, None, "b"), (5_002, "", None)]
    got = mixing.mix_report(make(spark, rows).repartition(4), scratch).collect()
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = dict(zip(order, reshared([sizes[s] for s in order], [(3, 1, 2)[i % 3] for i in range(len(order))])))
    source_of = {i: s for i, _, s in rows}
    taken = dict.fromkeys(order, 0)
    for r in got:
        s = source_of[r.doc_id]
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s])
        assert 0 <= r.taken <= 2 * r.size
        taken[s] += r.taken
    for s in order:
        assert taken[s] == pytest.approx(want[s], rel=0.01, abs=mixing.BLOCK)
    again = mixing.mix_report(make(spark, rows[::-1]).repartition(7), scratch).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_documents_hold_the_words_taken(spark, scratch):
    rows = [(i, f"w{i} " * (i % 40) + "\nend", "ab"[i % 2] if i % 7 else None) for i in range(300)]
    docs = make(spark, rows)
    taken = {r.doc_id: r.taken for r in mixing.mix_report(docs, scratch).collect()}
    given = mixing.mix_documents(docs, scratch)
    assert given.columns == docs.columns
    words, text_of = {}, {i: t for i, t, _ in rows}
    for r in given.collect():
        n = len(r.text.split())
        words[r.doc_id] = words.get(r.doc_id, 0) + n
        assert r.n_chars == len(r.text) and n > 0
        assert r.text == text_of[r.doc_id] if n == len(text_of[r.doc_id].split()) else n < len(text_of[r.doc_id].split())
    assert words == {i: n for i, n in taken.items() if n}


def test_repeated_rows_and_empty_tables(spark, scratch):
    docs = make(spark, [(1, "one two three", "s")] * 4 + [(None, "four five", None)] * 3)
    assert sum(r.taken for r in mixing.mix_report(docs, scratch).collect()) <= 2 * (12 + 6)
    assert mixing.mix_report(docs.limit(0), scratch).collect() == []
    assert mixing.mix_documents(docs.limit(0), scratch).collect() == []
    assert mixing.mix_documents(make(spark, [(1, None, None), (2, " ", "s")]), scratch).collect() == []


def test_apportion_gives_the_highest_quotients(spark):
    shares = [7.4, 3.49, 0.51, 0.5, 12.1, 0.0, 2.0]
    rows = spark.createDataFrame([(0, i, s, 26) for i, s in enumerate(shares)], "g int, k int, share double, seats int")
    got = {r.k: r.quota for r in mixing.apportion(rows, ["g"], "k", "share", "seats").collect()}
    quotients = sorted(((-s / (2 * n - 1), i) for i, s in enumerate(shares) for n in range(1, 40)))[:26]
    assert got == {i: sum(q[1] == i for q in quotients) for i in range(len(shares))}
