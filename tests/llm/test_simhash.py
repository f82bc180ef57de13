"""SimHash near duplicates against brute force over all pairs."""

import re

import numpy as np
import pytest
import xxhash

from railpulse.llm import simhash as S
from railpulse.llm.common import table
from railpulse.llm.queries import op3_simhash_near_dedup
from tests.conftest import SF

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def slow_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_groups(prints):
    """Smallest id reachable, for a list of (id, fingerprint)."""
    distinct = sorted({p for _, p in prints})
    words = np.array(distinct, np.uint64)
    root = list(range(len(distinct)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(words)):
        for j in np.flatnonzero(np.bitwise_count(words ^ words[i]) <= 3):
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    of = {p: find(i) for i, p in enumerate(distinct)}
    least = {}
    for d, p in prints:
        if d is not None:
            least[of[p]] = min(least.get(of[p], d), d)
    return {(d, p): least.get(of[p]) for d, p in prints}


def test_documents_against_brute_force(spark):
    rows = table(spark, SF, "documents").select("doc_id", "text").collect()
    prints = [(r.doc_id, slow_print(r.text)) for r in rows]
    want = sorted((d, f"{p:016x}", c) for (d, p), c in slow_groups(prints).items())
    got = sorted(tuple(r) for r in op3_simhash_near_dedup(spark, SF).collect())
    assert got == want
    assert len({c for _, _, c in got}) < len(got)


@pytest.mark.parametrize("chunk", [7, 64, 10_000])
def test_dense_groups_in_small_chunks(spark, scratch, chunk):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 12, dtype=np.uint64)
    words = set(base.tolist())
    for b in base[:4].tolist():
        word = b
        for _ in range(150):
            word ^= 1 << int(rng.integers(0, 64))
            words.add(word if rng.random() < 0.5 else word ^ (1 << int(rng.integers(0, 64))))
    words |= {int(w) for w in rng.integers(0, 2**16, 200, dtype=np.uint64)}
    words = sorted(words)
    nodes = spark.createDataFrame([(w - 2**64 if w >= 2**63 else w,) for w in words], "fp long").repartition(5)
    links = S.fingerprint_links(nodes, scratch, chunk=chunk)
    prints = [(i, w) for i, w in enumerate(words)]
    of = {w: i for i, w in prints}
    root = list(range(len(words)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    seen = 0
    for u, v in links.collect():
        u, v = u % 2**64, v % 2**64
        a, b = find(of[u]), find(of[v])
        root[max(a, b)] = min(a, b)
        seen += 1
    want = slow_groups(prints)
    assert [find(i) for i, _ in prints] == [want[p] for p in prints]
    assert seen < 8 * len(words)


def test_index_finds_all_and_only_near_members():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 2**20, 3000, dtype=np.uint64)
    words = words[np.argsort(S.gray_rank(words))]
    q, m = S.GrayIndex(words).near(words[:200], 3)
    got = set(zip(q.tolist(), m.tolist()))
    want = {(i, j) for i in range(200) for j in np.flatnonzero(np.bitwise_count(words ^ words[i]) <= 3).tolist()}
    assert got == want


def test_gray_rank_inverts_the_gray_code():
    ranks = np.arange(5000, dtype=np.uint64)
    assert (S.gray_rank(ranks ^ (ranks >> np.uint64(1))) == ranks).all()


def test_edges(spark, scratch):
    long = "word " * 60_000
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "One"), (6, "one two"), (7, long), (None, long),
            (7, long), (8, "a b c"), (None, None), (9, "ÄB cd ef gh"), (9, "Äb CD ef gh")]
    docs = spark.createDataFrame([(d, t, None, None, 1, 2, "x") for d, t in rows], SCHEMA + ", fp int, root string")
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in S.near_duplicates(docs, scratch).collect()), key=str)
    prints = [(d, slow_print(t)) for d, t in rows]
    want = slow_groups(prints)
    assert got == sorted(((d, f"{p:016x}", want[d, p]) for d, p in prints), key=str)
    kept = S.keep_one(docs, scratch)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for c in want.values()})
    empty = docs.limit(0)
    assert S.near_duplicates(empty, scratch).collect() == [] and S.keep_one(empty, scratch).collect() == []
