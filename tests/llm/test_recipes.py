"""Exact duplicates against grouping whole texts."""

import hashlib
import random
from collections import defaultdict

import pytest

from railpulse.llm import recipes as R

SCHEMA = "doc_id long, text string, lang string, recipe string, meant string, row long"


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def slow(rows):
    """Rows of the contract, those that repeat an id and a text in any order."""
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[lowered(text)].append(doc_id)
    out = []
    for text, ids in groups.items():
        order = sorted(ids, key=lambda i: (i is not None, i), reverse=True)
        digest = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, order[0], len(ids), place == 0, digest) for place, i in enumerate(order)]
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame([(i, text, None, "x", "y", 7) for i, text in rows], SCHEMA)


def fast(spark, rows, scratch, **options):
    found = R.duplicates(frame(spark, rows), scratch, **options)
    assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    return sorted(map(tuple, found.collect()), key=str)


def words(seed, n):
    draw = random.Random(seed)
    return " ".join(f"{draw.choice('abcdeé')}{draw.randrange(10**6)}" for _ in range(n))


def test_chunks_join_to_the_text_and_keep_their_bounds():
    for n in (0, 1, R.LEAST, R.LEAST + 1, 5_000, 3 * R.BLOCK + 17):
        data = random.Random(n).randbytes(n)
        parts = R.chunks(data)
        assert b"".join(parts) == data
        assert all(R.LEAST <= len(part) <= R.MOST for part in parts[:-1])
    assert {len(part) for part in R.chunks(b"a" * 100_000)[:-1]} == {R.MOST}


def test_blocks_do_not_show_in_the_marks(monkeypatch):
    data = random.Random(1).randbytes(70_000)
    whole = R._marks(data)
    monkeypatch.setattr(R, "BLOCK", 999)
    assert R._marks(data) == whole and len(whole) > 10


def test_a_shared_passage_is_cut_alike_wherever_it_stands():
    passage = words(1, 8_000).encode()
    one, two = (set(R.chunks(head.encode() + passage)) for head in (words(2, 30), words(3, 700)))
    assert len(one & two) > len(one) // 2


ROWS = [(1, "Same Text"), (5, "same text"), (9, "SAME TEXT"), (2, "same  text"), (3, None), (4, ""), (None, "SaMe text"), (None, "alone"),
        (9, "same text"), (6, "É"), (7, "é"), (8, words(5, 20_000)), (10, words(5, 20_000).upper()), (11, words(5, 20_000) + "!"), (12, "x" * 300_000),
        (13, "X" * 300_000), (14, "x" * 300_001), (15, words(6, 400) + words(7, 400)), (16, words(7, 400) + words(6, 400))]


def test_groups_are_those_of_whole_texts(spark, scratch):
    assert fast(spark, ROWS, scratch) == slow(ROWS)


@pytest.mark.parametrize("bits", [0, 1, 3])
def test_chunks_of_one_fingerprint_are_told_apart(spark, scratch, bits):
    """Fingerprints of few bits, so that different chunks, texts and orders share them."""
    def weak(chunk):
        return bytes([R.fingerprint(chunk)[0] & (1 << bits) - 1])

    texts = [words(i % 7, 600) + words(i % 5, 600) for i in range(40)] + [words(i % 3, 300) for i in range(20)]
    rows = ROWS + [(100 + i, text) for i, text in enumerate(texts)]
    assert fast(spark, rows, scratch, mark=weak) == slow(rows)


def test_a_hot_group_and_an_empty_table(spark, scratch):
    rows = [(i, "Hot text" if i % 3 else f"text {i}") for i in range(3_000)]
    assert fast(spark, rows, scratch) == slow(rows)
    assert fast(spark, [], scratch) == []


def test_a_chunk_moves_once_for_all_its_copies(spark):
    """What is compared byte by byte leaves a task once, however many texts hold it."""
    docs = frame(spark, [(i, words(1, 3_000)) for i in range(500)]).coalesce(1)
    moved = R.bodies(docs).distinct()
    assert moved.count() == len(R.chunks(words(1, 3_000).encode()))
