"""Collocations against counting all runs of words in plain Python."""

import random
import re
from collections import Counter

import pandas as pd
import pytest

from railpulse.llm import collocations as C

SCHEMA = "doc_id long, text string, lang string, word string, f long, k long, n long"


def pieces(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [re.findall(r"[^\x20\x09]+", piece) for piece in re.split(r"[.,;:!?\x0A-\x0D]", text)]


def counts(rows):
    f = Counter()
    for text, lang in rows:
        for words in pieces(text):
            for k in range(1, 6):
                f.update((lang or "und", *words[i:i + k]) for i in range(len(words) - k + 1))
    return f


def slow(rows, least, reported):
    f = counts(rows)
    n = Counter()
    for gram, c in f.items():
        if len(gram) == 2:
            n[gram[0]] += c
    candidates = {gram: c for gram, c in f.items() if len(gram) > 2 and c >= least}
    dropped = {(gram[0], *gram[i:i + m]) for gram, c in candidates.items() for m in range(2, len(gram) - 1) for i in range(1, len(gram) - m + 1)
               if c >= f[(gram[0], *gram[i:i + m])]}
    out = []
    for gram, a in candidates.items():
        if gram in dropped:
            continue
        lang, words = gram[0], gram[1:]
        cuts = [(1000 * a * n[lang] // (f[(lang, *words[:j])] * f[(lang, *words[j:])]), j) for j in range(1, len(words))]
        score, j = min(cuts)
        out.append((lang, " ".join(words), a, f[(lang, *words[:j])], f[(lang, *words[j:])], n[lang], score))
    found = []
    for lang in {row[0] for row in out}:
        own = sorted((row for row in out if row[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))[:reported]
        found += [(lang, rank, *row[1:]) for rank, row in enumerate(own, 1)]
    return sorted(found)


def frame(spark, rows):
    return spark.createDataFrame([(1, text, lang, "a", 2, 3, 4) for text, lang in rows], SCHEMA)


def fast(spark, rows, scratch, least, reported=2000, **options):
    found = C.collocations(frame(spark, rows).repartition(4), scratch, least, reported, **options)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(map(tuple, found.collect()))


def corpus(seed, n=120):
    """Texts of few words with passages that repeat, all kinds of separators, and rare words."""
    draw = random.Random(seed)
    vocabulary = ["a", "b", "B", "cé", "d", "e", "ß", " x", "\x1cy", "le"]
    passages = [[draw.choice(vocabulary) for _ in range(draw.randrange(3, 30))] for _ in range(4)]
    rows = []
    for _ in range(n):
        words = []
        for _ in range(draw.randrange(6)):
            words += draw.choice(passages) if draw.random() < .5 else [draw.choice(vocabulary) for _ in range(draw.randrange(1, 12))]
            words.append(draw.choice(["", f"rare{draw.randrange(10**6)}"]))
        text = "".join(word + draw.choice([" ", "  ", "\t", " ", " ", ". ", ",", "\n", "\r\n", ":", "\x0b"]) for word in words)
        rows.append((text, draw.choice(["en", "de", None])))
    return rows


EDGES = [(None, "en"), ("", "en"), (None, None), (" \t ", "fr"), ("...", "fr"), ("Same Words here", "und"), ("same words HERE", None)]


@pytest.mark.parametrize("seed, least", [(1, 2), (2, 5), (3, 20)])
def test_against_all_runs(spark, scratch, seed, least):
    rows = corpus(seed) + EDGES + EDGES
    assert fast(spark, rows, scratch, least) == slow(rows, least, 2000) != []


@pytest.mark.parametrize("dictionary", [0, 1, 7])
def test_words_beyond_the_dictionary(spark, scratch, dictionary):
    rows = corpus(4)
    assert fast(spark, rows, scratch, 4, dictionary=dictionary, range_words=200) == slow(rows, 4, 2000)


@pytest.mark.parametrize("seed", [None, 0])
def test_ranges_part_windows_and_keep_their_counts(spark, seed):
    rows = frame(spark, corpus(6)).coalesce(2)
    sent = pd.DataFrame({"lang": "en", "word": ["a", "b", "e", "le"], "id": [1, 2, 3, 4]})
    bounds = C.range_bounds(rows, sent, seed, 2_000, 50)
    assert len(bounds) > 20 and sorted(map(tuple, bounds)) == list(map(tuple, bounds))
    packed = C.windows(rows, sent, seed, bounds, flush=300)
    whole = C.windows(rows, sent, seed).groupBy(*C.GRAM).sum("c").collect()
    parted = C.sorted_windows(packed, len(bounds) + 1)
    assert sorted(parted.groupBy(*C.GRAM).sum("c").collect()) == sorted(whole)
    for row in packed.collect():
        grams = list(map(tuple, C._unpacked(row["packed"])[:5].T))
        place = row["range"]
        assert grams == sorted(grams)
        assert place == 0 or grams[0] >= tuple(bounds[place - 1])
        assert place == len(bounds) or grams[-1] < tuple(bounds[place])


def test_a_hash_that_two_words_share_is_not_taken(spark, scratch, monkeypatch):
    words = spark.createDataFrame([("en", w, 5) for w in ("one", "two", "three")], "lang string, word string, f long")

    def shared(seed):
        number = 9 if seed < 2 else None
        plain = C.hashed
        return C.F.pandas_udf(lambda lang, word: pd.Series([number or plain(l, w.encode(), seed) for l, w in zip(lang, word)]), "long")

    monkeypatch.setattr(C, "number_udf", shared)
    ids, seed = C.hashed_words(words, words, scratch)
    assert seed == 2 and len({row.id for row in ids.collect()}) == 3


def test_ties_and_the_number_reported(spark, scratch):
    rows = [(f"x{i} y{i} z{i}", "en") for i in range(9) for _ in range(3)]
    assert fast(spark, rows, scratch, 3, 4) == slow(rows, 3, 4)
    assert [row[2] for row in fast(spark, rows, scratch, 3, 4)] == [f"x{i} y{i} z{i}" for i in range(4)]


def test_a_very_long_piece_is_cut_without_a_trace(spark):
    draw = random.Random(5)
    rows = [(" ".join(draw.choice("abcd") for _ in range(5_000)), "en"), ("a b c", "en"), ("", "en"), ("d", "en")]
    sent = pd.DataFrame({"lang": "en", "word": list("abc"), "id": [1, 2, 3]})
    for seed in (None, 0):
        few = C.windows(frame(spark, rows).coalesce(1), sent, seed, flush=40).groupBy(*C.GRAM).sum("c").collect()
        whole = C.windows(frame(spark, rows).coalesce(1), sent, seed).groupBy(*C.GRAM).sum("c").collect()
        assert sorted(few) == sorted(whole) and sum(row[5] for row in whole) > 3_000
    data = b"ab  c\nd " * 50 + b"x" * 99
    assert b"".join(C._cut(data, 16)) == data
    assert all(part[-1:] in (b" ", b"\n") for part in list(C._cut(data, 16))[:-1])


def test_paths_are_whole_chains(spark, scratch):
    """A passage of 40 words met three times is one path of 36 edges; 35 nodes between them go by it."""
    passage = " ".join(f"p{i}" for i in range(40))
    rows = frame(spark, [(f"{head} {passage} {tail}", "en") for head, tail in (("a b", "c"), ("d", "e f"), ("g", ""))])
    words = C.words_counted(rows).where("f >= 3").toPandas()
    words["id"] = range(1, len(words) + 1)
    grams = scratch.save(C.flows(C.windows(rows, words, None).withColumn("range", C.F.lit(0)).coalesce(1).sortWithinPartitions(*C.GRAM), 3), "grams")
    found = C.paths(grams, scratch)
    assert found.count() == 36 and found.select("path").distinct().count() == 1
    assert sorted(row.place for row in found.collect()) == list(range(36))
    assert C.inside_longer(grams, found).where("k = 4").count() == 37


def test_products_beyond_64_bits(spark):
    big = 3_037_000_499_977
    rows = spark.createDataFrame([(2, [1, 2], big, "en")], "k int, gram array<long>, a long, lang string")
    f = spark.createDataFrame([([1], big + 5), ([2], big + 11)], "gram array<long>, f long")
    n = spark.createDataFrame([("en", 15 * 10 ** 12)], "lang string, n long")
    row = C.scored(rows, f, n).first()
    assert row.score == 1000 * big * 15 * 10 ** 12 // ((big + 5) * (big + 11))


def test_nothing_to_count(spark, scratch):
    assert fast(spark, [], scratch, 2) == [] and fast(spark, EDGES[:5], scratch, 2) == []
    assert fast(spark, [("one two three", "en")], scratch, 2) == []
