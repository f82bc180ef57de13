"""Toxicity: the models by hand, held-out accuracy, and edge cases."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from railpulse.llm import toxicity
from railpulse.llm.common import table
from railpulse.llm.queries import op1_toxicity
from tests.conftest import SF


def made_up(n=600):
    docs = []
    for i in range(n):
        words = [f"w{(i * 7 + j * j) % 97}" for j in range(60)]
        if i % 6 == 0:
            words[5::20] = ["vile", "rotten", "vile"]
        docs.append((i, " ".join(words), int(i % 6 == 0)))
    return docs


def test_held_out_rows(spark, scratch):
    rows = made_up()
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.score_documents(docs, labels, scratch).collect()}
    assert all(got[i].predicted == y and got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, _, y in rows)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_labels_of_held_out_rows_are_not_used(spark, scratch):
    rows = made_up()
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")

    def scores(turned):
        labels = [(i, 1 - y if turned and zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, _, y in rows]
        return sorted(map(tuple, toxicity.score_documents(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), scratch).collect()))

    assert scores(False) == scores(True)


def test_test_tables(spark):
    got = op1_toxicity(spark, SF)
    assert got.count() == table(spark, SF, "documents").count()
    rows = got.join(table(spark, SF, "labels").select("doc_id", "toxic"), "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.toxic for r in rows) / len(rows) > 0.95


def slow_ratio(contexts, entries):
    """A function from word to log ratio, from a set of (toxic, before, word)."""
    k = [Counter(w for c, _, w in contexts if c == y) for y in (0, 1)]
    n = [sum(own.values()) for own in k]
    size, known = min(n), set(k[0]) | set(k[1])
    own = [{w: count * size / n[c] for w, count in k[c].items()} for c in (0, 1)]
    spread = [sum(min(x, 0.75) for x in own[c].values()) + len(known) for c in (0, 1)]
    types = len(k[0]) + len(k[1]) + 1

    def p(c, words):
        above = sum(max(own[c].get(w, 0) - 0.75, 0) for w in words)
        classes = sum((w in k[0]) + (w in k[1]) for w in words)
        m = max(1, len(words))
        return above / m + spread[c] * (classes / m if words else 1) / types

    step = {w: math.floor(math.log(own[0].get(w, 0) + own[1].get(w, 0)) / math.log(2) * 64) for w in known}
    # The words of the highest steps, as many whole steps as fit.
    single, rest = {w for w in known if sum(s >= step[w] for s in step.values()) <= entries}, defaultdict(list)
    for w in known - single:
        rest[zlib.crc32(w.encode()) % 65536].append(w)

    def ratio(w):
        words = [w] if w in single else rest[zlib.crc32(w.encode()) % 65536]
        return math.log(p(1, words) / p(0, words))

    return ratio


def slow_scores(rows, labels, entries=10**9):
    """Tokens, contexts, ratios, means and scores of (id, text) by the folds of the ids; only the curve's fit is shared."""
    words = [(i, re.findall(r"[^\W_]+", (t or "").lower())) for i, t in rows]
    mark = {i: zlib.crc32(str(i).encode()) % 5 for i, _ in rows}
    contexts = {(labels[i], zlib.crc32(v.encode()), w) for i, text in words if mark[i] > 1 and i in labels for v, w in zip([""] + text, text)}
    ratio = slow_ratio(contexts, entries)

    def pair(text):
        said = [ratio(w) for w in text]
        mild = [max(-1, min(1, r)) for r in said]
        return (sum(mild) / len(text), (sum(said) - sum(mild)) / len(text)) if text else (0.0, 0.0)

    pairs = [pair(text) for _, text in words]
    fit = [(x, labels[i]) for (i, _), x in zip(words, pairs) if mark[i] == 1 and i in labels]
    a, b, offset = toxicity.logistic(np.array([x for x, _ in fit]), np.array([y for _, y in fit], float), np.ones(len(fit)))
    return sorted((i, 1 / (1 + math.exp(-max(-700, min(700, a * x + b * y + offset))))) for (i, _), (x, y) in zip(words, pairs))


@pytest.mark.parametrize("entries", [None, 20])
def test_scores_by_brute_force(spark, scratch, monkeypatch, entries):
    """With 20 entries most words count through their buckets."""
    rows = [(i, t) for i, t, _ in made_up()] + [(7000, None), (7001, ""), (7002, "Vile VILE never-met w1_w2 ß")]
    labels = {i: y for i, _, y in made_up() if i % 11}
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    if entries:
        monkeypatch.setattr(toxicity, "MAX_ENTRIES", entries)
    got = toxicity.score_documents(docs, spark.createDataFrame(list(labels.items()), "doc_id long, toxic int"), scratch)
    got, slow = sorted((r.doc_id, r.score) for r in got.collect()), slow_scores(rows, labels, entries or 10**9)
    assert [i for i, _ in got] == [i for i, _ in slow]
    assert [s for _, s in got] == pytest.approx([s for _, s in slow], abs=1e-7)


def rare_words(n=600):
    """Every text of ``made_up`` with five of 4,000 rare words, of which toxic texts have some to themselves."""
    rows = [(i, text + "".join(f" r{(i * 13 + j * j * 7 + (i % 6 == 0) * 1000) % 4000}" for j in range(5)), y) for i, text, y in made_up(n)]
    return rows + [(7000, None, 0), (7001, "", 0), (7002, "r1 r2 never-met", 0), (7003, "r1001 r1002 r1001", 0)]


@pytest.mark.parametrize("marks", [1 << 26, 1 << 15])
def test_words_that_are_not_sent_keep_their_own_ratios(spark, scratch, monkeypatch, marks):
    """Twenty words are sent, thousands joined; many have one hash modulo 65,536 with another one."""
    rows = rare_words()
    labels = {i: y for i, _, y in rows if i % 11 and i < 7000}
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(7003, rows[-1][1])], "doc_id long, text string").repartition(5)
    monkeypatch.setattr(toxicity, "MAX_ENTRIES", 20)
    monkeypatch.setattr(toxicity, "MARKS", marks)
    marked = spark.createDataFrame(list(labels.items()), "doc_id long, toxic int")
    ratios = toxicity.train(docs, marked, scratch).ratios
    assert len(ratios) <= 20 and ratios.rest.rows.count() > 100
    got = toxicity.score_documents(docs, marked, scratch)
    got, slow = sorted((r.doc_id, r.score) for r in got.collect()), slow_scores([(i, t) for i, t, _ in rows] + [(7003, rows[-1][1])], labels)
    assert [i for i, _ in got] == [i for i, _ in slow]
    assert [s for _, s in got] == pytest.approx([s for _, s in slow], abs=1e-7)
    assert got[-1][1] == got[-2][1]


def test_rows_kept_are_those_scored_below_a_half(spark, scratch, monkeypatch):
    """Few words are sent, so some rows are only settled by joined ratios."""
    rows = rare_words()
    docs = spark.createDataFrame([(i, t, "s") for i, t, _ in rows], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    monkeypatch.setattr(toxicity, "MAX_ENTRIES", 5)
    want = sorted(r.doc_id for r in toxicity.score_documents(docs, labels, scratch).where("predicted = 0").collect())
    kept = toxicity.without_toxic(docs, labels, scratch)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == want and 0 < len(want) < len(rows)
    verdict = toxicity.verdict_udf(spark, toxicity.train(docs, labels, scratch))
    assert {r[0] for r in docs.select(verdict("text")).distinct().collect()} >= {0, None}


def test_the_curve_is_at_its_best():
    """The slope of the damped likelihood is zero there in every direction."""
    draw = np.random.default_rng(2)
    x, weight = draw.normal(size=(300, 2)) * [1, 30], draw.uniform(1, 3, 300)
    y = (x[:, 0] + x[:, 1] / 30 + draw.normal(size=300) > 0.5).astype(float)
    a, b, offset = toxicity.logistic(x, y, weight)
    left = weight * (y - 1 / (1 + np.exp(-(a * x[:, 0] + b * x[:, 1] + offset))))
    scaled = np.array([a, b]) * x.std(0)
    assert np.append(left @ (x / x.std(0)) - 1e-2 * scaled, left.sum()) == pytest.approx([0, 0, 0], abs=1e-6)


def test_word_ratios_by_hand(spark, scratch):
    toxic = [(1, i, "vile") for i in range(40)] + [(1, i, "the") for i in range(60)]
    ordinary = [(0, i, "the") for i in range(180)] + [(0, i, "sky") for i in range(20)]
    contexts = spark.createDataFrame((toxic + ordinary) * 2, "toxic int, before long, word string")
    got = toxicity.word_ratios(contexts, scratch)
    spread = 1.5 + 3
    assert set(got) == {"vile", "the", "sky"}
    assert got["vile"] == pytest.approx(math.log((40 - 0.75 + spread / 5) / (spread / 5)))
    assert got["the"] == pytest.approx(math.log((60 - 0.75 + spread * 2 / 5) / (90 - 0.75 + spread * 2 / 5)))
    assert got["sky"] == pytest.approx(math.log((spread / 5) / (10 - 0.75 + spread / 5)))
    assert got["never met"] == 0


def test_no_word_is_silent(spark, scratch):
    """Every word met moves the mean of a text, however little it tells."""
    contexts = spark.createDataFrame([(i % 3 == 0, j, f"w{i}") for i in range(50) for j in range(1 + i % 7)], "t boolean, before long, word string")
    got = toxicity.word_ratios(contexts.select(toxicity.F.col("t").cast("int").alias("toxic"), "before", "word"), scratch)
    assert len(got) == 50 and all(got.values())


def test_every_labelled_row_is_counted(spark, scratch, monkeypatch):
    """The bound of the curve's sample leaves the counts alone."""
    rows = made_up()
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    whole = toxicity.train(docs, labels, scratch).ratios
    monkeypatch.setattr(toxicity, "SAMPLE_PER_CLASS", 10)
    assert toxicity.train(docs, labels, scratch).ratios == whole != {}


def test_no_toxic_label_in_the_curve_fold(spark, scratch):
    """Folds take turns where fold 1, or the others, lack a class; a single toxic label is still learned from."""
    rows = made_up(400)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    crc = {i: zlib.crc32(str(i).encode()) % 5 for i, _, _ in rows}
    first = next(i for i, _, y in rows if y and crc[i] == 3)

    def scores(some):
        labels = spark.createDataFrame([(i, y) for i, _, y in rows if some(i, y)], "doc_id long, toxic int")
        return {r.doc_id: r.score for r in toxicity.score_documents(docs, labels, scratch).collect()}

    for some in (lambda i, y: not (y and crc[i] == 1), lambda i, y: not y or crc[i] == 1):
        got = scores(some)
        assert min(got[i] for i, _, y in rows if y) >= 0.5 > max(got[i] for i, _, y in rows if not y)
    got = scores(lambda i, y: not y or i == first)
    assert got[first] == max(got.values()) >= 0.5 > max(got[i] for i, _, y in rows if not y)
    none = spark.createDataFrame([(i, y) for i, _, y in rows if not y], "doc_id long, toxic int")
    assert {r.score for r in toxicity.score_documents(docs, none, scratch).collect()} == {0.0}


def test_rows_kept_keep_their_columns(spark, scratch):
    rows = made_up()
    docs = spark.createDataFrame([(i, t, "s") for i, t, _ in rows] + [(7, rows[0][1], None)] * 2 + [(8, None, "x"), (9, "", "y"), (None, "vile", "z")],
                                 "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    kept = toxicity.without_toxic(docs, labels, scratch)
    assert kept.columns == docs.columns
    assert kept.count() == toxicity.score_documents(docs, labels, scratch).where("score < 0.5").count() < docs.count()


def test_edges(spark, scratch):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "a b"), (2, "vile " * 60_000), (2, "")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    rows = toxicity.score_documents(docs, none, scratch).collect()
    assert len(rows) == 5 and {r.predicted for r in rows} == {0}
    odd = spark.createDataFrame([(None, 1), (1, None), (2, 1), (2, 0)], "doc_id long, toxic int")
    assert toxicity.without_toxic(docs, odd, scratch).count() == 5
    assert toxicity.score_documents(docs.limit(0), none, scratch).collect() == []
