"""Toxicity by two Kneser-Ney models, one of toxic and one of ordinary texts.

A model's history is the class alone. Each class counts a word by the number of different words
it was met after, so copies of a text count once. A word keeps that count less a discount. The
discounted share of a class, and ``STRENGTH`` counts for every word known, go to a distribution that both share,
in which a word counts once for each class that has met it; a rare word so comes out much alike in both.
Every word has a ratio of its own. Those of the words most met, ``MAX_ENTRIES`` at most, are sent to every task; the others
come to the words of texts by a join. Words whose counts a discount uses up, and words never met, all have one ratio, that of the
discounted shares, so only words that tell more are joined.

All labelled rows outside folds 0 and 1 are counted. The logarithm of a text's likelihood by each model is
divided by the number of its words, and their difference is the mean of what its words say, each word
for the class that it is likelier in. A whole language may be a little likelier in one class, and so all words
of a text lean a little to one side; what words say up to ``MILD`` and what they say beyond are therefore two
means, weighed by a logistic curve that is fitted to labelled rows which the counts have not seen.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType

from railpulse.llm.common import most_met
from railpulse.session import Scratch

# Labelled rows of each class that the curve is fitted to, at most; the sample is taken by hash.
SAMPLE_PER_CLASS = 20_000
# Words whose log ratio is sent to every task; all others are joined.
MAX_ENTRIES = 200_000
# Bits that tell tasks which words may have a ratio in the join; a word that has none and finds its bit set is only joined in vain.
MARKS = 1 << 26
MARKS_A_ROW = 1 << 15
DISCOUNT, STRENGTH = 0.75, 1.0
# What a word says up to this log ratio counts to one mean, the rest to the other.
MILD = 1.0
FOLDS = 5
# Words that a task holds before it sends their contexts on, and rows that it sends at a time.
FLUSH = 1_000_000
ROWS = 50_000

TOKEN = re.compile(r"[^\W_]+")
START = ""


def tokens(text: str | None) -> list[str]:
    return TOKEN.findall(text.lower()) if text else []


@F.arrow_udf(BinaryType())
def packed(texts: pa.Array) -> pa.Array:
    """Texts made small for a shuffle; null for null."""
    pack = zstandard.ZstdCompressor(level=3).compress
    return pa.array((pack(text.as_py().encode()) if text.is_valid else None for text in texts), pa.binary())


def unpacked(data: bytes | None) -> str:
    return zstandard.decompress(data).decode() if data else ""


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; a missing id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS


@dataclass
class Rest:
    """The words that have a log ratio but are not sent: ``word, said`` as a written table, and the least and the highest ``said``."""

    rows: DataFrame | None
    least: float
    highest: float


class Ratios(dict):
    """Log ratios, toxic over ordinary, of the words that are sent.

    ``other`` is the ratio of all further words but those in ``rest``, whose hashes are set in ``marks``. Tasks get no table.
    """

    def __init__(self, words: dict[str, float], other: float, rest: Rest | None = None, marks: bytes = b""):
        super().__init__(words)
        self.other, self.rest, self.marks, self._sent = other, rest, marks, None

    def __missing__(self, word: str) -> float:
        return self.other

    def __reduce__(self):
        return Ratios, (dict(self), self.other, self.rest and Rest(None, self.rest.least, self.rest.highest), self.marks)

    def sent(self, spark: SparkSession) -> Broadcast:
        """These ratios as one broadcast for all that ask for it, since workers keep each that they have met."""
        if self._sent is None:
            self._sent = spark.sparkContext.broadcast(self)
        return self._sent

    def marked(self, word: str) -> bool:
        mark = zlib.crc32(word.encode()) % (8 * len(self.marks))
        return bool(self.marks[mark >> 3] >> (mark & 7) & 1)


@dataclass
class Model:
    """Log ratios of words, and the curve over the two means of a text; without ratios it marks nothing."""

    ratios: Ratios | None = None
    curve: tuple[float, float, float] = (0.0, 0.0, -700.0)


def _contexts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each ``(toxic, before, word)`` once in ``FLUSH`` words, those of a word together, as they then pack well.

    ``before`` is only told apart from others of the same word, so 32 bits of it will do.
    """
    place, runs, held = {START: 0}, [], 0

    def out() -> Iterator[pd.DataFrame]:
        names = np.array(list(place), object)
        hashes = np.array([zlib.crc32(name.encode()) for name in place], np.int64)
        met = np.unique(np.concatenate(runs))
        for at in range(0, len(met), ROWS):
            run = met[at:at + ROWS]
            yield pd.DataFrame({"toxic": run & 1, "before": hashes[(run >> 1) & 0x7FFFFFFF], "word": names[run >> 32]})

    for batch in batches:
        for toxic, packed in zip(batch["toxic"], batch["packed"]):
            words = tokens(unpacked(packed))
            numbers = np.fromiter((place.setdefault(word, len(place)) for word in words), np.int64, len(words))
            runs.append(numbers << 32 | np.append(0, numbers)[:-1] << 1 | toxic)
            held += len(words)
            if held >= FLUSH:
                yield from out()
                place, runs, held = {START: 0}, [], 0
    if held:
        yield from out()


def labelled(labels: DataFrame, scratch: Scratch) -> tuple[DataFrame, dict[tuple[int, int], int]]:
    """``doc_id, toxic, fold`` of labelled rows outside fold 0, and how many there are of each fold and class.

    Repeated labels count as toxic if any does.
    """
    marks = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    marks = scratch.save(marks.select("doc_id", (F.col("toxic") > 0).cast("int").alias("toxic"), fold(F.col("doc_id")).cast("int").alias("fold"))
                         .where("fold <> 0"), "labels")
    return marks, {(r.fold, r.toxic): r["count"] for r in marks.groupBy("fold", "toxic").count().collect()}


def curve_sample(marks: DataFrame, sizes: dict[tuple[int, int], int], folds: list[int]) -> DataFrame:
    """Of the rows of each class in ``folds``, about ``SAMPLE_PER_CLASS`` at most, by a hash of the id."""
    n = [max(1, sum(sizes.get((f, c), 0) for f in folds)) for c in (0, 1)]
    share = F.when(F.col("toxic") == 1, min(1.0, SAMPLE_PER_CLASS / n[1])).otherwise(min(1.0, SAMPLE_PER_CLASS / n[0]))
    draw = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("sample")), F.lit(1 << 30)) / (1 << 30)
    return marks.where(F.col("fold").isin(folds) & (draw < share))


def word_ratios(contexts: DataFrame, scratch: Scratch, entries: int | None = None) -> Ratios | None:
    """The log ratios from ``(toxic, before, word)``; None if a class has no words."""
    met = [F.count(F.when(F.col("toxic") == c, 1)).alias(f"k{c}") for c in (0, 1)]
    words = scratch.save(contexts.distinct().groupBy("word").agg(*met), "words")
    n, k0, k1, v0, v1 = words.agg(F.count("*"), F.sum("k0"), F.sum("k1"), F.sum((F.col("k0") > 0).cast("int")), F.sum((F.col("k1") > 0).cast("int"))).first()
    if not k0 or not k1:
        return None
    # The larger class is counted at the size of the smaller, so that a discount weighs alike in both.
    size = float(min(k0, k1))
    own = [F.col(f"k{c}") * (size / k) for c, k in ((0, k0), (1, k1))]
    above = [F.greatest(x - DISCOUNT, F.lit(0.0)) for x in own]
    classes = (F.col("k0") > 0).cast("int") + (F.col("k1") > 0).cast("int")
    words = words.select("word", (own[0] + own[1]).alias("met"), above[0].alias("above0"), above[1].alias("above1"), classes.alias("classes"))
    kept = words.agg(F.sum("above0"), F.sum("above1")).first()
    spread = [size - kept[c] + STRENGTH * n for c in (0, 1)]

    def ratio(above0, above1, classes) -> np.ndarray:
        shared = np.asarray(classes, float) / (v0 + v1 + 1)
        return np.log((np.asarray(above1, float) + spread[1] * shared) / (np.asarray(above0, float) + spread[0] * shared))

    entries = entries or MAX_ENTRIES
    apart, every = most_met(words, "met", entries)
    # At most as many rows as entries.
    most = words.where(apart).toPandas()
    ratios = Ratios(dict(zip(most["word"], ratio(most["above0"], most["above1"], most["classes"]).tolist())), ratio(0, 0, 1).item())
    if every:
        return ratios
    p = [F.col(f"above{c}") + F.lit(spread[c]) * F.col("classes") / (v0 + v1 + 1) for c in (0, 1)]
    rest = scratch.save(words.where(~apart & (F.col("above0") + F.col("above1") > 0)).select("word", F.log(p[1] / p[0]).alias("said")), "rest")
    least, highest = rest.agg(F.min("said"), F.max("said")).first()
    if least is not None:
        ratios.rest, ratios.marks = Rest(rest, least, highest), marks_of(rest)
    return ratios


def marks_of(words: DataFrame) -> bytes:
    """A bit for the hash of each word, eight to a byte; ``MARKS`` bits pass the driver at most."""
    mark = F.crc32(F.col("word").cast("binary")) % MARKS
    rows = words.select(F.floor(mark / MARKS_A_ROW).alias("at"), (mark % MARKS_A_ROW).alias("bit")).groupBy("at").agg(F.bitmap_construct_agg("bit").alias("bits"))
    marks = np.zeros((MARKS // MARKS_A_ROW, MARKS_A_ROW // 8), np.uint8)
    for row in rows.toLocalIterator():
        marks[row["at"]] = np.frombuffer(row["bits"], np.uint8)
    return marks.tobytes()


def sums(words: list[str], ratios: Ratios) -> tuple[float, float]:
    """What words say together: up to ``MILD``, and beyond. Words that are not sent count with the ratio of all others."""
    get, other = ratios.get, ratios.other
    said = np.fromiter((get(word, other) for word in words), float, len(words))
    mild = np.clip(said, -MILD, MILD)
    return float(mild.sum()), float((said - mild).sum())


def open_words(words: list[str], ratios: Ratios) -> dict[str, int]:
    """How often each word comes whose ratio may be in the join."""
    if ratios.rest is None:
        return {}
    return {word: n for word, n in Counter(word for word in words if word not in ratios).items() if ratios.marked(word)}


SAID = "struct<mild: double, strong: double, n: long, open: array<struct<word: string, n: long>>>"


def said_udf(spark: SparkSession, ratios: Ratios):
    """``sums``, number of words and ``open_words`` of a text; the ratios are sent once to each executor."""
    sent = ratios.sent(spark)

    @F.arrow_udf(SAID)
    def said(texts: pa.Array) -> pa.Array:
        found, ratios = [], sent.value
        for text in texts:
            words = tokens(text.as_py())
            mild, strong = sums(words, ratios)
            found.append({"mild": mild, "strong": strong, "n": len(words), "open": [{"word": w, "n": n} for w, n in open_words(words, ratios).items()]})
        words = pa.list_(pa.struct([("word", pa.string()), ("n", pa.int64())]))
        return pa.array(found, pa.struct([("mild", pa.float64()), ("strong", pa.float64()), ("n", pa.int64()), ("open", words)]))

    return said


def with_means(rows: DataFrame, ratios: Ratios, scratch: Scratch) -> DataFrame:
    """``rows`` with what the words of their ``text`` say on average, as ``mild`` and ``strong``, in place of the text; zeros without words.

    Where not all ratios are sent, texts stay where they are: their open words are joined with the rest, and what these say
    besides the ratio of all others is added to the sums.
    """
    rows = rows.withColumn("_said", said_udf(rows.sparkSession, ratios)("text")).drop("text")
    if ratios.rest is not None:
        rows = corrected(scratch.save(rows.withColumn("_row", F.monotonically_increasing_id()), "said"), ratios)
    n = F.greatest(F.col("_said.n"), F.lit(1))
    return rows.withColumns({"mild": F.col("_said.mild") / n, "strong": F.col("_said.strong") / n}).drop("_said")


def corrected(rows: DataFrame, ratios: Ratios) -> DataFrame:
    """``rows`` by ``_row`` with the sums in ``_said`` completed by the joined ratios. Equal rows get equal sums, as what is added goes by value."""
    words = rows.select("_row", F.explode("_said.open").alias("open")).select("_row", "open.word", "open.n")
    mild = F.greatest(F.lit(-MILD), F.least(F.lit(MILD), F.col("said")))
    usual = min(MILD, max(-MILD, ratios.other))
    more = {"mild": mild - F.lit(usual), "strong": F.col("said") - mild - F.lit(ratios.other - usual)}
    parts = F.sort_array(F.collect_list(F.struct(*[(F.col("n") * more[name]).alias(name) for name in more])))
    added = words.join(ratios.rest.rows, "word").groupBy("_row").agg(parts.alias("_parts"))

    def total(name: str) -> Column:
        return F.coalesce(F.aggregate("_parts", F.lit(0.0), lambda held, part: held + part[name]), F.lit(0.0))

    said = F.struct(*[(F.col(f"_said.{name}") + total(name)).alias(name) for name in more], F.col("_said.n").alias("n"))
    return rows.join(added, "_row", "left").withColumn("_said", said).drop("_row", "_parts")


def score_of(model: Model) -> Column:
    """The score from ``mild`` and ``strong``, between 0 and 1."""
    a, b, offset = model.curve
    logit = F.col("mild") * a + F.col("strong") * b + F.lit(offset)
    return 1 / (1 + F.exp(-F.greatest(F.lit(-700.0), F.least(F.lit(700.0), logit))))


def verdict_udf(spark: SparkSession, model: Model):
    """For a text: 1 if its score is 0.5 or more, 0 if less, null where that depends on ratios that are not sent."""
    sent, (a, b, offset) = model.ratios.sent(spark), model.curve

    def moves(ratios: Ratios) -> tuple[float, float]:
        """How far down and up one open word may move a text's logit, times the number of its words."""
        rest, told = ratios.rest, lambda said: a * max(-MILD, min(MILD, said)) + b * (said - max(-MILD, min(MILD, said)))
        ends = [x for x in (rest.least, -MILD, MILD, rest.highest) if rest.least <= x <= rest.highest]
        shifts = [told(x) - told(ratios.other) for x in ends]
        return min(0.0, *shifts), max(0.0, *shifts)

    def squeezed(logit: float) -> float:
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, logit))))

    @F.arrow_udf(IntegerType())
    def verdicts(texts: pa.Array) -> pa.Array:
        found, ratios = [], sent.value
        down, up = moves(ratios) if ratios.rest else (0.0, 0.0)
        for text in texts:
            words = tokens(text.as_py())
            mild, strong = sums(words, ratios)
            m, n = sum(open_words(words, ratios).values()), max(1, len(words))
            logit = mild / n * a + strong / n * b + offset
            # Sums of the two ways may differ in their last digits.
            slack = 1e-9 * (1 + abs(logit)) if m else 0.0
            low, high = logit + m * down / n - slack, logit + m * up / n + slack
            found.append(0 if squeezed(high) < 0.5 else 1 if squeezed(low) >= 0.5 else None)
        return pa.array(found, pa.int32())

    return verdicts


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, ...]:
    """Slopes and offset of a slightly damped logistic curve over the columns of ``x``, by Newton's method."""
    scale = np.where(x.std(0) > 0, x.std(0), 1.0)
    design = np.column_stack([x / scale, np.ones(len(x))])
    beta, damp = np.zeros(design.shape[1]), np.append(np.full(x.shape[1], 1e-2), 1e-9)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -500, 500)))
        slope = design.T @ (weight * (y - p)) - damp * beta * (damp > 1e-9)
        curve = (design * (weight * p * (1 - p))[:, None]).T @ design + np.diag(damp)
        step = np.linalg.solve(curve, slope)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return (*(beta[:-1] / scale).tolist(), float(beta[-1]))


def counted(docs: DataFrame, marks: DataFrame, folds: list[int], scratch: Scratch) -> Ratios | None:
    """The ratios from all labelled rows of ``folds``."""
    # Texts of other folds stay where they are, the others are packed before they move. Labels grow with the
    # documents, so both sides are sorted and merged at every size.
    texts = docs.where(fold(F.col("doc_id")).isin(folds)).select("doc_id", packed("text").alias("packed"))
    rows = texts.join(marks.where(F.col("fold").isin(folds)).select("doc_id", "toxic").hint("merge"), "doc_id").select("toxic", "packed")
    return word_ratios(rows.mapInPandas(_contexts, "toxic int, before long, word string"), scratch)


def seen(docs: DataFrame, marks: DataFrame, sizes: dict[tuple[int, int], int], folds: list[int], ratios: Ratios, scratch: Scratch) -> pd.DataFrame:
    """``toxic, mild, strong, weight`` of the rows in ``folds`` that the curve is fitted to."""
    # This sample is bounded by SAMPLE_PER_CLASS, so its ids may go to every task.
    sample = docs.select("doc_id", "text").join(F.broadcast(curve_sample(marks, sizes, folds)), "doc_id")
    found = with_means(sample.select("toxic", "text"), ratios, scratch).toPandas()
    # The sample may thin one class out; weights restore the shares of all labelled rows.
    for c in (0, 1):
        own = found["toxic"] == c
        found.loc[own, "weight"] = sum(sizes.get((f, c), 0) for f in folds) / max(1, own.sum())
    return found


def train(docs: DataFrame, labels: DataFrame, scratch: Scratch) -> Model:
    """Fit the models to labelled rows outside fold 0.

    All labelled rows of folds 2 to 4 are counted, and the curve is fitted to fold 1. Where one of these parts
    lacks a class, as may be with few labels, each fold in turn is marked by the counts of the three others, the
    curve is fitted to all marks, and all rows are counted for the model. If even so no marks of both classes come
    about (a class has one row), the curve is fitted to the rows counted. A model that marks nothing comes about only if one
    class has no label at all, or no words.
    """
    marks, sizes = labelled(labels, scratch)
    both = lambda folds: all(any((f, c) in sizes for f in folds) for c in (0, 1))
    folds = list(range(1, FOLDS))
    if not both(folds):
        return Model()
    if both([1]) and both(folds[1:]):
        ratios = counted(docs, marks, folds[1:], scratch)
        rows = seen(docs, marks, sizes, [1], ratios, scratch) if ratios is not None else None
    else:
        ratios, parts = counted(docs, marks, folds, scratch), []
        for own in folds:
            others = [f for f in folds if f != own]
            part = counted(docs, marks, others, scratch) if both(others) else None
            if part is not None:
                parts.append(seen(docs, marks, sizes, [own], part, scratch))
        rows = pd.concat(parts) if parts else None
    if ratios is None:
        return Model()
    if rows is None or rows["toxic"].nunique() < 2:
        rows = seen(docs, marks, sizes, folds, ratios, scratch)
    if rows["toxic"].nunique() < 2:
        return Model()
    return Model(ratios, logistic(rows[["mild", "strong"]].to_numpy(), rows["toxic"].to_numpy(float), rows["weight"].to_numpy(float)))


def score_documents(docs: DataFrame, labels: DataFrame, scratch: Scratch) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs(doc_id, text)``.

    Null and empty texts are scored like a text whose words say nothing. Equal rows get equal
    scores. A null doc_id is never labelled. Other columns are ignored.
    """
    model = train(docs, labels, scratch)
    rows = docs.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "text")
    if model.ratios is None:
        scored = rows.select("doc_id", "held_out", F.lit(0.0).alias("score"))
    else:
        scored = with_means(rows, model.ratios, scratch).select("doc_id", "held_out", score_of(model).alias("score"))
    return scored.select("*", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, scratch: Scratch) -> DataFrame:
    """The rows of ``docs`` whose score is below 0.5, with all their columns, whatever they are called.

    Only rows that joined ratios may turn are written, and read once more with these.
    """
    model = train(docs, labels, scratch)
    if model.ratios is None:
        return docs
    judged = docs.select(F.struct("*").alias("doc"), verdict_udf(docs.sparkSession, model)("text").alias("verdict"))
    kept = judged.where("verdict = 0").select("doc.*")
    if model.ratios.rest is None:
        return kept
    unsettled = scratch.save(judged.where("verdict is null").select("doc"), "unsettled")
    scored = with_means(unsettled.select("doc", F.col("doc.text").alias("text")), model.ratios, scratch)
    return kept.unionAll(scored.where(score_of(model) < 0.5).select("doc.*"))
