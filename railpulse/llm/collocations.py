"""Collocations from a weighted de Bruijn graph of words, for each language.

Nodes are runs of four words, and an edge is a run of five that leads from its first four words to its
last four. Every word of a piece begins one window of five words; near the end of a piece it is shorter.
Windows are counted in the tasks, sorted, packed by ranges of windows, and each range goes to one task, which
unpacks and sorts them (on disk, if need be). Windows that begin with the same words stand together there, so the
flow out of a node, the edges that begin with it and the shorter windows that end a piece there, is a sum over
neighbours, and so are the counts of runs of three and two words.

Edges and nodes that occur often enough make up a much smaller graph. A node whose whole flow comes in
by one edge and leaves by one is unary; chains of such nodes are compacted to paths, found by pointer
doubling. Runs inside a path occur in something longer just as often, so they are dropped by it; other
nodes and shorter runs are held against the runs that extend them by one word.

A word that is rarer than a candidate must be ends a window, as the end of a piece does, since no
candidate holds it. Words travel as numbers: those of the most frequent words, ``DICTIONARY`` at most, go to every
task; where more words are frequent, all others travel as 63 bits of a hash, which is checked to tell them apart.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from railpulse.llm.common import most_met
from railpulse.session import Scratch

LONGEST = 5
LEAST_COUNT = 100
REPORTED = 2_000
# Words whose numbers are sent to every task, at most; about 100 MB there.
DICTIONARY = 500_000
# Words that a task holds before it counts and sends on their windows; bytes of a text cut at a time.
FLUSH = 2_000_000
BLOCK = 1 << 20
BITS = 21
ROWS = 100_000
# Words for which there is a range of windows, the most ranges, and windows drawn for each to tell where it ends.
# The draw decides only how evenly the ranges are filled.
RANGE_WORDS, MOST_RANGES, DRAWN = 1_000_000, 20_000, 64

GRAM = [f"w{i}" for i in range(1, LONGEST + 1)]
NO_LANG = "und"
# Bytes of a text: A to Z lower-cased, all separators of pieces one byte, both blanks another.
BYTES = bytes(10 if byte in b".,;:!?\n\v\f\r" else 32 if byte == 9 else byte + 32 if 65 <= byte <= 90 else byte for byte in range(256))
SPLIT = r"[\x20\x09.,;:!?\x0A-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_counted(docs: DataFrame) -> DataFrame:
    """``lang, word, f`` over all words. Case is levelled once words are counted, as that is dear per letter."""
    words = docs.select(F.coalesce("lang", F.lit(NO_LANG)).alias("lang"), F.explode(F.split("text", SPLIT)).alias("word"))
    cased = words.where("word <> ''").groupBy("lang", "word").agg(F.count(F.lit(1)).alias("f"))
    return cased.groupBy("lang", F.translate("word", UPPER, LOWER).alias("word")).agg(F.sum("f").alias("f"))


def hashed(lang: str, word: bytes, seed: int) -> int:
    """A negative number for a word outside the dictionary."""
    return -1 - (xxhash.xxh64_intdigest(lang.encode() + b"\x00" + word, seed) >> 1)


class Numbers(dict):
    """The number of each word of a language: 0 for what ends a window, -1 for the nothing between two blanks."""

    NOTHING = np.iinfo(np.int64).max

    def __init__(self, lang: str, known: dict[str, int], seed: int | None):
        super().__init__((word.encode(), number) for word, number in known.items())
        self[b""], self[b"\n"] = self.NOTHING, 0
        self._lang, self._seed = lang, seed

    def __missing__(self, word: bytes) -> int:
        return 0 if self._seed is None else hashed(self._lang, word, self._seed)


def _cut(data: bytes, size: int = BLOCK) -> Iterator[bytes]:
    """A text's bytes in parts of about ``size``, each ended by a blank or a separator."""
    at = 0
    while at < len(data):
        end = at + size
        if end < len(data):
            places = [place for place in (data.find(b" ", end), data.find(b"\n", end)) if place >= 0]
            end = min(places) + 1 if places else len(data)
        yield data[at:end]
        at = end


def _counted(numbers: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The different windows that begin in ``numbers[:-4]``, in order and by the ranges between ``bounds``, and how often each occurs."""
    names, codes = np.unique(np.append(numbers, 0), return_inverse=True)
    ends = np.searchsorted(names, 0)
    n, columns, open_ = len(numbers) - LONGEST + 1, [], None
    for i in range(LONGEST):
        here = codes[i:i + n]
        open_ = here != ends if open_ is None else open_ & (here != ends)
        columns.append(np.where(open_, here, ends))
    high, low = _folded(columns)
    keep = columns[0] != ends
    high, low = high[keep], low[keep]
    order = np.lexsort((low, high))
    high, low = high[order], low[order]
    starts = np.flatnonzero(np.append(True, (high[1:] != high[:-1]) | (low[1:] != low[:-1]))) if len(high) else np.zeros(0, int)
    high, low, count = high[starts], low[starts], np.diff(np.append(starts, len(high)))
    edges = [0, *_places(high, low, names, bounds), len(high)]
    mask = (1 << BITS) - 1
    for own, (first, last) in enumerate(zip(edges, edges[1:])):
        for at in range(first, last, ROWS):
            h, l = high[at:min(last, at + ROWS)], low[at:min(last, at + ROWS)]
            yield own, np.stack([names[h >> 2 * BITS], names[h >> BITS & mask], names[h & mask], names[l >> BITS], names[l & mask]]), count[at:at + len(h)]


def _folded(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Five codes in two numbers of the same order. A flush holds fewer than 2^21 different words, so three codes fit into one."""
    return columns[0] << 2 * BITS | columns[1] << BITS | columns[2], columns[3] << BITS | columns[4]


def _places(high: np.ndarray, low: np.ndarray, names: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where each of the ascending ``bounds`` stands among sorted windows."""
    if not len(bounds):
        return np.zeros(0, int)
    codes = np.searchsorted(names, bounds)
    met = names[np.minimum(codes, len(names) - 1)] == bounds
    # A word that is not among the names lies before the next one, whatever follows.
    after = np.cumsum(~met, axis=1) - ~met > 0
    codes[after] = 0
    bound_high, bound_low = _folded(list(codes.T))
    first, last = np.searchsorted(high, bound_high, "left"), np.searchsorted(high, bound_high, "right")
    for i in np.flatnonzero(first < last):
        first[i] += np.searchsorted(low[first[i]:last[i]], bound_low[i], "left")
    return first


def _packed(grams: np.ndarray, count: np.ndarray) -> bytes:
    """Sorted windows as bytes; like bytes of all numbers stand together, as few of them differ."""
    numbers = np.vstack([np.diff(grams[:1], prepend=0), grams[1:], count[None]])
    return zstandard.compress(np.ascontiguousarray(numbers.reshape(len(numbers), -1, 1).view(np.uint8).transpose(0, 2, 1)).tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(LONGEST + 1, 8, -1)
    numbers = np.ascontiguousarray(planes.transpose(0, 2, 1)).view(np.int64)[:, :, 0]
    return np.vstack([np.cumsum(numbers[:1], axis=1), numbers[1:]])


def number_udf(seed: int):
    @F.pandas_udf("long")
    def number(lang: pd.Series, word: pd.Series) -> pd.Series:
        return pd.Series([hashed(l, w.encode(), seed) for l, w in zip(lang, word)], dtype="int64")

    return number


def hashed_words(others: DataFrame, frequent: DataFrame, scratch: Scratch) -> tuple[DataFrame, int]:
    """``lang, word, f, id`` of frequent words by hash, and the first seed for which no other word has the hash of one."""
    seed = 0
    while True:
        number = number_udf(seed)
        ids = scratch.save(frequent.select("lang", "word", "f", number("lang", "word").alias("id")), "hashed")
        met = others.select(number("lang", "word").alias("id")).join(ids.select("id"), "id", "left_semi").groupBy("id").count()
        if met.where("count > 1").isEmpty():
            return ids, seed
        seed += 1


def windows(docs: DataFrame, sent: pd.DataFrame, seed: int | None, bounds: np.ndarray | None = None, flush: int = FLUSH) -> DataFrame:
    """``w1..w5, c``: windows counted in each task, 0 after the end of one; with ``bounds``, packed as ``range, packed``."""
    spark = docs.sparkSession
    told = spark.sparkContext.broadcast({lang: dict(zip(own["word"], own["id"].astype(int))) for lang, own in sent.groupby("lang")})
    plain, bounds = bounds is None, np.zeros((0, LONGEST), np.int64) if bounds is None else bounds
    parted = spark.sparkContext.broadcast(bounds)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_lang, held, size = {}, [], 0

        def flushed(last: bool) -> Iterator[pa.RecordBatch]:
            numbers = np.concatenate(held)
            # Windows that begin in the last four words wait for what follows.
            del held[:]
            if not last:
                held.append(numbers[1 - LONGEST:])
            else:
                numbers = np.append(numbers, np.zeros(LONGEST - 1, np.int64))
            for own, grams, counts in _counted(numbers, parted.value):
                if plain:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (*grams, counts)], names=[*GRAM, "c"])
                else:
                    yield pa.RecordBatch.from_arrays([pa.array([own]), pa.array([_packed(grams, counts)])], names=["range", "packed"])

        for batch in batches:
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"]):
                if not text.is_valid:
                    continue
                if lang not in by_lang:
                    if len(by_lang) > 100:
                        by_lang.clear()
                    by_lang[lang] = Numbers(lang, told.value.get(lang, {}), seed)
                for part in _cut(text.as_buffer().to_pybytes().translate(BYTES)):
                    numbers = np.fromiter(map(by_lang[lang].__getitem__, part.replace(b"\n", b" \n ").split(b" ")), np.int64)
                    numbers = numbers[numbers != Numbers.NOTHING]
                    for at in range(0, len(numbers), flush // 2):
                        held.append(numbers[at:at + flush // 2])
                        size += len(held[-1])
                        if size >= flush // 2:
                            yield from flushed(False)
                            size = 0
                held.append(np.zeros(1, np.int64))
                size += 1
        if held:
            yield from flushed(True)

    rows = docs.select(F.coalesce("lang", F.lit(NO_LANG)).alias("lang"), "text")
    return rows.mapInArrow(count, ", ".join(f"{c} long" for c in [*GRAM, "c"]) if plain else "range long, packed binary")


def range_bounds(docs: DataFrame, sent: pd.DataFrame, seed: int | None, words: int, range_words: int) -> np.ndarray:
    """Windows that part all windows into ranges of about ``range_words`` words, from those of a few texts drawn at random."""
    ranges = max(1, min(MOST_RANGES, words // range_words))
    if ranges == 1:
        return np.zeros((0, LONGEST), np.int64)
    drawn = min(1.0, 20 * DRAWN * ranges / words)
    some = windows(docs.select("lang", "text").sample(drawn, 1), sent, seed)
    some = some.sample(min(1.0, DRAWN * ranges / (words * drawn)), 1).select(*GRAM).distinct().orderBy(*GRAM).toPandas().to_numpy(np.int64)
    return some[np.unique(np.linspace(0, len(some), ranges + 1).astype(int)[1:-1])] if len(some) else some.reshape(0, LONGEST)


def sorted_windows(packed: DataFrame, ranges: int) -> DataFrame:
    """``range, w1..w5, c`` of packed windows, each range in one task and in order there."""
    columns = ["range", *GRAM, "c"]

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, data in zip(batch["range"].to_pylist(), batch["packed"]):
                numbers = _unpacked(data.as_py())
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (np.full(numbers.shape[1], own), *numbers)], names=columns)

    rows = packed.repartition(ranges, "range").mapInArrow(unpack, ", ".join(f"{c} long" for c in columns))
    return rows.sortWithinPartitions("range", *GRAM)


def flows(ordered: DataFrame, least: int) -> DataFrame:
    """``k, w1..w5, f`` of every run of 2 to 5 words with ``f >= least``, from windows counted in part, in order of their ranges.

    A batch knows the whole flow of all runs but those that its part of a range begins and ends with; these
    few are added up over batches.
    """
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            grams, c = np.stack([batch[w].to_numpy() for w in GRAM]), batch["c"].to_numpy()
            place = batch["range"].to_numpy()
            new = np.append(True, place[1:] != place[:-1])
            parts = np.flatnonzero(new)
            for k in range(1, LONGEST + 1):
                new[1:] |= grams[k - 1, 1:] != grams[k - 1, :-1]
                if k == 1:
                    continue
                starts = np.flatnonzero(new)
                f = np.add.reduceat(c, starts)
                whole = grams[k - 1, starts] != 0
                at_edge = np.zeros(len(starts), bool)
                first = np.searchsorted(starts, parts)
                at_edge[first] = at_edge[first - 1] = True
                kept = whole & (at_edge | (f >= least))
                found = np.where(np.arange(LONGEST)[:, None] < k, grams[:, starts[kept]], 0)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(kept.sum(), k, np.int32)), *map(pa.array, found), pa.array(f[kept])], names=["k", *GRAM, "f"])

    parts = ordered.mapInArrow(add, "k int, " + ", ".join(f"{c} long" for c in [*GRAM, "f"]))
    return parts.groupBy("k", *GRAM).agg(F.sum("f").alias("f")).where(F.col("f") >= least)


def run(first: int, last: int) -> Column:
    """Words ``first`` to ``last`` of a run, as a key."""
    return F.array(*GRAM[first - 1:last])


def unary_nodes(grams: DataFrame) -> DataFrame:
    """``node, f, into, out``: runs of four whose whole flow comes in by one edge and leaves by one, and these edges."""
    nodes = grams.where("k = 4").select(run(1, 4).alias("node"), "f")
    edges = grams.where("k = 5")
    into = edges.select(run(2, 5).alias("node"), "f", run(1, 5).alias("into"))
    out = edges.select(run(1, 4).alias("node"), "f", run(1, 5).alias("out"))
    return nodes.join(into, ["node", "f"]).join(out, ["node", "f"])


def paths(grams: DataFrame, scratch: Scratch) -> DataFrame:
    """``edge, path, place``: every edge with the last edge of its compacted path and how far it is from there.

    Each round doubles how far an edge sees, so a path of n edges takes about log2(n) rounds. A unary node
    is on no pure cycle, since a piece that goes round must have come in somewhere.
    """
    links = unary_nodes(grams).select(F.col("into").alias("edge"), F.col("out").alias("path"))
    edges = grams.where("k = 5").select(run(1, 5).alias("edge"))
    seen = scratch.save(edges.join(links, "edge", "left")
                        .select("edge", F.coalesce("path", "edge").alias("path"), F.col("path").isNotNull().cast("long").alias("place")), "paths")
    while True:
        ahead = seen.where("place > 0").select(F.col("edge").alias("path"), F.col("path").alias("_path"), F.col("place").alias("_place"))
        further = seen.join(ahead, "path", "left")
        if further.where("_path is not null").isEmpty():
            return seen
        seen = scratch.save(further.select("edge", F.coalesce("_path", "path").alias("path"),
                                           (F.col("place") + F.coalesce("_place", F.lit(0))).alias("place")), "paths")


def inside_longer(grams: DataFrame, compacted: DataFrame) -> DataFrame:
    """``k, gram`` of runs that stand in a longer one which occurs as often.

    All nodes between two edges of one path do; other runs do if one with a word more, at either end, does.
    """
    between = compacted.where("place > 0").select(F.lit(4).alias("k"), F.slice("edge", 2, 4).alias("gram"))
    sides = [grams.where("k > 2").select((F.col("k") - 1).alias("k"), "f", F.slice(run(1, 5), F.lit(start), F.col("k") - 1).alias("gram")) for start in (1, 2)]
    extended = sides[0].unionAll(sides[1]).distinct()
    own = grams.where("k < 5").select("k", "f", F.slice(run(1, 5), F.lit(1), F.col("k")).alias("gram"))
    others = own.join(between, ["k", "gram"], "left_anti").join(extended, ["k", "f", "gram"], "left_semi").select("k", "gram")
    return between.unionAll(others).distinct()


def scored(candidates: DataFrame, counts: DataFrame, totals: DataFrame) -> DataFrame:
    """Candidates ``k, gram, a, lang`` with ``l, r, n, score`` of their lowest cut.

    Products are decimals of 38 digits and the quotient is cut off to a whole number, so nothing is rounded.
    """
    cut = F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut")
    cuts = candidates.select("k", "gram", "a", "lang", cut).select(
        "*", F.slice("gram", F.lit(1), F.col("cut")).alias("left"), F.slice("gram", F.col("cut") + 1, F.col("k") - F.col("cut")).alias("right"))
    both = (cuts.join(counts.select(F.col("gram").alias("left"), F.col("f").alias("l")), "left")
            .join(counts.select(F.col("gram").alias("right"), F.col("f").alias("r")), "right").join(totals, "lang"))
    whole = [F.col(c).cast("decimal(19,0)") for c in ("a", "n", "l", "r")]
    product = (whole[0] * F.lit(1000).cast("decimal(4,0)")).cast("decimal(23,0)") * whole[1].cast("decimal(15,0)")
    score = F.call_function("div", product, whole[2] * whole[3])
    lowest = F.min(F.struct(score.alias("score"), "cut", "l", "r", "n")).alias("low")
    return both.groupBy("k", "gram", "a", "lang").agg(lowest).select("gram", "a", "lang", "low.l", "low.r", "low.n", "low.score")


def collocations(docs: DataFrame, scratch: Scratch, least: int = LEAST_COUNT, reported: int = REPORTED,
                 dictionary: int = DICTIONARY, range_words: int = RANGE_WORDS) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the first ``reported`` phrases of each language of ``docs(lang, text)``.

    A null lang is ``und``, a null or empty text has no words, repeated rows count each. Ties go to the larger
    count, then to the phrase by its bytes. Counts are over all texts; only what is at least ``least`` times
    in the texts can be reported. Other columns are ignored. Without candidates the result is empty.
    """
    vocabulary = scratch.save(words_counted(docs), "vocabulary")
    totals = scratch.save(vocabulary.groupBy("lang").agg(F.sum("f").alias("n")), "totals")
    frequent = vocabulary.where(F.col("f") >= least)
    told, complete = most_met(frequent, "f", dictionary)
    # At most as many rows as the dictionary holds.
    sent = frequent.where(told).toPandas().sort_values(["f", "lang", "word"], ascending=[False, True, True])
    sent["id"] = np.arange(1, len(sent) + 1)
    ids = docs.sparkSession.createDataFrame(sent[["lang", "word", "f", "id"]], "lang string, word string, f long, id long")
    ids, seed = scratch.save(ids, "dictionary"), None
    if not complete:
        rest, seed = hashed_words(vocabulary.where((F.col("f") < least) | ~told), frequent.where(~told), scratch)
        ids = ids.unionByName(rest)
    words = totals.agg(F.sum("n")).first()[0] or 0
    bounds = range_bounds(docs, sent, seed, words, range_words)
    grams = scratch.save(flows(sorted_windows(windows(docs, sent, seed, bounds), len(bounds) + 1), least), "grams")
    dropped = inside_longer(grams, paths(grams, scratch))
    gram = F.slice(run(1, 5), F.lit(1), F.col("k")).alias("gram")
    counts = grams.select(gram, "f").unionAll(ids.select(F.array("id").alias("gram"), "f"))
    left = grams.select("k", gram, F.col("f").alias("a")).join(dropped, ["k", "gram"], "left_anti")
    first = ids.select("lang", F.col("id").alias("first"))
    best = scored(left.withColumn("first", F.col("gram")[0]).join(first, "first").drop("first"), counts, totals)
    best = scratch.save(best, "scored")
    words = (best.select("gram", F.posexplode("gram").alias("place", "id")).join(ids.select("id", "word"), "id").groupBy("gram")
             .agg(F.array_sort(F.collect_list(F.struct("place", "word"))).alias("words")))
    named = best.join(words.select("gram", F.array_join(F.col("words.word"), " ").alias("phrase")), "gram")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")).cast("long")
    return named.withColumn("rank", rank).where(F.col("rank") <= reported).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
