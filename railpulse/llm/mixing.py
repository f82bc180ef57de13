"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

Sources share a total by weight, none above ``most_repeats`` times its own size. The shares become
whole numbers of blocks of ``block`` words: each further block goes to the highest quotient
share / (2 * blocks + 1). A source's blocks go to its shards in the same way. Within a shard the
documents lie in a seeded order; its quota takes every block as often as it fits, and a seeded run
of blocks (going round at the end) once more. What a document gives is then plain arithmetic on
its place in the shard, so no block is ever a row.

Only DataFrame functions. Shards hold about the square root of all documents, so neither a shard
nor the list of a source's shards is a large group, whatever share one source has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from railpulse.llm.common import word_count
from railpulse.session import Scratch

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST_REPEATS = 2
BLOCK = 4
SHARD_ROWS = 256


def _whole(number: Column) -> Column:
    return F.floor(number + 0.5)


def _seeded(*parts: Column) -> Column:
    """A hash of texts as a whole number below 2**32."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 8), 16, 10).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most_repeats: int = MOST_REPEATS) -> DataFrame:
    """``sizes(source, source_size)`` with the ``target`` of each source, in words.

    Weights go to sources in order of their code points, null last, and repeat. What lies above
    ``most_repeats`` sizes is shared out again by weight until nothing does: sources are full in
    order of size over weight, up to the level that the rest of the total reaches.
    """
    place = Window.orderBy(F.col("source").isNull(), "source")
    ranked = sizes.withColumn("place", F.row_number().over(place))
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.col("place") - 1) % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight).withColumn("most", F.col("source_size").cast("double") * most_repeats)
    rising = Window.orderBy(F.col("most") / F.col("weight"), "place")
    before, onward = rising.rowsBetween(Window.unboundedPreceding, -1), rising.rowsBetween(0, Window.unboundedFollowing)
    all_ = Window.partitionBy()
    ranked = (ranked.withColumn("total", F.sum("source_size").over(all_) * share)
              .withColumn("level", (F.col("total") - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(onward))
              .withColumn("full", F.col("level") * F.col("weight") >= F.col("most")))
    of = lambda full, value: F.coalesce(F.sum(F.when(F.col("full") == full, F.col(value))).over(all_), F.lit(0.0))
    open_level = (F.col("total") - of(True, "most")) / of(False, "weight")
    return ranked.withColumn("target", F.when(F.col("full"), F.col("most")).otherwise(open_level * F.col("weight"))).select(
        "source", "source_size", "place", "target")


def apportion(rows: DataFrame, group: list[str], key: str, share: str, seats: str) -> DataFrame:
    """``rows`` with ``quota``: whole numbers near ``share``, adding up to ``seats`` in each group.

    Shares add up to the seats of their group but for rounding. Rounding every share is the
    Sainte-Lague rule at one divisor; the seats that are then missing go to the highest quotients, and
    those too many leave the lowest. A row's candidates are in proportion to its share, so there
    are never more than a few per row. Ties go to the smaller ``key``, a number.
    """
    all_ = Window.partitionBy(*group)
    rows = rows.withColumn("near", _whole(F.col(share)))
    rows = (rows.withColumn("gap", F.col(seats) - F.sum("near").over(all_))
            .withColumn("part", F.col(share) / F.greatest(F.sum(share).over(all_), F.lit(1e-300)) * (F.abs("gap") + F.count("*").over(all_))))
    steps = F.least(F.abs("gap"), F.ceil("part") + 1).cast("int")
    tries = rows.where("gap <> 0").select("*", F.explode(F.sequence(F.lit(1), steps)).alias("step"))
    up = F.col("gap") > 0
    quotient = F.when(up, F.col(share) / (2 * (F.col("near") + F.col("step")) - 1)).otherwise(
        -F.col(share) / (2 * (F.col("near") - F.col("step")) + 1))
    tries = tries.where(up | (F.col("near") >= F.col("step"))).withColumn("quotient", quotient)
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(F.desc("quotient"), F.col(key) * F.signum("gap"), F.col("step") * F.signum("gap")))
    won = (tries.withColumn("rank", rank).where(F.col("rank") <= F.abs("gap"))
           .groupBy(*group, key).agg(F.sum(F.signum("gap")).cast("long").alias("moved")))
    same = [F.col(f"rows.{c}").eqNullSafe(F.col(f"won.{c}")) for c in [*group, key]]
    return (rows.alias("rows").join(won.alias("won"), same, "left")
            .select("rows.*", (F.col("near") + F.coalesce("moved", F.lit(0))).cast("long").alias("quota"))
            .drop("near", "gap", "part"))


def _taken_before(words: Column, block: int) -> Column:
    """Words taken from the first ``words`` of a shard."""
    whole, blocks, start, more = F.floor(words / F.lit(block)), F.col("blocks"), F.col("start"), F.col("more")
    past = start + more - blocks
    once_more = F.when(past <= 0, F.least(F.greatest(whole - start, F.lit(0)), more)).otherwise(
        F.least(whole, past) + F.greatest(whole - start, F.lit(0)))
    inside = F.when(past <= 0, (whole >= start) & (whole < start + more)).otherwise((whole < past) | (whole >= start))
    return (block * (F.col("every") * whole + once_more) + (words - block * whole) * (F.col("every") + inside.cast("int"))).cast("long")


def plan(docs: DataFrame, scratch: Scratch, seed: str = "mix", block: int = BLOCK, **rule) -> DataFrame:
    """``docs(doc_id, source, size, order, ...)`` with what the mix takes of each row.

    Adds ``source_size``, ``target``, ``taken`` (words, repeats counted), ``first`` and ``last`` (the
    row's words in its shard) and the shard's ``blocks, every, start, more``. ``order`` is a text
    that deals rows to shards and orders them there; rows alike in it go by doc_id and size.
    """
    sums = docs.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    sums = scratch.save(sums, "sources")
    n = sums.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n")).select(F.greatest(F.lit(SHARD_ROWS), F.ceil(F.sqrt("n"))).alias("shard_rows"))
    shard_rows = n.first()[0]
    goal = targets(sums.select("source", "source_size"), **rule).withColumn("share", F.col("target") / block)
    goal = goal.withColumn("seats", _whole(F.sum("share").over(Window.partitionBy()))).withColumn("all", F.lit(0))
    goal = apportion(goal, ["all"], "place", "share", "seats").select("source", "source_size", "place", "target", "quota")
    goal = scratch.save(goal.join(sums.select(F.col("source").alias("s"), F.ceil(F.col("rows") / shard_rows).alias("shards")),
                                  F.col("source").eqNullSafe(F.col("s"))).drop("s"), "targets")
    names = [f"docs.`{c}`" for c in docs.columns]
    dealt = docs.alias("docs").join(goal.alias("goal"), F.col("docs.source").eqNullSafe(F.col("goal.source"))).select(
        *names, "source_size", "place", "target",
        (F.conv(F.substring("order", 1, 8), 16, 10).cast("long") % F.col("shards")).alias("shard"))
    shards = dealt.groupBy("place", "shard").agg(F.sum("size").alias("words"))
    shards = shards.join(goal.select("place", "source_size", "quota"), "place").withColumnRenamed("quota", "seats")
    shards = shards.withColumn("share", F.when(F.col("source_size") > 0, F.col("seats") * F.col("words") / F.col("source_size")).otherwise(0.0))
    most = rule.get("most_repeats", MOST_REPEATS)
    blocks = F.ceil(F.col("words") / F.lit(block)).cast("long")
    shards = apportion(shards, ["place"], "shard", "share", "seats").select(
        "place", "shard", blocks.alias("blocks"), F.least("quota", blocks * most).alias("quota"))
    size = F.greatest("blocks", F.lit(1))
    shards = scratch.save(shards.select(
        "place", "shard", "blocks", F.floor(F.col("quota") / size).alias("every"), (F.col("quota") % size).alias("more"),
        (_seeded(F.lit(seed), F.col("place").cast("string"), F.col("shard").cast("string")) % size).alias("start")), "shards")
    lie = Window.partitionBy("place", "shard").orderBy("order", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    laid = dealt.withColumn("last", F.sum("size").over(lie)).withColumn("first", F.col("last") - F.col("size"))
    laid = laid.join(shards, ["place", "shard"])
    return laid.withColumn("taken", _taken_before(F.col("last"), block) - _taken_before(F.col("first"), block)).drop("place", "shard")


def _order(seed: str) -> Column:
    return F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("text", F.lit(""))))


def mix_report(docs: DataFrame, scratch: Scratch, seed: str = "mix", **rule) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` for every row of ``docs(doc_id, text, source)``.

    A null or empty text has size 0 and gives nothing. The null source and the empty one are sources
    like any other. Rows alike in doc_id and text may lie in either order. Other columns are
    ignored; an empty table gives an empty one.
    """
    narrow = scratch.save(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), _order(seed).alias("order")), "sized")
    return plan(narrow, scratch, seed, **rule).select("doc_id", "size", "source_size", "target", "taken")


def mix_documents(docs: DataFrame, scratch: Scratch, seed: str = "mix", block: int = BLOCK, **rule) -> DataFrame:
    """The mix as documents, with the columns of ``docs``.

    Each row gives one row for every time (a part of) it is taken: in full, its text as it is; else the
    words taken with the white space after them. ``n_chars``, where there is one, is that of the
    text given. Rows of which nothing is taken, those without words too, are gone.
    """
    names = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col("doc_id"), F.col("source"),
                       word_count(F.col("text")).alias("size"), _order(seed).alias("order"))
    laid = plan(rows, scratch, seed, block, **rule).where("taken > 0")
    # Turn t takes words of all blocks where t <= every, and of the run at start where t = every + 1.
    turns = laid.withColumn("turn", F.explode(F.sequence(F.lit(1), (F.col("every") + F.when(F.col("more") > 0, 1).otherwise(0)).cast("int"))))
    past = F.greatest(F.col("start") + F.col("more") - F.col("blocks"), F.lit(0))

    def cut(a: Column, b: Column) -> Column:
        return F.struct((F.greatest(a * block, F.col("first")) - F.col("first")).alias("a"),
                        (F.least(b * block, F.col("last")) - F.col("first")).alias("b"))

    spans = F.when(F.col("turn") <= F.col("every"), F.array(cut(F.lit(0), F.col("blocks")))).otherwise(
        F.array(cut(F.lit(0), past), cut(F.col("start"), F.least(F.col("start") + F.col("more"), F.col("blocks")))))
    turns = turns.withColumn("spans", F.filter(spans, lambda s: s["b"] > s["a"])).where(F.size("spans") > 0)
    whole = (F.col("spans")[0]["a"] == 0) & (F.col("spans")[0]["b"] == F.col("size"))
    words = F.regexp_extract_all(F.col("row.text"), F.lit(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"), F.lit(0))
    parts = F.transform("spans", lambda s: F.array_join(F.slice(words, (s["a"] + 1).cast("int"), (s["b"] - s["a"]).cast("int")), ""))
    turns = turns.withColumn("given", F.when(whole, F.col("row.text")).otherwise(F.array_join(parts, "")))
    new = {"text": F.col("given"), "n_chars": F.length("given").cast("long")}
    return turns.select(*[new.get(c, F.col("row")[c]).alias(c) for c in names])
