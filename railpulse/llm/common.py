"""What several operators share: words, tables of the queries, the scratch folder of a query."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railpulse.session import Scratch

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words of a text; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


STEPS = 64


def most_met(rows: DataFrame, count: str, limit: int) -> tuple[Column, bool]:
    """A condition that holds for the rows with the largest ``count``, ``limit`` of them at most, and whether it holds for all.

    The cut lies between steps of a 64th of a power of two, found from how many rows each step has; so no task and
    no driver meets more rows than it asks for, and rows of one step stay together.
    """
    step = F.floor(F.log2(F.col(count)) * STEPS)
    sizes = sorted(((r.step, r.n) for r in rows.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True)
    held, least = 0, None
    for at, n in sizes:
        if held + n > limit:
            return (step >= least if least is not None else F.lit(False)), False
        held, least = held + n, at
    return F.lit(True), True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query_scratch(spark: SparkSession) -> Scratch:
    """A scratch folder below ``spark.checkpoint.dir``.

    The lazy result of a query still reads it, so it is left to the owner of that folder. Only a
    local session without that setting, as in tests, gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="railpulse-llm-"))
    return Scratch(spark)
