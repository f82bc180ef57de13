"""A corpus from raw documents to token ids: toxic texts out, one of each near-duplicate group kept,
sources mixed to their weights, the rest encoded.

Each stage takes ``(spark, docs, sf_dir)``; what it returns is written and read again as the next
one's ``docs``. All but the last return the columns of ``documents``. The first stage learns from
``labels``, so no SQL gives the rows of the whole.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railpulse.llm import bpe, mixing, simhash, toxicity
from railpulse.llm.common import query_scratch, table


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.5 stay."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"), query_scratch(spark))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by SimHash, that with the smallest doc_id stays."""
    return simhash.keep_one(docs, query_scratch(spark))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row holds the words that one turn of the mix takes from a document."""
    return mixing.mix_documents(docs, query_scratch(spark))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and the digest of what they decode to."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    both = bpe.encode_and_decode(docs, path, public_tokenizers.PATTERN)
    return both.select("doc_id", "lang", "source", "n_chars", bpe.token_count(F.col("coded.ids")).alias("n_tokens"), "coded.ids",
                       F.sha2("coded.decoded", 256).alias("decoded_sha256"))


STAGES = [("toxicity", toxic_out), ("near_dedup", one_of_each_group), ("mix", mixed), ("encode", encoded)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs, scratch = table(spark, sf_dir, "documents"), query_scratch(spark)
    for name, stage in STAGES[:-1]:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
