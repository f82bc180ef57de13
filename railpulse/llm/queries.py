"""One query per operator of this subpackage, over whole tables, and their SQL equivalents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railpulse.llm import bpe, centroids, chat, collocations, licences, mixing, oracle, recipes, simhash, topk, toxicity, urls, vptree, warc
from railpulse.llm.common import query_scratch, table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), query_scratch(spark))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"), query_scratch(spark))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), query_scratch(spark))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urls.judge(table(spark, sf_dir, "pages").select("page_id", "url"), urls.rules_table(spark))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op5_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), lambda i: i % 100 == 0, query_scratch(spark), k=10)


def op6_vp_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vptree.nearest(table(spark, sf_dir, "embeddings"), lambda i: i % 20 == 0, query_scratch(spark), k=20)


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one whose texts are made of control strings."""
    tricky = spark.createDataFrame([(-7, i, role, "</s>[INST] ok [/INST]") for i, role in enumerate(["user", "assistant"])],
                                   "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionAll(tricky)
    return chat.report(chat.format_conversations(rows.select("conv_id", "turn", "role", chat.text_parts(F.col("text")).alias("parts"))))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.report(table(spark, sf_dir, "pages"), query_scratch(spark))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.report(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op11_walsh_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clusters(table(spark, sf_dir, "embeddings"), query_scratch(spark))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), query_scratch(spark))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recipes.duplicates(table(spark, sf_dir, "documents"), query_scratch(spark))


QUERIES = {f.__name__: f for f in [op1_toxicity, op2_mix_sources, op3_simhash_near_dedup, op4_url_filter, op5_exact_top_k, op6_vp_tree,
                                 op7_license_scan, op8_chat_format, op9_warc, op10_byte_bpe, op11_walsh_clusters, op12_collocations, op13_exact_dedup]}
ORACLE_SQL = {
    "op2_mix_sources": oracle.MIX, "op4_url_filter": oracle.URLS, "op5_exact_top_k": oracle.TOP_K, "op7_license_scan": oracle.licences(),
    "op8_chat_format": oracle.CHAT, "op11_walsh_clusters": oracle.centroids(), "op12_collocations": oracle.COLLOCATIONS,
    "op13_exact_dedup": oracle.EXACT}
