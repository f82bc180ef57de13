"""URL filters in the manner of hashed block lists.

Every distinct URL expands into host-suffix and path-prefix expressions. An equi-join on a short
hash prefix finds the rules that may fit, the full digest confirms them, and the most specific
rule (longest host, then longest path) decides. A URL that no rule fits is allowed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PREFIX_DIGITS = 8

RESULT = ("host", "path", "rule", "verdict", "#url")
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(rest, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rules_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(rules, "verdict string, host string, path string")


def _keyed(frame: DataFrame, expression: Column) -> DataFrame:
    return frame.withColumn("digest", F.sha2(expression, 256)).withColumn("short", F.substring("digest", 1, PREFIX_DIGITS))


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """``pages`` (all columns) with ``host, path, rule, verdict`` of ``url``; columns of those names, in any case, are replaced.

    ``rules(verdict, host, path)``: of equal rules, ``block`` goes before ``allow``; rules without a
    host or path (null or empty host, null path) fit nothing. A null URL and one without ``://`` have
    an empty host and path, and the default verdict. Work per URL is the number of its host's
    labels times the number of different path lengths among the rules. Hot URLs and hot
    expressions only meet in equi-joins, which AQE splits; no side is broadcast but by its size.
    """
    pages = pages.select(*[F.col(f"`{c}`") for c in pages.columns if c.lower() not in RESULT])
    rules = rules.where("host <> '' and path is not null").groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    lengths = sorted(r[0] for r in rules.select(F.length("path")).distinct().collect())
    urls = pages.select("url").where("url is not null").distinct().select("url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    prefixes = F.filter(F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths] or [F.lit(None).cast("string")]), lambda p: p.isNotNull())
    # A NUL ends the host, so no two pairs of host and path make the same expression.
    made = urls.where("host <> ''").select("url", F.explode(suffixes).alias("suffix"), prefixes.alias("prefixes"))
    made = made.select("url", "suffix", F.explode("prefixes").alias("prefix"))
    made = _keyed(made, F.concat("suffix", F.lit("\0"), "prefix")).select("url", "digest", "short")
    known = _keyed(rules, F.concat("host", F.lit("\0"), "path")).select(
        F.col("digest").alias("full"), "short", F.col("verdict"), F.concat("host", "path").alias("rule"),
        F.length("host").alias("host_length"), F.length("path").alias("path_length"))
    found = made.join(known, "short").where("digest = full")
    best = found.groupBy("url").agg(F.max(F.struct("host_length", "path_length", "rule", "verdict")).alias("best"))
    best = best.select(F.col("url").alias("#url"), F.col("best.rule").alias("rule"), F.col("best.verdict").alias("verdict"))
    return (pages.join(best, F.col("url") == F.col("#url"), "left").drop("#url")
            .withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url")), "verdict": F.coalesce("verdict", F.lit(default))}))
