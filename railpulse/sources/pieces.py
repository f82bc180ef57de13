"""Dumps of one large array, cut at item boundaries by many tasks.

A dump is read as text that ends at each ``}``, so Spark splits a file by byte range and no row holds more than the
text between two closing braces. Whether a piece starts within a quoted text, and how deep, follows from the
pieces before it: sums per block (one byte range of one file) are carried from block to block, and then on within each.
Only an item's own pieces are put together again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from railpulse.session import Scratch

BLOCK = ["file", "block"]
# Bytes of the mark that may begin a file, which readers leave out.
BYTE_MARK = 3
PACKED = r"\.(gz|bz2|zst|lz4|snappy|deflate)$"
# Outside texts: what stands before the first opening brace, with texts in it as a whole.
HEAD = r'^((?:[^"{]++|"[^"\\]*+(?:\\.[^"\\]*+)*+")*+)'


def _count(text: Column, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


def _opened(text: Column) -> Column:
    """Braces opened and brackets left open by a piece's characters outside texts."""
    plain = F.regexp_replace(text, r'"[^"]*("|$)', "")
    return F.struct(_count(plain, "{").alias("braces"), (_count(plain, "[") - _count(plain, "]")).alias("brackets"))


def read_pieces(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Pieces with their place, the parity of their quotes, and what they open if they start outside or within a text."""
    bare = F.regexp_replace("value", r"(?s)\\.", "")
    return (spark.read.option("lineSep", "}").text(path)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                    F.col("_metadata.file_size").alias("size"),
                    F.monotonically_increasing_id().alias("line"), "value")
            .select("*", (_count(bare, '"') % 2).alias("odd"), _opened(bare).alias("outside"),
                    _opened(F.regexp_replace(bare, r'^[^"]*("|$)', "")).alias("within"),
                    (F.trim(F.regexp_replace("value", r"\s", "")) == "").alias("blank"),
                    (F.instr("value", "\0") > 0).alias("wide")))


def _carried(blocks: DataFrame, total: str, start: str, most: bool = False) -> DataFrame:
    """``total`` of all blocks of the file before this one: their sum, or their greatest value."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    value = F.max(total).over(before) if most else F.coalesce(F.sum(total).over(before), F.lit(0))
    return blocks.select(*BLOCK, value.alias(start))


def with_depth(pieces: DataFrame) -> DataFrame:
    """Pieces with the braces open before them (``depth``) and what they add to braces and brackets."""
    before = Window.partitionBy(*BLOCK).orderBy("line").rowsBetween(Window.unboundedPreceding, -1)

    def until(name):
        return F.coalesce(F.sum(name).over(before), F.lit(0))

    parity = _carried(pieces.groupBy(*BLOCK).agg(F.sum("odd").alias("odds")), "odds", "start_odd")
    stated = pieces.join(parity, BLOCK).withColumn("in_text", (F.col("start_odd") + until("odd")) % 2 == 1)
    opened = F.when(F.col("in_text"), F.col("within")).otherwise(F.col("outside"))
    ends_in_text = F.col("in_text") != (F.col("odd") == 1)
    net = stated.withColumns({"braces": opened["braces"] - F.when(ends_in_text, 0).otherwise(1), "brackets": opened["brackets"]})
    blocks = net.groupBy(*BLOCK).agg(F.sum("braces").alias("all_braces"))
    return (net.join(_carried(blocks, "all_braces", "start_depth"), BLOCK)
            .withColumn("depth", F.col("start_depth") + until("braces")))


def sound_files(deep: DataFrame) -> DataFrame:
    """Each file and whether it closes what it opens.

    A reader does not tell if its last piece ended with a brace, so their sizes are held against the file's; of a packed
    file, whose codec finds a cut by itself, the last piece counts as closed unless it is blank and nothing is open.
    """
    last = F.max_by("blank", F.struct("block", "line"))
    sums = deep.groupBy("file").agg(F.sum("braces").alias("braces"), F.sum("brackets").alias("brackets"), last.alias("blank"),
                                    (F.sum(F.octet_length("value") + 1) - F.max("size")).alias("beyond"))
    closed = (F.col("braces") == 0) & F.col("beyond").isin(0, -BYTE_MARK)
    open_end = (F.col("braces") == -1) & F.col("blank") & F.col("beyond").isin(1, 1 - BYTE_MARK)
    of_packed = (F.col("braces") == 0) | (F.col("braces") == -1) & F.col("blank")
    ends = F.when(F.lower("file").rlike(PACKED), of_packed).otherwise(closed | open_end)
    return sums.select("file", ((F.col("brackets") == 0) & ends).alias("sound"))


def dump_items(pieces: DataFrame) -> DataFrame:
    """The items of ``Items`` as texts, with the ``file`` and the ``place`` (block, line) they start at.

    Other members of a dump may be values or objects, which are passed over. A file whose braces do not match, or
    that holds another array of objects, fails the read; one without items has no rows.
    """
    deep = with_depth(pieces)
    start = F.when(F.col("depth") <= 1, F.struct("block", "line", "depth"))
    marked = deep.withColumn("start", start)
    carried = _carried(marked.groupBy(*BLOCK).agg(F.max("start").alias("last")), "last", "carried", most=True)
    damaged = F.raise_error(F.concat(F.lit("damaged dump, braces or brackets do not match: "), "file")).cast("boolean")
    whole = sound_files(deep).select("file", F.when(F.col("sound"), True).otherwise(damaged).alias("sound"))
    so_far = Window.partitionBy(*BLOCK).orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    owned = (marked.withColumn("own", F.max("start").over(so_far)).join(carried, BLOCK)
             .withColumn("item", F.coalesce("own", "carried")).join(whole, "file").where("sound"))
    parts = F.array_sort(F.collect_list(F.struct("block", "line", "value")))
    texts = (owned.groupBy("file", "item").agg(parts.alias("parts"))
             .select("file", F.struct("item.block", "item.line").alias("place"), F.col("item.depth").alias("depth"),
                     F.concat(F.array_join(F.transform("parts", lambda p: p["value"]), "}"), F.lit("}")).alias("text")))
    rest = F.when(F.col("depth") <= 0, F.regexp_replace("text", r"^[^{]*\{", "")).otherwise(F.col("text"))
    headed = texts.withColumn("rest", rest).withColumn("head", F.regexp_extract("rest", HEAD, 1))
    body = F.substr("rest", F.length("head") + 1)
    of_items = F.col("head").rlike(r'^\s*,\s*$|(^|[,{\s])"Items"\s*:\s*\[\s*$')
    other = F.raise_error(F.concat(F.lit("not an array of items in "), "file")).cast("boolean")
    kept = F.when(F.length(body) == 0, False).when(of_items, True).when(F.col("head").rlike(r':\s*$'), False).otherwise(other)
    return headed.where(kept).select("file", "place", body.alias("text"))


def split_items(spark: SparkSession, path: str | list[str], scratch: Scratch) -> tuple[DataFrame, list[str]]:
    """Items of all UTF-8 files, and the files in another encoding, which are not split. Pieces are written down once, so that
    all their sums speak of the same ones."""
    jvm, pieces = spark.sparkContext._jvm, scratch.save(read_pieces(spark, path), "dump-pieces")
    other = [row.file for row in pieces.where("wide").select("file").distinct().collect()]
    rows = pieces.where(~F.col("file").isin(other)) if other else pieces
    return dump_items(rows), [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file)).toString() for file in other]
