"""WARC archives: a deterministic sharded writer, and a reader.

Records are range-sorted by page_id into shards whose bounds come from exact byte counts, so they
depend on the rows alone. A shard's task goes through its rows in order, makes header, digest and
one gzip member for each record, and starts a new file once the compressed size reaches
``roll_bytes``. Files are written under temporary names, which a written list of parts holds; the commit
renames those listed, writes the manifest, and removes what lost tasks have left.

Payloads are shuffled once. Which record a payload belongs to is settled on narrow rows beforehand
and travels to the shards as directory rows, sorted just before the records they speak of.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow.fs as fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railpulse.session import Scratch

ROLL_BYTES = 256 << 20
LEAST_SHARD, MOST_SHARD, SHARDS = 16 << 20, 1 << 30, 1_000
BUCKETS = 4_096
# Rows of a shard: directory rows for a payload whose response may be here, and for one whose is not, come before records.
FOLLOW, LEAD, RECORD = -1, 0, 1
LEVEL = 6
PART = "shard long, no int, temporary string, final string, records long, bytes long, sha1 string"


def storage(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI, as tasks without a JVM reach it, and the path within."""
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1)) if ":/" in path else (fs.LocalFileSystem(), path)


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, url: str | None, payload: bytes, refers_to) -> bytes:
    """One record; for a revisit (``refers_to`` given as a tuple) without its payload.

    The name of a record follows from its content, and the date is fixed, so bytes never change
    from one run to another.
    """
    digest, revisit = base32_sha1(payload), refers_to is not None
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"{page_id}:{digest}:{revisit}")
    clean = "".join(c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode()) for c in url or "")
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:uuid:{name}>",
             "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Target-URI: {clean}", f"WARC-Payload-Digest: sha1:{digest}",
             f"WARC-Page-Id: {'' if page_id is None else page_id}", f"WARC-Payload-Length: {len(payload)}"]
    body = b"" if revisit else payload
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To-Page: {'' if refers_to[0] is None else refers_to[0]}"]
    lines += ["Content-Type: text/html; charset=utf-8", f"WARC-Block-Digest: sha1:{base32_sha1(body)}", f"Content-Length: {len(body)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class _Files:
    """The files of one shard, rolled by compressed size."""

    def __init__(self, folder: str, shard: int, roll_bytes: int):
        self.store, self.folder = storage(folder)
        self.shard, self.roll, self.no, self.out, self.parts = shard, roll_bytes, 0, None, []

    def add(self, data: bytes) -> None:
        if self.out is None:
            final = f"part-{self.shard:08d}-{self.no:05d}.warc.gz"
            self.names, self.size, self.records = (f"{final}.{uuid.uuid4().hex}.tmp", final), 0, 0
            self.sum, self.out = hashlib.sha1(), self.store.open_output_stream(f"{self.folder}/{self.names[0]}", compression=None)
        packed = member(data)
        self.out.write(packed)
        self.sum.update(packed)
        self.size, self.records = self.size + len(packed), self.records + 1
        if self.size >= self.roll:
            self.close()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.parts.append((self.shard, self.no, *self.names, self.records, self.size, self.sum.hexdigest()))
            self.out, self.no = None, self.no + 1


def _write(folder: str, roll_bytes: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, about, original, first = None, None, None, True
        for batch in batches:
            # Of the columns shard, page_id, digest, kind, url, payload, original.
            for shard, page, digest, kind, url, payload, refers in zip(*(batch[c].array for c in batch.columns)):
                if files is None or files.shard != shard:
                    if files:
                        files.close()
                        yield pd.DataFrame(files.parts, columns=[c.split()[0] for c in PART.split(", ")])
                    files = _Files(folder, int(shard), roll_bytes)
                page = None if pd.isna(page) else int(page)
                if kind != RECORD:
                    about, original, first = (page, digest), None if pd.isna(refers) else int(refers), kind == LEAD
                    continue
                revisit = about == (page, digest) and not (page == original and first)
                if about == (page, digest):
                    first = False
                files.add(record(page, url, bytes(payload), (original,) if revisit else None))
        if files:
            files.close()
            yield pd.DataFrame(files.parts, columns=[c.split()[0] for c in PART.split(", ")])

    return run


def _bucket(low: int, width: int) -> Column:
    """The range of a page id; -1 without one. In decimals, since two ids may lie further apart than a long reaches."""
    return F.coalesce(F.expr(f"(cast(page_id as decimal(20, 0)) - ({low})) div {width}"), F.lit(-1).cast("long"))


def shard_bounds(narrow: DataFrame, shard_bytes: int | None = None) -> tuple[DataFrame, DataFrame | None, int, int, int]:
    """``(bucket, cut, parts)`` for each range of page ids, and ``(page_id, digest, h_cut, h_parts)`` for each hot
    group or None without one; the width of a range, the lowest id, the number of shards.

    Ranges of equal width are counted exactly and put together up to ``shard_bytes``; a range that is
    larger by itself is parted by page_id and digest. Rows alike in both that are together larger than a shard are a hot group
    and get shards of their own; only ranges too large for one shard are looked through for them, and there are no more
    of them than shards. By default about ``SHARDS`` shards, none below
    ``LEAST_SHARD`` or above ``MOST_SHARD``.
    """
    bytes_ = F.col("bytes") + 512
    low, high, total = narrow.agg(F.min("page_id"), F.max("page_id"), F.sum(bytes_)).first()
    low, width = low or 0, max(1, -(-((high or 0) - (low or 0) + 1) // BUCKETS))
    held = dict(map(tuple, narrow.groupBy(_bucket(low, width).alias("bucket")).agg(F.sum(bytes_)).collect()))
    most = shard_bytes or min(MOST_SHARD, max(LEAST_SHARD, (total or 0) // SHARDS))
    hot = []
    if wide := [number for number, size in held.items() if size > most]:
        groups = narrow.withColumn("bucket", _bucket(low, width)).where(F.col("bucket").isin(wide)).groupBy("page_id", "digest", "bucket")
        hot = groups.agg(F.sum(bytes_).alias("held")).where(F.col("held") > most).orderBy("page_id", "digest").collect()
    for row in hot:
        held[row.bucket] -= row.held
    bounds, shard, size = [], 0, 0
    for number, own in sorted(held.items()):
        parts = max(1, -(-own // most))
        if size and (size + own > most or parts > 1):
            shard, size = shard + 1, 0
        bounds.append((number, shard, parts))
        shard, size = (shard + parts, 0) if parts > 1 else (shard, size + own)
    shard += 1 if size or not shard else 0
    lone = []
    for row in hot:
        lone.append((row.page_id, row.digest, shard, -(-row.held // most)))
        shard += lone[-1][-1]
    spark = narrow.sparkSession
    return (spark.createDataFrame(bounds, "bucket long, cut long, parts long"),
            spark.createDataFrame(lone, "page_id long, digest string, h_cut long, h_parts long") if lone else None, width, low, max(1, shard))


def write_archives(pages: DataFrame, folder: str, scratch: Scratch, roll_bytes: int = ROLL_BYTES, shard_bytes: int | None = None,
                   least_revisit: int = 0) -> DataFrame:
    """Write ``pages(page_id, url, html)`` as WARC files below ``folder``; returns the manifest.

    Of rows with equal payloads of at least ``least_revisit`` bytes, that with the largest page_id is
    the response, the others revisit it; equal rows too, of which the first is the response. A null
    html is an empty payload; a null page_id sorts first, and is the response only among its like; in a group larger than a shard the first is that of one of its
    shards. A task writes one shard. The
    folder must be shared and new. An empty table gives an empty manifest. Other columns are ignored.
    """
    payload = F.coalesce(F.col("html").cast("binary"), F.lit("").cast("binary"))
    full = pages.select("page_id", "url", payload.alias("payload")).withColumn("digest", F.sha1("payload"))
    narrow = scratch.save(full.select("page_id", "digest", F.octet_length("payload").cast("long").alias("bytes")), "narrow")
    bounds, hot, width, low, shards = shard_bounds(narrow, shard_bytes)

    def dealt(rows: DataFrame) -> DataFrame:
        place = F.pmod(F.xxhash64("page_id", "digest"), F.col("parts"))
        return rows.withColumn("bucket", _bucket(low, width)).join(F.broadcast(bounds), "bucket").withColumn("shard", F.col("cut") + place)

    def of_group(rows: DataFrame, how: str) -> DataFrame:
        groups = F.broadcast(hot.withColumnRenamed("page_id", "h_page").withColumnRenamed("digest", "h_digest"))
        return rows.join(groups, F.col("page_id").eqNullSafe(F.col("h_page")) & (F.col("digest") == F.col("h_digest")), how)

    shared = narrow.where(F.col("bytes") >= least_revisit).groupBy("digest").agg(F.max("page_id").alias("original"), F.count("*").alias("n")).where("n > 1")
    told = narrow.join(shared, "digest").select("page_id", "digest", "original").distinct()
    binary, text = F.lit(None).cast("binary"), F.lit(None).cast("string")
    directory = [F.col("shard"), F.col("page_id"), F.col("digest"), F.lit(LEAD).alias("kind"), text.alias("url"), binary.alias("payload"), F.col("original")]
    records = [F.col("shard"), F.col("page_id"), F.col("digest"), F.lit(RECORD).alias("kind"), F.col("url"), F.col("payload"),
               F.lit(None).cast("long").alias("original")]
    if hot is None:
        rows = dealt(told).select(directory).unionAll(dealt(full).select(records))
    else:
        # Hot rows are written down once, so that their numbers stay; they go round the shards of their group. The shard of
        # its first row has the response, if any, and the directory rows of the others say so.
        numbered = scratch.save(of_group(full, "inner").withColumn("number", F.monotonically_increasing_id()), "hot")
        numbered = numbered.withColumn("turn", F.pmod(F.col("number"), F.col("h_parts")))
        first = numbered.groupBy("page_id", "digest").agg(F.min_by("turn", "number").alias("first"))
        first = F.broadcast(first.withColumnRenamed("page_id", "f_page").withColumnRenamed("digest", "f_digest"))
        turns = of_group(told, "inner").join(first, F.col("page_id").eqNullSafe(F.col("f_page")) & (F.col("digest") == F.col("f_digest")))
        turns = turns.withColumn("turn", F.explode(F.sequence(F.lit(0).cast("long"), F.col("h_parts") - 1))).withColumn("shard", F.col("h_cut") + F.col("turn"))
        kind = F.when(F.col("turn") == F.col("first"), LEAD).otherwise(FOLLOW).alias("kind")
        rows = (dealt(of_group(told, "left_anti")).select(directory)
                .unionAll(dealt(of_group(full, "left_anti")).select(records))
                .unionAll(turns.select([kind if i == 3 else c for i, c in enumerate(directory)]))
                .unionAll(numbered.withColumn("shard", F.col("h_cut") + F.col("turn")).select(records)))
    store, path = storage(folder)
    store.create_dir(path, recursive=True)
    # As text: pandas holds numbers with nulls among them as doubles, which round ids above 2^53.
    ids = {name: F.col(name).cast("string") for name in ("page_id", "original")}
    parts = scratch.save(rows.repartitionById(shards, F.col("shard").cast("int")).sortWithinPartitions("shard", "page_id", "digest", "kind", "url").withColumns(ids)
                         .mapInPandas(_write(folder, roll_bytes), PART), "parts")
    return commit(parts, folder, scratch)


def commit(parts: DataFrame, folder: str, scratch: Scratch) -> DataFrame:
    """Give the files that ``parts`` lists their names, write the manifest, drop other temporary files."""

    def rename(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, path = storage(folder)
        for batch in batches:
            for old, new in zip(batch["temporary"], batch["final"]):
                # A repeated task finds its files renamed already.
                if store.get_file_info(f"{path}/{old}").type != fs.FileType.NotFound:
                    store.move(f"{path}/{old}", f"{path}/{new}")
            yield batch

    done = scratch.save(parts.mapInPandas(rename, PART), "renamed")
    done.select(F.col("final").alias("file"), "records", "bytes", "sha1").orderBy("file").write.json(f"{folder}/MANIFEST")
    store, path = storage(folder)
    for info in store.get_file_info(fs.FileSelector(path)):
        if info.path.endswith(".tmp"):
            store.delete_file(info.path)
    return done.withColumnRenamed("final", "file").drop("temporary")


def members(stream, step: int = 1 << 20) -> Iterator[bytes]:
    """The members of a gzip file, one after the other."""
    unpacker, out, rest = zlib.decompressobj(31), [], b""
    while data := rest or stream.read(step):
        out.append(unpacker.decompress(data))
        rest = b""
        if unpacker.eof:
            yield b"".join(out)
            rest, unpacker, out = unpacker.unused_data, zlib.decompressobj(31), []
    if out:
        raise ValueError("the file ends within a record")


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """``page_id, url, record_type, payload_digest, payload_bytes, refers_to, payload`` of all records.

    Reads the files of the manifest. A damaged block fails the read; a revisit's payload is null.
    """
    files = spark.read.schema("file string, records long, bytes long, sha1 string").json(f"{folder}/MANIFEST")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, path = storage(folder)
        for batch in batches:
            for name in batch["file"]:
                held, size = [], 0
                with store.open_input_stream(f"{path}/{name}", compression=None) as stream:
                    for data in members(stream):
                        held.append(parse(data))
                        size += len(data)
                        if size > 8 << 20:
                            yield pd.DataFrame(held)
                            held, size = [], 0
                if held:
                    yield pd.DataFrame(held)

    return files.select("file").repartition(max(1, min(4_096, files.count())), "file").mapInPandas(
        read, "page_id long, url string, record_type string, payload_digest string, payload_bytes long, refers_to long, payload binary")


def parse(data: bytes) -> dict:
    head, _, body = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    body = body[:int(fields["Content-Length"])]
    if fields["WARC-Block-Digest"] != f"sha1:{base32_sha1(body)}":
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    number = lambda name: int(fields[name]) if fields.get(name) else pd.NA
    revisit = fields["WARC-Type"] == "revisit"
    return {"page_id": number("WARC-Page-Id"), "url": fields["WARC-Target-URI"], "record_type": fields["WARC-Type"],
            "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"), "payload_bytes": number("WARC-Payload-Length"),
            "refers_to": number("WARC-Refers-To-Page") if revisit else pd.NA, "payload": None if revisit else body}


def report(pages: DataFrame, scratch: Scratch, **options) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to``, read back from the archives."""
    folder = scratch.place("warc")
    write_archives(pages, folder, scratch, **options)
    return read_archives(pages.sparkSession, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
