"""Raw files as a stream: each file is taken once, in micro-batches."""

from __future__ import annotations

import uuid

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from railpulse.functions.routing import MARK_OF, key_within, root_of, route_family
from railpulse.plans.piezo import UnknownTrack
from railpulse.plans.runs import run_family, run_files
from railpulse.schemas import TABLE_OF, readings_schema
from railpulse.sinks.files import BatchTaken, Zones, claim_batch, drop_batch, next_batch, read_note, write_note
from railpulse.sources.dumps import Dimensions
from railpulse.sources.readings import HEADERS_AT_A_TIME, MISFIT, file_columns, header_of, read_readings, typed_header, with_misfits

FILES_PER_BATCH = 1000
# A file is new however old it is. The price: the checkpoint remembers every file ever taken.
MAX_FILE_AGE = "36500d"
# The name that outcomes of a routed ingest are numbered under.
ALL = "all-files"
OUTCOME = "path string, family string, outcome string, reason string"


def file_stream(spark: SparkSession, in_dir: str, family: str, schema=None,
                files_per_batch: int = FILES_PER_BATCH, misfits: bool = False) -> DataFrame:
    """New files of one family, at any depth below ``in_dir``.

    A file whose key below ``in_dir`` carries the family's mark is read, in its own name or in that
    of a folder. A key with several marks belongs to the family that comes first in the
    routing order. The test is on the path alone, so Spark drops the files of other families
    before it opens them; ``files_per_batch`` counts them all. Optical files have no fixed header,
    so their ``schema`` is to be given.
    """
    if schema is None:
        schema = readings_schema(family)
    if misfits:
        schema = with_misfits(StructType.fromDDL(schema) if isinstance(schema, str) else schema)
    key = key_within(F.col("source_file"), root_of(spark, in_dir))
    return (
        spark.readStream.schema(schema)
        .option("header", True).option("enforceSchema", False)
        .option("recursiveFileLookup", True).option("maxFilesPerTrigger", files_per_batch)
        .option("maxFileAge", MAX_FILE_AGE).option("columnNameOfCorruptRecord", MISFIT)
        .csv(in_dir)
        .select("*", *file_columns())
        .filter(route_family(key) == family)
    )


def start_all(spark: SparkSession, in_dir: str, dims: Dimensions, zones: Zones, checkpoint: str,
              optical_schema=None, **options) -> dict[str, StreamingQuery]:
    """One ingest per family, side by side, each with a checkpoint folder of its own.

    Optical files are taken when their schema is given.
    """
    schemas = {family: None for family in MARK_OF}
    if optical_schema is None:
        del schemas["optical"]
    else:
        schemas["optical"] = optical_schema
    return {
        family: start_ingest(spark, in_dir, family, dims, zones, f"{checkpoint.rstrip('/')}/{family}",
                             schema, **options)
        for family, schema in schemas.items()
    }


def start_ingest(spark: SparkSession, in_dir: str, family: str, dims: Dimensions, zones: Zones,
                 checkpoint: str, schema=None, files_per_batch: int = FILES_PER_BATCH,
                 trigger: dict | None = None, **options) -> StreamingQuery:
    """Run the family's plan on every micro-batch: until no new file is left, or by another
    ``trigger``, such as ``{"processingTime": "1 minute"}``.

    The checkpoint remembers which files are done. On a new checkpoint numbers start after the
    highest batch of the family in the zones. Both that number and the ingest's name are
    kept in the checkpoint, so a micro-batch that is repeated after a failure replaces its own
    output and no other.
    """
    first_batch, owner = _place(spark, family, zones, checkpoint)

    def run(rows: DataFrame, batch: int) -> None:
        numbered = rows.withColumn("source_row", F.monotonically_increasing_id())
        run_family(family, numbered, dims, zones, first_batch + batch, owner=owner, **options)

    return (
        file_stream(spark, in_dir, family, schema, files_per_batch, misfits=True).writeStream
        .foreachBatch(run).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )


def start_routed(spark: SparkSession, in_dir: str, dims: Dimensions, zones: Zones, checkpoint: str,
                 files_per_batch: int = FILES_PER_BATCH, trigger: dict | None = None, **options) -> StreamingQuery:
    """One ingest for all families: the inbox is listed once, and every file finds its own fate.

    The stream carries only the names of new files, ``files_per_batch`` at a time. In a micro-batch the files of each
    family run as one batch, each read by its own header. A file that cannot be taken, as it lacks
    columns, cannot be read, or has segments at unknown tracks, is set aside whole with the reason, and all others
    go on. ``zones.outcomes()`` tells for each file what became of it; only files without a byte are passed over. A failure that no file is to blame for stops the
    stream, and a micro-batch that is repeated replaces its own output. Optical files without numbers
    they share are better given to ``start_ingest`` with a schema.
    """
    root = root_of(spark, in_dir, encoded=False)
    notes = {family: _place(spark, family, zones, f"{checkpoint.rstrip('/')}/notes/{family}") for family in [*MARK_OF, ALL]}

    def run(files: DataFrame, batch: int) -> None:
        found = [(row.path, row.family) for row in files.collect()]
        outcomes = [(path, None, "no family", None) for path, family in found if family is None]
        for family in MARK_OF:
            paths = sorted(path for path, own in found if own == family)
            if paths:
                first, owner = notes[family]
                aside = run_each(spark, family, paths, dims, zones, first + batch, owner=owner, **options)
                outcomes += [(path, family, "set aside" if path in aside else "taken", aside.get(path)) for path in paths]
        first, owner = notes[ALL]
        claim_batch(spark, zones, ALL, first + batch, owner)
        spark.createDataFrame(outcomes, OUTCOME).coalesce(1).write.mode("overwrite").parquet(zones.outcomes(first + batch))

    listed = (spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary")
              .option("recursiveFileLookup", True).option("maxFilesPerTrigger", files_per_batch).option("maxFileAge", MAX_FILE_AGE)
              .load(in_dir).select("path", route_family(key_within(F.col("path"), root)).alias("family")))
    return (listed.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def run_each(spark: SparkSession, family: str, paths: list[str], dims: Dimensions, zones: Zones, batch: int, **options) -> dict[str, str]:
    """Run a family's files as one batch, without those that are at fault; returns these with the reason.

    Files are tried one by one only once a read has failed, by halves.
    """
    aside = {}
    if family != "optical":
        for path, reason in zip(paths, _unfit(spark, family, paths)):
            if reason:
                aside[path] = reason
    while good := [path for path in paths if path not in aside]:
        try:
            run_files(spark, family, good, dims, zones, batch, **options)
            return aside
        except BatchTaken:
            raise
        except UnknownTrack:
            blamed = _at_unknown_tracks(spark, good, zones.rejects(family, batch))
        except Exception:
            blamed = unreadable(spark, family, good)
            if not blamed:
                raise
        if not blamed:
            raise RuntimeError(f"segments at unknown tracks are of no file: {zones.rejects(family, batch)}")
        aside |= blamed
    drop_batch(spark, zones, family, batch, TABLE_OF.get(family))
    return aside


def _unfit(spark: SparkSession, family: str, paths: list[str]) -> list[str | None]:
    """Why the header of each file cannot be read by the family's contract, or None."""
    def reason(path: str) -> str | None:
        try:
            header = header_of(spark, path)
        except Exception as failed:
            return f"cannot be read: {_said(failed)}"
        try:
            if header:
                typed_header(list(header), family)
        except ValueError as lacking:
            return str(lacking)
        repeated = sorted({name for name in header if header.count(name) > 1})
        return f"repeats the columns {', '.join(repeated)}" if repeated else None

    with ThreadPoolExecutor(HEADERS_AT_A_TIME) as pool:
        return list(pool.map(reason, paths))


def _at_unknown_tracks(spark: SparkSession, paths: list[str], rejects: str) -> dict[str, str]:
    """The files that rejected segments came from, at most all files of the batch; ``paths`` as Spark lists them."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    named = spark.createDataFrame([(place(path).toUri().toString(), path) for path in paths], "uri string, path string")
    keyed = named.select("path", F.xxhash64("uri").alias("source_id"), F.xxhash64(F.lit(1), "uri").alias("source_id2"))
    found = spark.read.parquet(rejects).groupBy("source_id", "source_id2").agg(F.count(F.lit(1)).alias("n")).join(keyed, ["source_id", "source_id2"])
    return {row.path: f"segments at unknown tracks: {row.n}" for row in found.collect()}


def unreadable(spark: SparkSession, family: str, paths: list[str]) -> dict[str, str]:
    """The files that cannot be read to their end, with the reason."""
    try:
        read_readings(spark, paths, family, misfits=True).write.format("noop").mode("overwrite").save()
        return {}
    except Exception as failed:
        if len(paths) == 1:
            return {paths[0]: f"cannot be read: {_said(failed)}"}
    half = len(paths) // 2
    return unreadable(spark, family, paths[:half]) | unreadable(spark, family, paths[half:])


def _said(failed: Exception) -> str:
    return f"{type(failed).__name__}: {(str(failed).splitlines() or [''])[0][:300]}"


def _place(spark: SparkSession, family: str, zones: Zones, checkpoint: str) -> tuple[int, str]:
    """The first batch number of the ingest on this checkpoint, and its name."""
    note = f"{checkpoint.rstrip('/')}/railpulse-ingest"
    if read_note(spark, note) is None:
        write_note(spark, note, f"{next_batch(spark, zones, family)} ingest {uuid.uuid4().hex}")
    first, _, owner = read_note(spark, note).partition(" ")
    return int(first), owner
