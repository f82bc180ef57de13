"""The trusted and client zones as files."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from railpulse.schemas import EVENT_TIME, TIME_FORMAT

# The day folders of trusted rows.
DAY = "trusted_day"


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with a header, replacing what is there.

    Timestamps left by ``clean_typed`` are written in the zones' text form. ``single_file`` sends
    all rows through one task: for small extracts only.
    """
    out = df.coalesce(1) if single_file else df
    (out.write.mode("overwrite").option("header", True)
        .option("timestampFormat", TIME_FORMAT).csv(path))


class Zones:
    """Folders of a deployment: ``trusted/<family>``, ``client/<family>``, ``tables/<name>``.

    Each run writes to a folder of its own batch, so running a batch again replaces its output.
    ``buckets`` is the number of key buckets that new fact tables get. With ``days`` trusted rows of families with an
    event time lie in folders of its day within their batch; a zone is laid out one way from its first batch on.
    """

    def __init__(self, root: str, buckets: int = 16, days: bool = False):
        self.root = root.rstrip("/")
        self.buckets = buckets
        self.days = days

    def trusted(self, family: str, batch: int | None = None) -> str:
        return _batch(f"{self.root}/trusted/family={family}", batch)

    def client(self, family: str, batch: int | None = None) -> str:
        return _batch(f"{self.root}/client/{family}", batch)

    def table(self, name: str) -> str:
        return f"{self.root}/tables/{name}"

    def occupancy(self) -> str:
        """The occupancy extract is one snapshot, a versioned table of CSV that every ToF run replaces."""
        return f"{self.root}/client/ocupacao"

    def rejects(self, family: str, batch: int) -> str:
        return _batch(f"{self.root}/rejects/{family}", batch)

    def misfits(self, family: str, batch: int | None = None) -> str:
        """Rows with values that do not fit the family's types."""
        return _batch(f"{self.root}/misfits/{family}", batch)

    def kinds(self, family: str, batch: int | None = None) -> str:
        """The kinds of the columns of a batch whose files may have any header."""
        return _batch(f"{self.root}/kinds/{family}", batch)

    def outcomes(self, batch: int | None = None) -> str:
        """What became of each raw file that a routed ingest has met."""
        return _batch(f"{self.root}/outcomes", batch)

    def owner(self, family: str, batch: int | None = None) -> str:
        """The small file that says who wrote a batch."""
        return _batch(f"{self.root}/owners/{family}", batch)


class BatchTaken(ValueError):
    """The number of a batch belongs to another writer."""


def claim_batch(spark: SparkSession, zones: Zones, family: str, batch: int, owner: str) -> None:
    """Take a batch number for ``owner``, or raise if another one has it: only the writer of a
    batch may replace it."""
    place = zones.owner(family, batch)
    holder = read_note(spark, place)
    if holder is None:
        write_note(spark, place, owner)
    elif holder != owner:
        raise BatchTaken(f"batch {batch} of {family} was written by {holder}, not by {owner}")


def next_batch(spark: SparkSession, zones: Zones, family: str) -> int:
    """The number after the highest that any writer of the family has taken."""
    folder, store = stored(spark, zones.owner(family))
    if not store.exists(folder):
        return 0
    names = [status.getPath().getName() for status in store.listStatus(folder)]
    return max((int(name.partition("=")[2]) + 1 for name in names if name.startswith("batch=")), default=0)


def drop_batch(spark: SparkSession, zones: Zones, family: str, batch: int, table: str | None) -> None:
    """Remove what a batch has written, but for its owner."""
    places = [zones.trusted(family, batch), zones.client(family, batch), zones.rejects(family, batch), zones.misfits(family, batch),
              zones.kinds(family, batch)]
    for path in [*places, *([_batch(zones.table(table), batch)] if table else [])]:
        place, store = stored(spark, path)
        store.delete(place, True)


def read_note(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, or None where there is none."""
    place, store = stored(spark, path)
    if not store.exists(place):
        return None
    stream = store.open(place)
    try:
        return stream.readUTF()
    finally:
        stream.close()


def write_note(spark: SparkSession, path: str, text: str) -> None:
    """A small new file; fails if it is there."""
    place, store = stored(spark, path)
    stream = store.create(place, False)
    stream.writeUTF(text)
    stream.close()


def stored(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _batch(folder: str, batch: int | None) -> str:
    return folder if batch is None else f"{folder}/batch={batch:09d}"


def write_trusted(df: DataFrame, zones: Zones, family: str, batch: int) -> tuple[DataFrame, int]:
    """Cleaned rows as parquet; returns them as read back, with the timestamps still typed, and
    their number.

    Day folders cost one shuffle, which gathers the rows of a day and splits a large one, so that a batch of any order
    writes few files. Only this batch's files are replaced.
    """
    path = zones.trusted(family, batch)
    counted = Observation()
    rows = df.observe(counted, F.count(F.lit(1)).alias("rows_kept"))
    if not by_day(zones, family):
        rows.write.mode("overwrite").parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path), counted.get["rows_kept"]
    if DAY in df.columns:
        raise ValueError(f"{DAY} is the name of the day folders, and of a column of the {family} readings")
    dealt = rows.withColumn(DAY, F.to_date(F.col(EVENT_TIME[family]))).hint("rebalance", F.col(DAY))
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(DAY).parquet(path)
    schema = StructType([*df.schema, StructField(DAY, DateType())])
    written = df.sparkSession.read.schema(schema).parquet(path).drop(DAY)
    return written, observed(counted, written, rows_kept=F.count(F.lit(1)))["rows_kept"]


def observed(counted: Observation, rows: DataFrame, **measures: Column) -> dict:
    """What an observation has counted. Where a shuffle turns out to carry no rows, Spark drops what lies before it from
    the plan, and with it the figures: then they are taken from ``rows``."""
    try:
        return counted.get
    except Py4JJavaError:
        # All columns are used, since a raw file cannot be read for its misfits alone.
        whole = F.max(F.xxhash64(*[F.col(f"`{name}`") for name in rows.columns])).alias("_whole")
        return rows.agg(whole, *[measure.alias(name) for name, measure in measures.items()]).first().asDict()


def by_day(zones: Zones, family: str) -> bool:
    return zones.days and family in EVENT_TIME


def read_days(spark: SparkSession, zones: Zones, family: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """Trusted rows of the days from ``first`` to ``last`` (``yyyy-MM-dd``, both included; None: no bound), with ``batch``
    and ``trusted_day``. Folders of other days are not listed as files to read."""
    if not by_day(zones, family):
        raise ValueError(f"{family} is not laid out by day")
    rows, day = spark.read.parquet(zones.trusted(family)), F.col(DAY)
    if first is not None:
        rows = rows.where(day >= F.lit(first).cast("date"))
    return rows if last is None else rows.where(day <= F.lit(last).cast("date"))


def write_client(df: DataFrame, zones: Zones, family: str, batch: int) -> None:
    write_csv(df, zones.client(family, batch))
