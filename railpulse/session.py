"""Session settings and the scratch folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


# For runs over many terabytes. Shuffles start out in many partitions, which AQE merges to the
# advised size; larger scan splits keep the number of map tasks, and with it that of shuffle blocks,
# within bounds.
CLUSTER_SETTINGS = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.files.maxPartitionBytes": "512m",
}


def build_session(name: str = "railpulse", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the operators count on.

    Timestamps are rendered and compared in UTC. Broadcasting is left to the planner, which
    checks the size of a side against ``spark.sql.autoBroadcastJoinThreshold`` and sorts and
    merges beyond it; AQE then splits skewed partitions of such a join.
    """
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Split hot sensors even where the next join on the same key then shuffles anew.
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``, reachable by every executor."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="railpulse-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


class Scratch:
    """Intermediate tables of one run, written to shared storage.

    A written table cuts the lineage and survives lost executors. It also carries true file
    sizes, from which the planner decides whether a side may be broadcast.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.path = f"{(folder or shared_folder(spark)).rstrip('/')}/run-{uuid.uuid4().hex}"
        self._tables = 0

    def place(self, name: str) -> str:
        """A path of its own for the next table called ``name``."""
        self._tables += 1
        return f"{self.path}/{self._tables:03d}-{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and read it back."""
        path = self.place(name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def close(self) -> None:
        """Remove this run's tables. Call it when no lazy result still reads them."""
        jvm = self.spark.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(self.path)
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        folder.getFileSystem(conf).delete(folder, True)

    def __enter__(self) -> "Scratch":
        return self

    def __exit__(self, *exc) -> None:
        self.close()
