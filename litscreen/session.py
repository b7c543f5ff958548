"""Session for tests and benchmarks, and the shared folder of a cluster."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, name: str = "litscreen") -> SparkSession:
    """A small local session. On a cluster the caller brings their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below the one that the cluster names in ``spark.checkpoint.dir``.

    A folder of this machine is used in local mode only; elsewhere the setting is needed.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="litscreen-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


MOST_SPREAD = 64  # splits from which on a table counts as large


def spread(df: DataFrame) -> DataFrame:
    """Use all cores where a scan has fewer splits than there are cores.

    Costly row work on a file with one row group would run in one task. A large table has
    more splits than that and passes through without a shuffle, whatever the cluster has. For
    scans only.
    """
    cores = min(MOST_SPREAD, df.sparkSession.sparkContext.defaultParallelism)
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def _write_and_read(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialise(df: DataFrame, purpose: str) -> DataFrame:
    """Write a result to the shared folder and read it back.

    Cuts the lineage where a result is used more than once, and lets Spark know its true
    size, so that it is broadcast only if it is small.
    """
    return _write_and_read(df, shared_folder(df.sparkSession, purpose))


class Staging:
    """Materialised tables of one job, removed when it is over: ``with Staging() as staging``."""

    def __init__(self):
        self._written: list[tuple[SparkSession, str]] = []

    def __enter__(self) -> Staging:
        return self

    def _folder(self, spark: SparkSession, purpose: str) -> str:
        path = shared_folder(spark, purpose)
        self._written.append((spark, path))
        return path

    def materialise(self, df: DataFrame, purpose: str) -> DataFrame:
        return _write_and_read(df, self._folder(df.sparkSession, purpose))

    def write(self, df: DataFrame, purpose: str, partitions: list[str]) -> str:
        """Write a table in partitions; returns its folder."""
        path = self._folder(df.sparkSession, purpose)
        df.write.partitionBy(*partitions).parquet(path)
        return path

    def __exit__(self, *error) -> None:
        for spark, path in self._written:
            hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
            hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)
