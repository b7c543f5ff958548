"""Parquet tables, and tables that are kept in versions."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from litscreen import schemas


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    files, hadoop_path = file_system(spark, path)
    return files.exists(hadoop_path)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder; none if it is missing."""
    files, hadoop_path = file_system(spark, path)
    if not files.exists(hadoop_path):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(hadoop_path))


def partition_folders(spark: SparkSession, path: str, levels: int) -> list[str]:
    """Folders ``column=value`` so many levels below ``path``, relative to it."""
    found = [""]
    for _ in range(levels):
        found = [f"{f}/{n}" for f in found for n in names_in(spark, path + f) if "=" in n and n[0] not in "._"]
    return [f.lstrip("/") for f in found]


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file that must not be there yet. False if it is: then somebody else was first."""
    files, hadoop_path = file_system(spark, path)
    try:
        stream = files.create(hadoop_path, False)
    except Py4JJavaError:
        if files.exists(hadoop_path):
            return False
        raise
    stream.write(text.encode())
    stream.close()
    return True


def read_small(spark: SparkSession, path: str) -> str:
    """The content of a small file."""
    files, hadoop_path = file_system(spark, path)
    stream = files.open(hadoop_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


COMMITS = "_commits"


def versions(spark: SparkSession, path: str) -> list[int]:
    """The committed versions of a table, oldest first; what was written but not committed does not count."""
    return sorted(int(n) for n in names_in(spark, f"{path}/{COMMITS}") if n.isdigit())


def version_folder(spark: SparkSession, path: str, version: int) -> str:
    """Where the rows of a version are: its commit names the folder."""
    return f"{path}/{read_small(spark, f'{path}/{COMMITS}/{version}')}"


def read_version(spark: SparkSession, path: str, schema: T.StructType, version: int | None = None) -> DataFrame:
    """A version of a table, as a rule the newest one; an empty table if there is none."""
    known = versions(spark, path)
    if not known:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(version_folder(spark, path, version or known[-1]))


def read_run_state(spark: SparkSession, path: str) -> DataFrame:
    """The day of the last good fetch of each query. No row: never fetched."""
    return read_version(spark, path, schemas.RUN_STATE)


def read_appended(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table that is appended to; an empty table before the first write."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """Landed articles. Folder names stay texts, also where they look like numbers."""
    return read_appended(spark, path, schemas.ARTICLES_RAW)


def read_bodies(spark: SparkSession, path: str) -> DataFrame:
    return read_appended(spark, path, schemas.BODIES)


def read_abstracts_table(spark: SparkSession, path: str) -> DataFrame:
    return read_appended(spark, path, schemas.ABSTRACTS)
