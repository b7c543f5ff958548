"""Tables: appended, upserted, or written in versions."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from litscreen import schemas, settings
from litscreen.operators.dedup import absent, first_per_key, latest_per_key
from litscreen.session import Staging
from litscreen.sources.tables import (
    COMMITS, create_once, exists, file_system, names_in, partition_folders, read_small, read_version, versions,
)


def _buckets(spark: SparkSession, path: str, wanted: int) -> int:
    """The number of hash buckets of a table. The first writer decides it, for good."""
    marker = f"{path}/_buckets"
    create_once(spark, marker, str(wanted))
    return int(read_small(spark, marker))


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _switch(spark: SparkSession, pending: str, path: str, levels: int) -> None:
    """Put the partitions of a complete table in the place of those of the same name.

    May be repeated from any point: a partition goes only when the one for its place is there.
    """
    files, _ = file_system(spark, path)
    place = spark._jvm.org.apache.hadoop.fs.Path
    for name in partition_folders(spark, pending, levels):
        target = place(f"{path}/{name}")
        files.mkdirs(target.getParent())
        files.delete(target, True)
        if not files.rename(place(f"{pending}/{name}"), target):
            raise OSError(f"cannot put {pending}/{name} in its place")
    files.delete(place(pending), True)


PENDING = "_pending-"


def _recover(spark: SparkSession, path: str, levels: int) -> None:
    """Finish the switch of a writer that was lost after its rows were complete; drop what was not."""
    for name in names_in(spark, path):
        if name.startswith(PENDING):
            pending = f"{path}/{name}"
            if exists(spark, f"{pending}/_SUCCESS"):
                _switch(spark, pending, path, levels)
            else:
                files, hadoop_path = file_system(spark, pending)
                files.delete(hadoop_path, True)


def _same_partitions(spark: SparkSession, path: str, other: str, levels: int, schema: T.StructType) -> DataFrame | None:
    """The rows of a table in those partitions that another table has as well; no other folder is listed or read."""
    shared = [f"{path}/{n}" for n in partition_folders(spark, other, levels) if exists(spark, f"{path}/{n}")]
    return spark.read.schema(schema).option("basePath", path).parquet(*shared) if shared else None


KEYS = ["query_folder", "id"]


def _keys_and_times(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).alias(f"_{c}") for c in (*KEYS, "fetched_at")])


def _same_key() -> Column:
    return reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in KEYS])


def _replaced() -> Column:
    """Whether a fetch takes the place of a landed one; a fetch without a time only that of one without."""
    neither = F.col("_fetched_at").isNull() & F.col("fetched_at").isNull()
    return neither | F.coalesce(F.col("_fetched_at") >= F.col("fetched_at"), F.col("_fetched_at").isNotNull())


def staying(landed: DataFrame, times: DataFrame) -> DataFrame:
    """The landed rows that no row of a batch replaces; ``times`` has the keys and times of the batch."""
    return landed.join(times, _same_key() & _replaced(), "left_anti")


def late(landed: DataFrame, times: DataFrame) -> DataFrame:
    """Keys of the batch whose landed rows are newer."""
    return _keys_and_times(landed.select(*KEYS, "fetched_at").join(times, _same_key() & ~_replaced(), "left_semi"))


def upsert_by_folder(new: DataFrame, path: str, schema: T.StructType, buckets: int = settings.TABLE_BUCKETS) -> None:
    """One row per query folder and id, the last fetch wins; of fetches at the same time the later batch.

    A folder is split by the hash of the id, and only the buckets that get something new are read and written again.
    Which rows win is decided on keys and times. Those of the batch are written out, so that Spark broadcasts them if
    they are few; contents that stay then go from their files to the new ones without a shuffle. The new buckets are
    written beside the table and put in place one by one; a writer that is lost meanwhile is made up for by the next
    one. A table has one writer at a time. An empty folder name and a missing one are the same folder, read as NULL.
    """
    spark, parts = new.sparkSession, ["query_folder", "bucket"]
    bucket = _bucket("id", _buckets(spark, path, buckets))
    _recover(spark, path, len(parts))
    named = new.withColumn("query_folder", F.nullif("query_folder", F.lit(""))).select(*schema.names)
    others = [F.col(c) for c in schema.names if c not in (*KEYS, "fetched_at")]
    newest = [F.col("fetched_at").desc(), F.xxhash64(*others)]
    stored = T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])
    pending = f"{path}/{PENDING}{uuid.uuid4().hex}"
    with Staging() as staging:
        latest = latest_per_key(named, KEYS, newest).withColumn("bucket", bucket)
        batch_path = staging.write(latest.hint("rebalance", *parts), "upsert", parts)
        merged = batch = spark.read.schema(stored).parquet(batch_path)
        landed = _same_partitions(spark, path, batch_path, len(parts), stored)
        if landed is not None:
            times = staging.materialise(_keys_and_times(batch), "times")
            # Few rows as a rule: keys whose landed rows stay although the batch has them.
            kept_out = staging.materialise(late(landed, times), "late")
            merged = staying(landed, times).unionByName(batch.join(kept_out, _same_key(), "left_anti"))
        merged.write.partitionBy(*parts).parquet(pending)
    _switch(spark, pending, path, len(parts))


def upsert_articles(new: DataFrame, path: str) -> None:
    """Land articles."""
    upsert_by_folder(new, path, schemas.ARTICLES_RAW)


def append_unseen(
    new: DataFrame, path: str, key: str, order: list[Column], buckets: int = settings.TABLE_BUCKETS
) -> None:
    """Append the first row of each key that the table does not hold yet.

    The table is split by the hash of the key: of a small batch only its own buckets are looked at, and of those only
    the keys. Running it again adds nothing, so a batch that failed half way may simply be repeated.
    """
    spark = new.sparkSession
    fresh = first_per_key(new, [key], order).withColumn("bucket", _bucket(key, _buckets(spark, path, buckets)))
    with Staging() as staging:
        batch_path = staging.write(fresh.hint("rebalance", "bucket"), "batch", ["bucket"])
        batch = spark.read.schema(fresh.schema).parquet(batch_path)
        known = _same_partitions(spark, path, batch_path, 1, fresh.schema)
        added = batch if known is None else absent(known, batch, key)
        added.write.mode("append").partitionBy("bucket").parquet(path)


def land_records(rows: DataFrame, root: str) -> None:
    """Rows as lines of JSON in folders that name the query, as many lines to a file as its size allows.

    Spark evens out the files to ``spark.sql.adaptive.advisoryPartitionSizeInBytes``: their number grows with the
    bytes, not with the rows, and a folder of any size is split. Binary content is written in base64.
    """
    rows.hint("rebalance", "query_folder").write.mode("append").partitionBy("query_folder").json(root)


def _commit(spark: SparkSession, path: str, version: int, folder: str) -> bool:
    return create_once(spark, f"{path}/{COMMITS}/{version}", folder)


def _write_apart(df: DataFrame, path: str) -> str:
    """Write rows that a commit may name later; returns the folder."""
    folder = f"rows-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{folder}")
    return folder


def write_version(df: DataFrame, path: str) -> str:
    """Write a table as a whole next to its older versions, which it may be made from.

    Of two writers at once each gets a version of its own; the later commit is the newer one.
    """
    folder, version = _write_apart(df, path), 1
    while not _commit(df.sparkSession, path, version, folder):
        version = max(version, *versions(df.sparkSession, path)) + 1
    return f"{path}/{folder}"


def commit_run_state(state: DataFrame, path: str) -> str:
    """Record the run. Always the last action of a job: what failed is fetched again."""
    return write_version(state.coalesce(1), path)  # one narrow row per standing query


def update_run_state(spark: SparkSession, path: str, change: Callable[[DataFrame], DataFrame]) -> str:
    """Record what a run changes of the state that it finds.

    The next version is created only if nobody else has; of two runs that started from the same state the later one
    applies its change to what the other one left.
    """
    while True:
        known = versions(spark, path)
        base = known[-1] if known else 0
        folder = _write_apart(change(read_version(spark, path, schemas.RUN_STATE, base)).coalesce(1), path)
        if _commit(spark, path, base + 1, folder):
            return f"{path}/{folder}"


def export_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with header and doubled quotes, for programs outside Spark. Blanks at the ends of texts stay.

    CSV does not tell an empty text from a missing one; read back, both are NULL.
    """
    blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode(mode).options(header=True, escape='"', **blanks).csv(path)
