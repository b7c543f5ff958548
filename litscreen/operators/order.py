"""Exact splits, shuffles and numbering without sorting all rows in one task.

Everything here orders rows by the hash of their ID. Hashes are even, so the rows can be
counted by the first digits of the hash: that table has at most 65,536 rows whatever the
size of the data, and a running sum over it tells where each part begins. IDs have to be
unique, as they are after the deduplication.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from litscreen import settings

_PREFIX_DIGITS = 4  # 16 ** 4 parts


def order_hash(id_col: str, seed: int) -> Column:
    """The hash of an ID; a missing ID has one as well."""
    return F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(f":{seed}")))


def _parts(hashed: DataFrame) -> DataFrame:
    """Part, rows in it, rows before it. At most 16 ** 4 rows."""
    counts = hashed.groupBy("_part").agg(F.count("*").alias("_rows"))
    until = F.sum("_rows").over(Window.orderBy("_part"))
    return counts.select("_part", "_rows", (until - F.col("_rows")).alias("_before"))


def _hashed(df: DataFrame, id_col: str, seed: int, by_row: bool = False) -> DataFrame:
    found = order_hash(id_col, seed)
    if by_row:
        whole = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))
        found = F.when(F.col(id_col).isNull(), F.md5(F.concat(whole, F.lit(f":{seed}")))).otherwise(found)
    hashed = df.withColumn("_hash", found)
    return hashed.withColumn("_part", F.substring("_hash", 1, _PREFIX_DIGITS))


def _boundary(df: DataFrame, id_col: str, seed: int, share: float) -> DataFrame:
    """One row: the last hash and ID of the test part, of ``ceil(share * n)`` IDs."""
    ids = df.select(id_col)
    parts = _parts(_hashed(ids.distinct(), id_col, seed))
    size = F.ceil(F.sum("_rows").over(Window.partitionBy()) * F.lit(share))
    edge = parts.withColumn("_place", (size - F.col("_before")).cast("long")).filter(
        F.col("_place").between(1, F.col("_rows"))
    )
    place = Window.partitionBy("_part").orderBy("_hash", id_col)
    # One row; only the IDs of its part are made distinct again.
    near = _hashed(ids, id_col, seed).join(F.broadcast(edge.select("_part", "_place")), "_part")
    return (
        near.distinct()
        .withColumn("_number", F.row_number().over(place))
        .filter(F.col("_number") == F.col("_place"))
        .select(F.struct("_hash", id_col).alias("last"))
    )


def split(
    df: DataFrame,
    id_col: str,
    share: float = settings.TEST_SHARE,
    seed: int = settings.SPLIT_SEED,
) -> tuple[DataFrame, DataFrame]:
    """Training part and test part; the test part has exactly ``ceil(share * n)`` IDs.

    The boundary is found from the IDs alone. After that either part is a filter on the
    scan, and no row is moved. Rows with the same ID stay together.
    """
    last = _boundary(df, id_col, seed, share).scalar()
    key = F.struct(order_hash(id_col, seed).alias("_hash"), F.col(id_col))
    return df.filter(key > last), df.filter(key <= last)


def number_rows(df: DataFrame, id_col: str, seed: int, name: str = "row") -> DataFrame:
    """Number all rows from 0 in shuffled order, without gaps.

    Rows without an ID are ordered by the hash of all their columns, so they do not meet in one part, and each gets
    the same number in every run; only rows that are equal in all columns may change places.
    """
    hashed = _hashed(df, id_col, seed, by_row=True)
    before = _parts(hashed.select("_part")).select("_part", "_before")
    place = Window.partitionBy("_part").orderBy("_hash", id_col)
    numbered = hashed.join(F.broadcast(before), "_part")  # at most 16 ** 4 rows
    return numbered.withColumn(
        name, F.col("_before") + F.row_number().over(place) - 1
    ).drop("_hash", "_part", "_before")


def batches(
    df: DataFrame, id_col: str, size: int = settings.TRAINING_BATCH, seed: int = settings.SPLIT_SEED
) -> DataFrame:
    """Deal the shuffled rows to batches of ``size``; the last one may be short."""
    numbered = number_rows(df, id_col, seed, "_row")
    return numbered.withColumn("batch", F.floor(F.col("_row") / size)).drop("_row")
