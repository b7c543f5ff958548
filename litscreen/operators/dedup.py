"""One row per key, and the tables that are kept that way."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from litscreen.operators.joins import salts_for


def first_per_key(
    df: DataFrame, keys: list[str], order: list[Column], count: int = 1, salts: int | None = None
) -> DataFrame:
    """The first ``count`` rows of each key. Missing keys form one group.

    Spark ranks inside each map task first (WindowGroupLimit) and sends on at most ``count``
    rows per key, so a key with very many rows costs one row per task for ``count=1``. It does
    so up to a limit; beyond it the rows of a key are ranked in salted parts before that.
    """
    def ranked(rows: DataFrame, groups: list[str]) -> DataFrame:
        window = Window.partitionBy(*groups).orderBy(*order)
        numbered = rows.withColumn("_place", F.row_number().over(window))
        return numbered.filter(F.col("_place") <= count).drop("_place")

    threshold = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if count > threshold:
        others = [name for name in df.columns if name not in keys] or keys
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(*others), F.lit(salts or salts_for(df))))
        df = ranked(salted, [*keys, "_salt"]).drop("_salt")
    return ranked(df, keys)


def union_first(old: DataFrame, new: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """Both tables below each other, one row per key, rows of the old table first."""
    both = old.withColumn("_batch", F.lit(0)).unionByName(new.withColumn("_batch", F.lit(1)))
    return first_per_key(both, [key], [F.col("_batch"), *order]).drop("_batch")


def absent(old: DataFrame, fresh: DataFrame, key: str) -> DataFrame:
    """The rows of a table with unique keys whose key another table does not hold.

    Of the old table only the key column is read, and only keys that are in both are kept,
    so a small ``fresh`` leaves a large ``old`` where it is.
    """
    def same(left: str, right: str) -> Column:
        return F.col(left).eqNullSafe(F.col(right))

    known = old.select(F.col(key).alias("_old"))
    both = known.join(fresh.select(F.col(key).alias("_new")), same("_old", "_new"), "left_semi")
    return fresh.join(both, same(key, "_old"), "left_anti")


def unseen(old: DataFrame, new: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """The rows of ``new`` that :func:`union_first` would add to a unique ``old``."""
    return absent(old, first_per_key(new, [key], order), key)


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The last row of each key: last write wins. ``order`` is given newest first."""
    return first_per_key(df, keys, order)
