"""Joins that hold when one key has a large part of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST_SALTS, MOST_SALTS = 16, 256


def salts_for(df: DataFrame) -> int:
    """To how many tasks a hot key is dealt: as many as a shuffle has, within limits, as lookups are copied for each."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return min(max(LEAST_SALTS, partitions), MOST_SALTS)


def measure(
    df: DataFrame, max_rows: int = 100_000, extra: Column | None = None, max_bytes: int = 64 << 20
) -> tuple[bool, object]:
    """Whether a table is small enough to send to every executor, and one more aggregate of it.

    Reads at most ``max_rows + 1`` rows, so the check itself is bounded.
    """
    size = F.sum(F.length(F.to_json(F.struct("*")).cast("binary")))
    head = df.limit(max_rows + 1)
    rows, width, value = head.agg(F.count("*"), size, F.lit(None) if extra is None else extra).first()
    return rows <= max_rows and (width or 0) <= max_bytes, value


def attach(
    rows: DataFrame, lookup: DataFrame, key: str, spread_by: str, how: str = "inner"
) -> DataFrame:
    """Give each row the columns of a stored table with narrow rows for each key.

    A key may have a third of all rows. The lookup is broadcast if it is measured to be
    small, so that no row moves; if it is not, the hot keys are spread by salts.
    """
    if measure(lookup)[0]:
        return rows.join(F.broadcast(lookup), key, how)
    return salted_join(rows, lookup, key, spread_by, how)


def salted_join(
    rows: DataFrame,
    lookup: DataFrame,
    key: str,
    spread_by: str,
    how: str = "inner",
    salts: int | None = None,
    also: Sequence[str] = (),
) -> DataFrame:
    """A join where the rows of each key are dealt to ``salts`` tasks by the hash of another column.

    The lookup is written out once per salt; the result is that of the plain join. ``also`` are more key columns.
    """
    salts = salts or salts_for(rows)
    dealt = rows.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int"))
    copies = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return dealt.join(copies.hint("merge"), [key, *also, "_salt"], how).drop("_salt")


def rest_of(rows: DataFrame, part: DataFrame, key: str) -> DataFrame:
    """All rows but those whose key is in ``part``."""
    return rows.join(part.select(key), key, "left_anti")
