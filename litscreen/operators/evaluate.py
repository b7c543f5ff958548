"""Checks and measures around training."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from litscreen import settings
from litscreen.functions import scores


def missing_counts(df: DataFrame) -> DataFrame:
    """One row: for each column the number of missing cells."""
    return df.agg(*[
        F.count_if(scores.is_missing(F.col(f.name), isinstance(f.dataType, (T.FloatType, T.DoubleType)))).alias(f.name)
        for f in df.schema.fields
    ])


def require_complete(df: DataFrame) -> DataFrame:
    """The same table; raises if any cell of it is missing."""
    counts = {name: n for name, n in missing_counts(df).first().asDict().items() if n}
    if counts:
        raise ValueError(f"missing cells: {counts}")
    return df


def add_noise(
    df: DataFrame,
    id_col: str,
    columns: tuple[str, ...] = settings.SCORE_COLUMNS,
    names: tuple[str, ...] = settings.RANDOMIZED_COLUMNS,
    seed: int = settings.SPLIT_SEED,
    max_deviation: float = settings.MAX_DEVIATION,
) -> DataFrame:
    """Add the noised scores beside the original ones, in the same row."""
    return df.withColumns({
        name: scores.with_noise(
            F.col(column), scores.uniform(F.col(id_col), f"{column}:{seed}"), max_deviation
        )
        for column, name in zip(columns, names)
    })


def join_by_key(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows of two tables with the same key, which is unique in both; never by position."""
    return left.join(right, key)


def mse(df: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """One row: for each name the mean squared difference of its two columns."""
    return df.agg(*[
        F.avg(F.pow(F.col(predicted) - F.col(truth), 2.0)).alias(name)
        for name, (predicted, truth) in pairs.items()
    ])


def batch_losses(df: DataFrame, batch: str, pairs: list[tuple[str, str]]) -> DataFrame:
    """The loss of each batch: the mean over its rows and all targets."""
    squares = [F.pow(F.col(predicted) - F.col(truth), 2.0) for predicted, truth in pairs]
    return df.groupBy(batch).agg(F.avg(scores.mean_of(squares)).alias("loss"))


def epoch_loss(losses: DataFrame) -> DataFrame:
    """The plain mean of the batch losses; a short batch weighs as much as a full one."""
    return losses.agg(F.avg("loss").alias("loss"), F.count("*").alias("batches"))


def counts_by(df: DataFrame, *columns: str) -> DataFrame:
    """Rows per group, for run reports."""
    return df.groupBy(*columns).agg(F.count("*").alias("n"))
