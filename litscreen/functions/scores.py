"""Arithmetic on scores and vectors."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from litscreen import settings
from litscreen.functions import let


def is_missing(column: Column, is_float: bool) -> Column:
    """NULL, or NaN in a column of floats."""
    return column.isNull() | F.isnan(column) if is_float else column.isNull()


def clip(score: Column, low: float = 0.0, high: float = 1.0) -> Column:
    """Limit a score to a range. A missing score stays missing."""
    def limited(x: Column) -> Column:
        return F.when(x.isNotNull() & ~F.isnan(x), F.least(F.greatest(x, F.lit(low)), F.lit(high)))

    return let(score, limited)


def sigmoid(value: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-value))


def linear_head(vector: Column, weights: Column, bias: Column) -> Column:
    """``weights . vector + bias``, summed in double precision."""
    products = F.zip_with(vector, weights, lambda x, w: x.cast("double") * w)
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x) + bias


def mean_of(values: list[Column]) -> Column:
    """The mean of some columns of one row; missing if any of them is."""
    return reduce(add, values) / F.lit(float(len(values)))


def uniform(row_key: Column, salt: str) -> Column:
    """A number in [0, 1) that depends on the row and the salt alone: repeatable anywhere."""
    digits = F.substring(F.md5(F.concat(row_key.cast("string"), F.lit(f":{salt}"))), 1, 8)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(2**32))


def with_noise(score: Column, draw: Column, max_deviation: float = settings.MAX_DEVIATION) -> Column:
    """Multiply by ``1 + u`` with u between the two deviations, then clip to 0..1."""
    return clip(score * (1.0 + (draw * 2.0 - 1.0) * max_deviation))


def meets(scores: dict[str, float]) -> Column:
    """All named columns reach their threshold; a missing score does not."""
    return reduce(
        lambda a, b: a & b,
        [F.col(name) >= limit for name, limit in scores.items()],
    )
