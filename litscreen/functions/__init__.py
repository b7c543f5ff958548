"""Column expressions. Every function takes and returns Columns and stays inside the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Use a value several times but compute it once for a row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
