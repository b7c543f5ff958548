"""Which queries run today, and over which dates."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litscreen import settings
from litscreen.functions import text
from litscreen.operators.joins import attach


def run_gate(
    last_run: Column,
    current: Column,
    first_run: bool = False,
    interval: int = settings.RUN_INTERVAL_DAYS,
) -> Column:
    """``FULL``, ``SKIP_SAME_DAY``, ``RUN``, ``SKIP_TOO_SOON`` or ``ERROR_NO_STATE``."""
    if first_run:
        return F.lit("FULL")
    days = F.abs(F.datediff(current, last_run))
    return (
        F.when(last_run.isNull(), "ERROR_NO_STATE")
        .when(days == 0, "SKIP_SAME_DAY")
        .when(days >= interval, "RUN")
        .otherwise("SKIP_TOO_SOON")
    )


def query_mode(last_fetch: Column, current: Column, first_run: bool = False) -> Column:
    """What a query does once the gate is open."""
    if first_run:
        return F.lit("FULL")
    return (
        F.when(last_fetch.isNull(), "FULL")
        .when(last_fetch == current, "SKIP")
        .otherwise("INCREMENTAL")
    )


def plan_queries(
    queries: DataFrame, run_state: DataFrame, current: datetime.date, first_run: bool = False
) -> DataFrame:
    """Each query with its mode, its range of dates and the text of its search."""
    today = F.lit(current)
    mode = query_mode(F.col("last_fetch"), today, first_run)
    return (
        queries.join(run_state, "query_id", "left")
        .withColumn("mode", mode)
        .withColumn("since", F.when(F.col("mode") == "INCREMENTAL", F.col("last_fetch")))
        .withColumn("until", F.when(F.col("mode") == "INCREMENTAL", today))
        .withColumn(
            "search_text",
            text.search_text(F.col("query_text"), F.col("mode"), F.col("since"), F.col("until")),
        )
        .drop("last_fetch")
    )


def in_range(day: Column, since: Column, until: Column) -> Column:
    """Inside the range, both ends included."""
    return day.between(since, until)


def select_new(
    rows: DataFrame,
    run_state: DataFrame,
    current: datetime.date,
    key: str,
    day: str,
    spread_by: str,
) -> DataFrame:
    """The rows of each key that its last run has not seen.

    A key without state is taken in full, one already seen today not at all, the others from
    the last day up to today, both included.
    """
    today = F.lit(current)
    known = attach(rows, run_state.select(key, "last_fetch"), key, spread_by, how="left")
    mode = query_mode(F.col("last_fetch"), today)
    wanted = (mode == "FULL") | (
        (mode == "INCREMENTAL") & in_range(F.col(day), F.col("last_fetch"), today)
    )
    return known.withColumn("mode", mode).filter(wanted)


def advance(run_state: DataFrame, plan: DataFrame, current: datetime.date) -> DataFrame:
    """The run state after the planned queries have been served."""
    served = plan.filter(F.col("mode") != "SKIP").select("query_id", F.lit(current).alias("_now"))
    return run_state.join(served, "query_id", "full_outer").select(
        "query_id", F.coalesce("_now", "last_fetch").alias("last_fetch")
    )
