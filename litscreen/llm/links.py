"""Connected components of a table of links, by alternating stars (large star, small star)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from litscreen.session import materialise


def _large_star(links: DataFrame) -> DataFrame:
    """Each neighbour above a node goes to the least node around it."""
    both = links.union(links.select(F.col("low").alias("high"), F.col("high").alias("low"))).toDF("node", "other")
    return _to_least(both).where(F.col("other") > F.col("node")).select("other", "least")


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its neighbours below it go to the least of them."""
    found = _to_least(links.toDF("node", "other"))
    return found.select("other", "least").union(found.select("node", "least"))


def _to_least(pairs: DataFrame) -> DataFrame:
    """Pairs with the least node around ``node``: counted map-side first, then joined, so that hubs can be split."""
    least = pairs.groupBy("node").agg(F.min("other").alias("least"))
    return pairs.join(least, "node").select("node", "other", F.least("node", "least").alias("least"))


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """(node, root) for each linked node but the roots; the root is the least node of its component.

    ``links`` has two columns of one ordered type; order, repetition and links of a node to itself do not matter.
    Each round is written to the shared folder; the number of rounds grows with the logarithm of the longest chain.
    """
    a, b = (F.col(c) for c in links.columns)
    tidy = lambda df: df.toDF("high", "low").where(F.col("high") != F.col("low")).distinct()
    now = materialise(tidy(links.where(a != b).select(F.greatest(a, b), F.least(a, b))), "links")
    before = None
    while before != (state := _state(now)) and state[0]:
        before = state
        now = materialise(tidy(_small_star(tidy(_large_star(now)))), "links")
    return now.toDF("node", "root")
