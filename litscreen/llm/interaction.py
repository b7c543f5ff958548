"""Audit of how filters interact: what each step of each order of the filters removes.

Whatever the order, the documents left after some filters depend only on the set of those filters. So the sets form a
lattice whose edges each add one filter. Forward counts say how many orders reach a set, backward counts how many lead
on from it, and their product how many orders run over an edge. Documents are counted once, by the set of filters that
they fail; each edge is priced from these counts. The steps of an order are read off the edges on its way, and the
removals of a filter summed over all orders (its Shapley value times their number) are its edges' removals, weighted.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

MIN_WORDS, MIN_DISTINCT_PERCENT, MAX_UPPER_PERCENT = 200, 50, 3
SYMBOLS = "[#$%&*|]"
COPY = "E"  # the filter that fails whatever is equal to a text with a smaller ID


def row_filters(text: Column) -> dict[str, Column]:
    """Failure conditions that one text decides alone."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+", -1), lambda w: w != "")
    uppers = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": F.size(words) < MIN_WORDS,
        "B": 100 * F.size(F.array_distinct(words)) < MIN_DISTINCT_PERCENT * F.size(words),
        "C": 100 * uppers > MAX_UPPER_PERCENT * F.length(text),
        "D": text.rlike(SYMBOLS),
    }


@dataclass(frozen=True)
class Edge:
    """One filter put after a set of others, and the number of orders that do so."""

    state: int
    place: int
    orders: int


def lattice(n: int) -> list[Edge]:
    """The edges of the lattice of all sets of ``n`` filters, with orders counted forward and backward."""
    reach, leave = [0] * 2**n, [0] * 2**n
    reach[0] = leave[-1] = 1
    for state in range(2**n):
        for place in range(n):
            if not state >> place & 1:
                reach[state | 1 << place] += reach[state]
    for state in reversed(range(2**n)):
        for place in range(n):
            if not state >> place & 1:
                leave[state] += leave[state | 1 << place]
    return [Edge(s, p, reach[s] * leave[s | 1 << p]) for s in range(2**n) for p in range(n) if not s >> p & 1]


def _failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, failed, n, good, toxic): documents of each part by the set of filters that they fail.

    Texts are met by their SHA-256. Only IDs and digests move; equal texts of one part and label are one row after the
    first count, and what is left of a text has a row for each part and label.
    """
    text = F.coalesce("text", F.lit(""))
    failed = sum((F.when(c, 1 << i).otherwise(0) for i, c in enumerate(row_filters(F.col("text")).values())), F.lit(0))
    rows = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), text.alias("text")).select(
        "doc_id", "part", failed.alias("failed"), F.unhex(F.sha2("text", 256)).alias("digest"))
    keys = ["digest", "failed", "part"]
    counted = rows.groupBy("doc_id", *keys).agg(F.count("*").alias("n"))
    # Rows without an ID have no label; their keys are spread, so that they do not meet in one task.
    named = counted.withColumn("_key", F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("none:"), F.hex("digest"))))
    marked = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("string").alias("_key")).agg(
        F.max(F.expr("quality <=> 1")).alias("good"), F.max(F.expr("toxic <=> 1")).alias("toxic"))
    joined = named.join(marked, "_key", "left").withColumns(
        {c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")})
    alike = joined.groupBy(*keys, "good", "toxic").agg(
        F.sum("n").alias("n"), F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("first"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("unnamed"))
    least = F.min("first.doc_id").over(Window.partitionBy("digest"))
    originals = F.col("unnamed") + F.when(F.col("first.doc_id") == F.col("least"), F.col("first.n")).otherwise(0)
    parted = alike.withColumn("least", least).withColumn("originals", originals)
    copy = 1 << len(row_filters(F.col("text")))
    either = F.array(
        F.struct(F.col("failed"), F.col("originals").alias("n")),
        F.struct((F.col("failed") + copy).alias("failed"), (F.col("n") - F.col("originals")).alias("n")))
    split = parted.select("part", "good", "toxic", F.inline(either))
    return split.groupBy("part", "failed").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"))


def _steps(spark: SparkSession, names: list[str]) -> DataFrame:
    """The edge of each step of each order; as many rows as orders times filters."""
    rows = []
    for order in permutations(range(len(names))):
        state = 0
        for step, place in enumerate(order, 1):
            rows.append(("".join(names[p] for p in order), step, state, place))
            state |= 1 << place
    return spark.createDataFrame(rows, "filter_order string, step int, state int, place int")


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each part (language), order of the filters and step.

    A null text is empty, a null language the empty part. Rows without an ID are neither copies nor originals of
    others; equal rows of one ID are no copies of each other. Of repeated labels of an ID each mark counts that any of
    them sets. A table without rows has no parts. Other columns are not read.
    """
    names = [*row_filters(F.col("text")), COPY]
    edges = F.array(*[F.struct(F.lit(e.state).alias("state"), F.lit(e.place).alias("place"),
                               F.lit(e.orders).alias("orders")) for e in lattice(len(names))])
    each = _failures(docs, labels).select("part", "failed", "n", "good", "toxic", F.inline(edges))
    own, before = F.expr("shiftleft(1, place)"), F.col("failed").bitwiseAND(F.col("state"))
    fails = F.col("failed").bitwiseAND(own) != 0
    total = lambda what, c: F.sum(F.when(c, F.col(what)).otherwise(0))
    priced = each.groupBy("part", "state", "place", "orders").agg(
        total("n", ~fails & (before == 0)).alias("kept"), total("n", fails & (before == 0)).alias("removed"),
        total("n", fails & (before != 0)).alias("redundant"), total("n", F.col("failed") == own).alias("unique_fails"),
        total("good", fails & (before == 0)).alias("good_lost"), total("toxic", fails & (before == 0)).alias("toxic_lost"))
    weighted = priced.withColumn(
        "shapley", F.sum(F.col("orders") * F.col("removed")).over(Window.partitionBy("part", "place")))
    steps = F.broadcast(_steps(docs.sparkSession, names))
    return weighted.join(steps, ["state", "place"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


SQL = """
WITH l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, part, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS words FROM d),
f AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
             [len(words) < 200, 100 * len(list_distinct(words)) < 50 * len(words),
              100 * len(regexp_replace(t, '[^A-Z]+', '', 'g')) > 3 * len(t), regexp_matches(t, '[#$%&*|]'),
              coalesce(w.doc_id > min(w.doc_id) OVER (PARTITION BY t), false)] AS fails
      FROM w LEFT JOIN l ON w.doc_id = l.doc_id),
h AS (SELECT part, fails, count(*) AS n, count_if(good) AS good, count_if(toxic) AS toxic FROM f GROUP BY part, fails),
letter(x) AS (VALUES (1), (2), (3), (4), (5)),
orders AS (SELECT [a.x, b.x, c.x, d.x, e.x] AS o FROM letter a, letter b, letter c, letter d, letter e
           WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (SELECT o, list_aggregate(list_transform(o, lambda i: chr(64 + i)), 'string_agg', '') AS filter_order, s.x AS step,
                 o[s.x] AS own, o[1:s.x - 1] AS before FROM orders, letter s),
r AS (SELECT part, filter_order, step, own, n, good, toxic, fails[own] AS bad,
             len(list_filter(before, lambda i: fails[i])) > 0 AS gone,
             len(list_filter(fails, lambda b: b)) = 1 AS alone FROM h, steps),
s AS (SELECT part, filter_order, step, own, sum(n) FILTER (NOT bad AND NOT gone) AS kept, sum(n) FILTER (bad AND NOT gone) AS removed,
             sum(n) FILTER (bad AND gone) AS redundant, sum(n) FILTER (bad AND alone) AS unique_fails,
             sum(good) FILTER (bad AND NOT gone) AS good_lost, sum(toxic) FILTER (bad AND NOT gone) AS toxic_lost
      FROM r GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step::INT AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
       coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
       coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       sum(coalesce(removed, 0)) OVER (PARTITION BY part, own)::BIGINT AS shapley
FROM s"""
