"""Mixing sources to target weights by Poisson replication.

Each source has a mean number of copies of its documents, so that its expected share of the mixture is its weight.
The number of copies of one document is a Poisson number of that mean, found by inverting the distribution at the hash
of a seed, the document ID and its text. A large mean is split: the number is the sum of several Poisson numbers of
equal means, each with a hash of its own, which follows the same law. Copies are dealt out by hash over all partitions
and ordered by hash in each. Only built-in functions run on the rows; what comes to the driver is one count for each
weighted source.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

RESOLUTION = 2**32  # steps of the hash that is inverted
MOST_MEAN = 500.0  # a higher mean is drawn in parts
SALTS = 1024  # rows that are equal in all that is hashed are dealt to so many places
SEED = 17


def rates(docs: DataFrame, weights: dict[str, float], total: int | None = None) -> tuple[dict[str, float], float]:
    """Mean copies by weighted source, and those of all other rows (null sources among them).

    The others share what the weights leave of one, in proportion to their rows. ``total`` is the expected number of
    rows of the mixture, by default that of ``docs``. A weighted source without rows adds nothing.
    """
    if any(w < 0 for w in weights.values()) or sum(weights.values()) > 1 + 1e-9:
        raise ValueError("weights must not be negative and must not sum to more than one")
    known = F.when(F.col("source").isin(list(weights)), F.col("source"))
    counts = {r.known: r.n for r in docs.groupBy(known.alias("known")).agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values()) if total is None else total
    found = {s: total * w / counts[s] for s, w in weights.items() if counts.get(s)}
    others = counts.get(None, 0)
    rest = total * max(0.0, 1 - sum(weights.values())) / others if others else 0.0
    return found, rest


def thresholds(mean: float) -> list[int]:
    """Cumulative probabilities of 0, 1, 2 .. copies in steps of the hash, as long as they are below one."""
    found, below, k = [], 0.0, 0
    while mean > 0:
        below += math.exp(-mean + k * math.log(mean) - math.lgamma(k + 1))
        step = math.floor(below * RESOLUTION + 0.5)
        if step >= RESOLUTION or k > mean and found and step == found[-1]:
            break
        found.append(step)
        k += 1
    return found if mean > 0 else []


def parts_of(mean: float) -> int:
    """In how many parts of equal means a number is drawn."""
    return max(1, math.ceil(mean / MOST_MEAN))


def _name(columns: list[str], seed: int) -> Column:
    """What tells a row: seed, ID and the hash of the text, as far as there are any."""
    known = [F.col("doc_id").cast("string")] if "doc_id" in columns else []
    return F.concat_ws(":", F.lit(str(seed)), *known, *([F.md5("text")] if "text" in columns else []))


def _draws(name: Column, mean: float) -> Column:
    """The numbers that a row draws: for each part, how many cumulative probabilities its hash reaches."""
    many = parts_of(mean)
    steps = F.lit(thresholds(mean / many)).cast("array<long>")

    def draw(part: Column) -> Column:
        own = F.when(part == 0, name).otherwise(F.concat(name, F.lit(":"), part.cast("string")))
        u = F.conv(F.substring(F.md5(own), 1, 8), 16, 10).cast("long")
        return F.aggregate(steps, F.lit(0), lambda n, t: n + F.when(t <= u, 1).otherwise(0))

    if mean <= 0:
        return F.array().cast("array<int>")
    if many == 1:
        return F.array(draw(F.lit(0)))
    return F.transform(F.sequence(F.lit(0), F.lit(many - 1)), draw)


def draws(means: dict[str, float], rest: float, name: Column) -> Column:
    """The numbers that a row draws, by its ``source``; the copies of the row are their sum."""
    chain = F
    for source, mean in means.items():
        chain = chain.when(F.col("source") == source, _draws(name, mean))
    return chain.otherwise(_draws(name, rest)) if means else _draws(name, rest)


def replicate(docs: DataFrame, weights: dict[str, float], total: int | None = None, seed: int = SEED) -> DataFrame:
    """``docs`` with each row as often as it was drawn, and its number ``copy`` from 1, in random order.

    Rows of equal ID, text and source are drawn equally often. Rows without an ID are told apart by their texts. A
    mixture of no rows is empty. A column ``copy`` of ``docs`` is replaced.
    """
    docs = docs.drop("copy")
    given = docs.columns
    means, rest = rates(docs, weights, total)
    drawn = docs.withColumn("_drawn", draws(means, rest, _name(given, seed)))
    # The first copy of each part comes after those of the parts before it.
    until = F.aggregate(
        "_drawn", F.array(F.lit(0).cast("long")), lambda sums, n: F.concat(sums, F.array(F.element_at(sums, -1) + n)))
    if max([rest, *means.values()], default=0) > MOST_MEAN:
        parts = drawn.withColumn("_until", until).select("*", F.posexplode("_drawn").alias("_part", "_n"))
        counted = parts.select(*given, F.get("_until", F.col("_part")).alias("_before"), "_n")
    else:
        counted = drawn.select(*given, F.lit(0).cast("long").alias("_before"), F.get("_drawn", F.lit(0)).alias("_n"))
    each = F.explode(F.sequence(F.lit(1), F.col("_n")))
    copied = counted.where("_n > 0").select(*given, "_before", each.alias("copy")).select(
        *given, (F.col("_before") + F.col("copy")).cast("int").alias("copy"))
    order = F.xxhash64(F.lit(seed), *[c for c in ("doc_id", "text") if c in given], F.col("copy"))
    salted = copied.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)))
    return salted.repartition(order, "_salt").sortWithinPartitions(order).drop("_salt")


def sql(weights: dict[str, float], columns: list[str], seed: int = SEED) -> str:
    """The same mixture of the table ``documents`` in SQL of DuckDB."""
    listed = ", ".join(f"('{s}', {w!r}::DOUBLE)" for s, w in weights.items())
    left = max(0.0, 1 - sum(weights.values()))
    return f"""
WITH listed(name, weight) AS (VALUES {listed}),
named AS (SELECT documents.*, listed.name FROM documents LEFT JOIN listed ON source = name),
counts AS (SELECT name, count(*) AS n FROM named GROUP BY name),
means AS (SELECT counts.name, (SELECT sum(n) FROM counts) * coalesce(weight, {left!r}::DOUBLE) / n AS mean
          FROM counts LEFT JOIN listed ON counts.name = listed.name),
parts AS (SELECT name, greatest(1, ceil(mean / {MOST_MEAN!r}::DOUBLE))::BIGINT AS many, mean FROM means WHERE mean > 0),
steps AS (SELECT name, floor(4294967296 * sum(exp(-mean / many + k * ln(mean / many) - lgamma(k + 1)))
                             OVER (PARTITION BY name ORDER BY k) + 0.5) AS step
          FROM parts, range(0, 1000) AS r(k)),
rows AS (SELECT *, row_number() OVER () AS row FROM named),
each AS (SELECT r.*, unnest(range(0, many)) AS part FROM rows r JOIN parts p ON r.name IS NOT DISTINCT FROM p.name),
hashed AS (SELECT *, ('0x' || substr(md5(concat_ws(':', '{seed}', doc_id, md5(text)) || CASE WHEN part > 0 THEN ':' || part ELSE '' END), 1, 8))::BIGINT AS u
           FROM each),
drawn AS (SELECT h.*, (SELECT count(*) FROM steps s WHERE s.name IS NOT DISTINCT FROM h.name AND step <= u AND step < 4294967296) AS n FROM hashed h),
placed AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY row ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM drawn)
SELECT {', '.join(columns)}, (before + unnest(range(1, n + 1)))::BIGINT AS copy FROM placed WHERE n > 0"""
