"""Audit of how sources differ in their use of terms, by hash-consed segment trees over term ids.

The terms of a language are dealt to blocks of ids. A group (language and source) has a segment tree over the ids of a
block, whose leaves are its counts. Nodes are hash-consed: equal subtrees of counts, in one tree or in several, are one
node. Two trees are compared from their roots downwards, level by level; pairs of nodes met more than once are kept
once with their multiplicity, so that each pair of counts is priced once for a pair of groups. Spark sums the blocks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from litscreen.llm.texts import Texts, slices
from litscreen.operators.joins import attach
from litscreen.session import Staging, materialise

MIN_DOCS = 30
TOP_TERMS = 50
BLOCK_TERMS = 2048  # term ids of a block, about
TILE_SOURCES = 64  # sources that one task compares with as many others, about
PAIRS_AT_ONCE = 256  # pairs of trees that are walked together
SLICE = 4 << 20
SCALE, SMOOTH = 1_000_000_000, 5


def _terms(texts: Texts) -> tuple[pa.Array, np.ndarray]:
    """The terms of some texts, A-Z lower-cased, as one array, and the index of the text of each."""
    code = np.arange(256)
    lowered = np.where((code >= 65) & (code <= 90), code + 32, code).astype(np.uint8)
    is_term = (code >= 0x80) | ((lowered >= 97) & (lowered <= 122))
    data, offsets = texts.data, texts.offsets
    inside = is_term[data]
    begins = np.zeros(len(data) + 1, bool)
    begins[offsets] = True
    before = np.ones(len(data), bool)
    before[1:] = ~inside[:-1]
    starts = np.flatnonzero(inside & (before | begins[:-1]))
    letters = np.concatenate([[0], np.cumsum(inside, dtype=np.int64)])
    places = np.append(letters[starts], letters[-1])
    found = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(places), pa.py_buffer(lowered[data[inside]]))
    return found, np.searchsorted(offsets, starts, "right") - 1


def _count(batches):
    """(lang, source, term, n, docs) of each slice of a batch: occurrences, and texts that have the term."""
    for batch in batches:
        for part, texts in slices(batch, size=SLICE):
            terms, owner = _terms(texts)
            coded = terms.dictionary_encode()
            size = max(1, len(coded.dictionary))
            of_text, often = np.unique(owner * size + np.asarray(coded.indices), return_counts=True)
            names = list(zip(part["lang"].to_pylist(), part["source"].to_pylist()))
            known = {name: i for i, name in enumerate(dict.fromkeys(names))}
            group = np.array([known[name] for name in names], np.int64)
            key, at, docs = np.unique(group[of_text // size] * size + of_text % size, return_inverse=True, return_counts=True)
            lang, source = (pa.array([name[i] for name in known], pa.string()).take(pa.array(key // size)) for i in (0, 1))
            term = coded.dictionary.take(pa.array(key % size)).cast(pa.string())
            n = np.bincount(at, often, len(key)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([lang, source, term, pa.array(n), pa.array(docs.astype(np.int64))],
                                             names=["lang", "source", "term", "n", "docs"])


def _named(docs: DataFrame, *columns: str) -> DataFrame:
    return docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in columns])


def kept_terms(docs: DataFrame, least: int = MIN_DOCS) -> DataFrame:
    """(lang, source, term, n, n_lang): counts by group of the terms in at least ``least`` documents of their language."""
    counted = _named(docs, "lang", "source", "text").mapInArrow(
        _count, "lang string, source string, term string, n long, docs long")
    by_group = counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    every = Window.partitionBy("lang", "term")
    totals = by_group.withColumns({"docs": F.sum("docs").over(every), "n_lang": F.sum("n").over(every)})
    return totals.where(F.col("docs") >= least).drop("docs")


def share(n: str, whole: str) -> Column:
    """1 + floor(SCALE * (n + SMOOTH) / whole), exact."""
    return F.expr(f"1 + (cast({SCALE} as decimal(10, 0)) * cast({n} + {SMOOTH} as decimal(19, 0))) div cast({whole} as decimal(19, 0))")


def _shares(n: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """The same for arrays, by long division in steps of a thousand; exact for wholes below 9e15."""
    left, found = n + SMOOTH, np.zeros(len(n), np.int64)
    for _ in range(3):
        found = found * 1000 + left * 1000 // whole
        left = left * 1000 % whole
    return 1 + found


class Forest:
    """Hash-consed segment trees: one for each row of a table of counts."""

    def __init__(self, counts: np.ndarray):
        width = 1 << max(0, counts.shape[1] - 1).bit_length()
        padded = np.full((len(counts), width), -1, np.int64)  # places beyond the last id have no price
        padded[:, : counts.shape[1]] = counts
        self.counts, level = self._named(padded)
        self.children, self.sizes = [], [len(self.counts)]
        while level.shape[1] > 1:
            size = self.sizes[-1]
            keys, level = self._named(level[:, 0::2] * size + level[:, 1::2])
            self.children.append((keys // size, keys % size))
            self.sizes.append(len(keys))
        self.roots = level[:, 0]

    @staticmethod
    def _named(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nodes by number: distinct keys, and the number of each key."""
        distinct, at = np.unique(keys, return_inverse=True)
        return distinct, at.reshape(keys.shape)

    def distances(self, one: np.ndarray, other: np.ndarray, whole: np.ndarray) -> np.ndarray:
        """Summed differences of shares for pairs of trees; ``whole`` is what the counts of each tree are shares of."""
        pair, a, b, times = np.arange(len(one)), self.roots[one], self.roots[other], np.ones(len(one), np.int64)
        for (left, right), size in zip(reversed(self.children), reversed(self.sizes[:-1])):
            key = np.concatenate([(pair * size + kids[a]) * size + kids[b] for kids in (left, right)])
            distinct, at = np.unique(key, return_inverse=True)
            times = np.bincount(at, np.tile(times, 2), len(distinct)).astype(np.int64)
            pair, a, b = distinct // size // size, distinct // size % size, distinct % size
        priced = self.counts[a] >= 0
        pair, a, b, times = (x[priced] for x in (pair, a, b, times))
        gap = np.abs(_shares(self.counts[a], whole[one[pair]]) - _shares(self.counts[b], whole[other[pair]]))
        order = np.concatenate([[0], np.cumsum(gap * times)])
        ends = np.searchsorted(pair, np.arange(len(one) + 1))
        return order[ends[1:]] - order[ends[:-1]]


def _block(table: pa.Table) -> pa.Table:
    """(lang, one, other, value) for the pairs of sources that meet in one block of ids and pair of tiles."""
    place = np.asarray(table["place"])
    heads = table.filter(pa.array(place < 0))
    names = heads["source"].to_pylist()
    order = sorted(range(len(names)), key=names.__getitem__)
    number = {names[i]: k for k, i in enumerate(order)}
    tile, whole = (np.asarray(heads[c])[order] for c in ("tile", "whole"))
    lo, hi, width = (heads[c][0].as_py() for c in ("lo", "hi", "width"))
    counts = np.zeros((len(names), width), np.int64)
    rows = table.filter(pa.array(place >= 0))
    counts[[number[s] for s in rows["source"].to_pylist()], np.asarray(rows["place"])] = np.asarray(rows["n"])
    one, other = np.triu_indices(len(names), 1)
    if lo != hi:
        apart = tile[one] != tile[other]
        one, other = one[apart], other[apart]
    values = np.zeros(len(one), np.int64)
    if width:
        forest = Forest(counts)
        for at in range(0, len(one), PAIRS_AT_ONCE):
            some = slice(at, at + PAIRS_AT_ONCE)
            values[some] = forest.distances(one[some], other[some], whole)
    listed = pa.array([names[i] for i in order], pa.string())
    lang = pa.array([heads["lang"][0].as_py()] * len(one), pa.string())
    return pa.table({"lang": lang, "one": listed.take(pa.array(one)), "other": listed.take(pa.array(other)), "value": values})


def pair_distances(kept: DataFrame, groups: DataFrame, block_terms: int = BLOCK_TERMS, tile_sources: int = TILE_SOURCES) -> DataFrame:
    """(lang, one, other, value) for each unordered pair of sources of a language.

    ``kept`` has lang, source, term, n and n_lang, ``groups`` lang, source, whole, v (kept terms of the language) and
    sources (of the language). A task holds the ids of one block for two tiles of sources, whatever their number.
    """
    def slot(column: str, total: str, each: int) -> Column:
        parts = F.greatest(F.lit(1), F.ceil(F.col(total) / each))
        return F.pmod(F.xxhash64(F.lit(each), column), parts).cast("int")

    sizes = groups.groupBy("lang").agg(F.max("v").alias("v"), F.max("sources").alias("sources"))
    sized = attach(kept, sizes, "lang", "term").withColumn("block", slot("term", "v", block_terms))
    in_block = Window.partitionBy("lang", "block").orderBy("n_lang", "term")
    with_place = sized.withColumn("place", F.dense_rank().over(in_block) - 1)
    counted = with_place.select("lang", "block", "source", "sources", "place", "n")
    widths = counted.groupBy("lang", "block").agg((F.max("place") + 1).alias("width"))
    heads = attach(groups, widths, "lang", "source", "left").select(
        "lang", F.coalesce("block", F.lit(0)).alias("block"), "source", "sources", F.lit(-1).alias("place"),
        F.lit(0).cast("long").alias("n"), "whole", F.coalesce("width", F.lit(0)).alias("width"))
    every = heads.unionByName(counted, allowMissingColumns=True).withColumn("tile", slot("source", "sources", tile_sources))
    tiles = F.greatest(F.lit(1), F.ceil(F.col("sources") / tile_sources)).cast("int")
    met = every.withColumn("with", F.explode(F.sequence(F.lit(0), tiles - 1))).withColumns(
        {"lo": F.least("tile", "with"), "hi": F.greatest("tile", "with")})
    found = met.groupBy("lang", "block", "lo", "hi").applyInArrow(_block, "lang string, one string, other string, value long")
    return found.groupBy("lang", "one", "other").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, least: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """Distances of the sources of each language, and the terms that a source has above its language.

    Null texts, languages and sources are empty. Sources without terms are compared too, and a source that is alone in
    its language has no pair. Rows that are repeated count as often. A table without rows gives none. Only the three
    columns are read.
    """
    with Staging() as staging:
        kept = staging.materialise(kept_terms(docs, least), "kept-terms")
        groups = _named(docs, "lang", "source").groupBy("lang", "source").agg(F.lit(1).alias("one"))
        of_group = kept.groupBy("lang", "source").agg(F.sum("n").alias("n"))
        of_lang = kept.groupBy("lang", "term").agg(F.first("n_lang").alias("n")).groupBy("lang").agg(
            F.sum("n").alias("n_lang"), F.count("*").alias("v"))
        sized = groups.join(of_group, ["lang", "source"], "left").join(of_lang, "lang", "left").fillna(0, ["n", "n_lang", "v"])
        whole = F.col("n") + SMOOTH * F.col("v")
        listed = staging.materialise(sized.select(
            "lang", "source", "v", whole.alias("whole"), (F.col("n_lang") + SMOOTH * F.col("v")).alias("whole_lang"),
            F.count("*").over(Window.partitionBy("lang")).alias("sources")), "groups")

        apart = pair_distances(kept, listed.drop("whole_lang"))
        both = apart.union(apart.select("lang", "other", "one", "value")).toDF("lang", "source", "item", "value")
        ranked = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
        pairs = both.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(ranked).alias("rank"))

        group = F.struct("lang", "source").alias("group")
        wholes = listed.select(group, "whole", "whole_lang")
        shares = attach(kept.select("lang", "source", group, F.col("term").alias("item"), "n", "n_lang"), wholes, "group", "item")
        above = shares.where("n > 0").withColumn("value", share("n", "whole") - share("n_lang", "whole_lang")).where("value > 0")
        terms = above.select("lang", "source", F.lit("term").alias("part"), "item", "value", F.row_number().over(ranked).alias("rank"))
        return materialise(pairs.union(terms.where(F.col("rank") <= top)), "divergence")


SQL = f"""
WITH d AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT row, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT row) >= {MIN_DOCS}),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM w JOIN k ON w.lang = k.lang AND w.term = k.term GROUP BY ALL),
l AS (SELECT lang, sum(n) AS n, count(*) AS v FROM k GROUP BY lang),
s AS (SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS n FROM g LEFT JOIN c ON g.lang = c.lang AND g.source = c.source GROUP BY ALL),
p AS (SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n,
             1 + ({SCALE}::HUGEINT * (coalesce(c.n, 0) + {SMOOTH}) // (s.n + {SMOOTH} * l.v)) AS p,
             1 + ({SCALE}::HUGEINT * (k.n + {SMOOTH}) // (l.n + {SMOOTH} * l.v)) AS q
      FROM s JOIN k ON s.lang = k.lang JOIN l ON s.lang = l.lang
      LEFT JOIN c ON s.lang = c.lang AND s.source = c.source AND k.term = c.term),
a AS (SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value
      FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
r AS (SELECT g.lang, g.source, 'pair' AS part, h.source AS item, coalesce(a.value, 0)::BIGINT AS value
      FROM g JOIN g h ON g.lang = h.lang AND g.source <> h.source
      LEFT JOIN a ON a.lang = g.lang AND a.source = g.source AND a.item = h.source
      UNION ALL SELECT lang, source, 'term', term, (p - q)::BIGINT FROM p WHERE n > 0 AND p > q)
SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank
FROM r QUALIFY part = 'pair' OR rank <= {TOP_TERMS}"""
