"""SimHash near-duplicates, found exactly by vantage-point trees.

The distinct fingerprints are dealt out by a tree of vantage points that is built from a bounded sample: what is
within the threshold of a vantage point goes to its near side, the rest to its far side. By the triangle inequality
two fingerprints within the radius can only be parted if the far one is within threshold plus radius, so those are
also sent to the near side. Each shard is searched by a tree of its own in the same way, down to small leaves that
are compared in full. Of the pairs found a shard returns a spanning forest, which has the same components.

The sample decides only how evenly the shards are filled, never what is found.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from litscreen.llm.links import components
from litscreen.llm.texts import Texts, by_slices, text_rows
from litscreen.session import materialise

SHINGLE, SEED, RADIUS = 3, 42, 2
SHARD = 4096  # distinct fingerprints that a shard is meant to have
SAMPLE_PER_SHARD, SAMPLE_MOST = 32, 1 << 20  # fingerprints that come to the driver for the upper tree
LEAF = 192
NO_ID = 2**63 - 1  # stands for a missing ID where a group needs one; it is never the least of others


# ---------------------------------------------------------------- fingerprints

def fingerprint(text: bytes) -> int:
    words = text.lower().split()  # of bytes: A-Z only, and the white space of ASCII
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    size = min(SHINGLE, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends[size - 1:].tolist())], np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 15):
        bits = np.unpackbits(hashes[at:at + (1 << 15)].view(np.uint8)).reshape(-1, 64)
        ones += bits.sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes)).view(np.uint64)[0])


def _fingerprints(texts: Texts) -> np.ndarray:
    return np.array([fingerprint(t) for t in texts.bytes()], np.uint64).view(np.int64)


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``fp`` (64 bits as a long), one row for each row. Null and blank texts have fingerprint zero."""
    return by_slices(text_rows(docs, "doc_id"), lambda part, texts: {"doc_id": part["doc_id"], "fp": _fingerprints(texts)},
                     "doc_id long, fp long")


# ---------------------------------------------------------------- trees

def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def _split(fps: np.ndarray, rng: np.random.Generator) -> tuple[np.uint64, int] | None:
    """A vantage point and threshold that part the fingerprints best; None if none of some tries parts them."""
    best, chosen = 0.98, None
    for at in rng.integers(0, len(fps), 6):
        d = distance(fps, fps[at])
        for threshold in {int(np.median(d)), int(np.median(d)) - 1}:
            larger = max((d <= threshold + RADIUS).mean(), (d > threshold).mean())
            if 0 <= threshold < d.max() and larger < best:
                best, chosen = larger, (fps[at], threshold)
    return chosen


@dataclass
class Tree:
    """Inner nodes with a vantage point, a threshold, and two children; a child below zero is a shard."""

    points: np.ndarray
    thresholds: np.ndarray
    near: np.ndarray
    far: np.ndarray
    shards: int

    def shards_of(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``fps``, and the shards they go to; a fingerprint near a boundary goes to several."""
        if not len(self.points):
            return np.arange(len(fps)), np.zeros(len(fps), np.int64)
        at, node = np.arange(len(fps)), np.zeros(len(fps), np.int64)
        found_at, found_shard = [], []
        while len(at):
            d, limit = distance(fps[at], self.points[node]).astype(np.int64), self.thresholds[node]
            near, far = d <= limit + RADIUS, d > limit
            at, node = np.concatenate([at[near], at[far]]), np.concatenate([self.near[node[near]], self.far[node[far]]])
            ended = node < 0
            found_at.append(at[ended])
            found_shard.append(-node[ended] - 1)
            at, node = at[~ended], node[~ended]
        return np.concatenate(found_at), np.concatenate(found_shard)


def grow(sample: np.ndarray, shards: int, seed: int = 3) -> Tree:
    """A tree over a sample of fingerprints with about so many shards."""
    rng = np.random.Generator(np.random.PCG64(seed))
    rows, ended = [], 0
    todo = [(sample, shards, None)]
    while todo:
        fps, wanted, above = todo.pop()
        cut = _split(fps, rng) if wanted > 1 and len(fps) > 8 else None
        if cut is None:
            ended += 1
            own = -ended
        else:
            own = len(rows)
            rows.append([cut[0], cut[1], 0, 0])
            d = distance(fps, cut[0])
            todo += [(fps[d > cut[1]], wanted // 2, (own, 3)), (fps[d <= cut[1]], wanted - wanted // 2, (own, 2))]
        if above:
            rows[above[0]][above[1]] = own
    columns = list(zip(*rows)) if rows else [[], [], [], []]
    return Tree(np.array(columns[0], np.uint64), *[np.array(c, np.int64) for c in columns[1:]], ended)


def close_pairs(fps: np.ndarray, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Places of distinct fingerprints within the radius of each other, some pairs repeated."""
    rng = np.random.Generator(np.random.PCG64(seed))
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    todo = [np.arange(len(fps))]
    while todo:
        at = todo.pop()
        own = fps[at]
        cut = _split(own, rng) if len(at) > LEAF else None
        if cut is not None:
            d = distance(own, cut[0]).astype(np.int64)
            todo += [at[d <= cut[1] + RADIUS], at[d > cut[1]]]
        elif len(at) <= 4 * LEAF:
            a, b = np.nonzero(np.triu(distance(own[:, None], own[None, :]) <= RADIUS, 1))
            left.append(at[a])
            right.append(at[b])
        else:  # a ball that no vantage point parts: look up what each fingerprint becomes by flipping up to two bits
            order = np.argsort(own)
            for flip in _flips():
                place = np.minimum(np.searchsorted(own[order], own ^ flip), len(own) - 1)
                hit = own[order][place] == own ^ flip
                left.append(at[hit])
                right.append(at[order[place[hit]]])
    return np.concatenate(left), np.concatenate(right)


def _flips() -> np.ndarray:
    one = np.uint64(1) << np.arange(64, dtype=np.uint64)
    a, b = np.triu_indices(64, 1)
    return np.concatenate([one, one[a] | one[b]])


def spanning(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For each of ``n`` places the least place that pairs connect it with."""
    label = np.arange(n)
    while True:
        before = label.copy()
        low = np.minimum(label[left], label[right])
        np.minimum.at(label, left, low)
        np.minimum.at(label, right, low)
        label = label[label]
        if (label == before).all():
            return label


# ---------------------------------------------------------------- jobs

def links(distinct: DataFrame) -> DataFrame:
    """Pairs (``a``, ``b``) of distinct fingerprints that connect just what the radius connects."""
    count = distinct.count()
    shards = max(1, min(-(-count // SHARD), SAMPLE_MOST // SAMPLE_PER_SHARD))
    # About so many, chosen by their hash in each task; nothing is sorted for it.
    share = min(1.0, shards * SAMPLE_PER_SHARD / max(1, count))
    chosen = F.pmod(F.xxhash64(F.lit(1), "fp"), F.lit(1 << 20)) < int(share * (1 << 20))
    sample = distinct.where(chosen).toPandas()["fp"].sort_values()
    tree = grow(sample.to_numpy(np.int64).view(np.uint64), shards)

    def deal(batches):
        for batch in batches:
            fps = batch["fp"].to_numpy().view(np.uint64)
            at, shard = tree.shards_of(fps)
            yield pa.RecordBatch.from_arrays([pa.array(shard), pa.array(fps[at].view(np.int64))], names=["shard", "fp"])

    def search(table: pa.Table) -> pa.Table:
        fps = np.unique(table["fp"].to_numpy()).view(np.uint64)
        root = spanning(len(fps), *close_pairs(fps))
        linked = root != np.arange(len(fps))
        signed = fps.view(np.int64)
        return pa.table({"a": signed[linked], "b": signed[root[linked]]})

    return distinct.mapInArrow(deal, "shard long, fp long").groupBy("shard").applyInArrow(search, "a long, b long")


def _rooted(found: DataFrame) -> DataFrame:
    """``fp``, ``first`` (the smallest ID that has it) and ``root``, the smallest fingerprint reachable over links."""
    distinct = materialise(found.groupBy("fp").agg(F.min("doc_id").alias("first")), "fingerprints")
    roots = components(links(distinct.select("fp"))).toDF("fp", "root")
    return distinct.join(roots, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))


def clusters(found: DataFrame) -> DataFrame:
    """``fp`` and ``component_id``, the smallest ID reachable over links, for a table of ``doc_id`` and ``fp``.

    Rows without an ID link like any others; a component of such rows alone has no ID.
    """
    rooted = _rooted(found)
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return rooted.join(least, "root").select("fp", "component_id")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``fp`` and ``component_id``, one row for each row."""
    found = materialise(fingerprints(docs), "simhash")
    return found.join(clusters(found), "fp").select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component, that with the smallest ID.

    Of rows with the same ID the one with the smaller text stays. Rows without an ID count as the last ones. What
    components have in common, an ID or none, does not matter: each keeps a row of its own.
    """
    key = lambda name: F.coalesce(name, F.lit(NO_ID))
    digest = lambda name: F.unhex(F.sha2(F.coalesce(name, F.lit("")), 256))
    rows = text_rows(docs, key("doc_id").alias("doc_id"), digest("text").alias("digest"))
    found = materialise(by_slices(
        rows, lambda part, texts: {"doc_id": part["doc_id"], "fp": _fingerprints(texts), "digest": part["digest"]},
        "doc_id long, fp long, digest binary"), "simhash")
    # The ID and the text of a row tell its component, as equal texts have equal fingerprints.
    rooted = materialise(_rooted(found), "rooted")
    least = rooted.groupBy("root").agg(F.min("first").alias("key"))
    heads = rooted.join(least, "root").where("first = key").select("fp", "root", F.col("key").alias("doc_id"))
    winners = found.join(heads, ["fp", "doc_id"]).select(F.col("doc_id").alias("key"), "digest", "root").distinct()
    names = [f"own_{i}" for i in range(len(docs.columns))]  # the columns of docs may have any names
    marked = docs.toDF(*names)
    text = names[docs.columns.index("text")]
    marked = marked.withColumns({"key": key(names[docs.columns.index("doc_id")]), "digest": digest(text)})
    ranked = marked.join(winners, ["key", "digest"]).withColumn(
        "rank", F.row_number().over(Window.partitionBy("root").orderBy(text)))
    return ranked.where("rank = 1").select(*names).toDF(*docs.columns)
