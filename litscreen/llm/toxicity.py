"""Toxicity of texts: FTRL-proximal logistic regression over hashed words, word n-grams and skip-grams.

Words are runs of letters, lower-cased. A text has one feature for each distinct word, beginning of a word, pair of
neighbours and pair with one or two words between, named by 32 bits of a hash, so that even in very long texts hardly
any two share a name. Weights are learned one text after the other: each coordinate has its own rate, from the squares
of the gradients it has seen, and its own L1 bound, below which its weight stays zero. What comes out is a short list
of weights. Shards of the labelled texts are learned apart and averaged by the gradients seen at each coordinate.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from litscreen.llm.texts import Texts, Words, by_slices, mix
from litscreen.operators.dedup import first_per_key
from litscreen.session import Staging

LABELLED_ROWS = 20_000  # labelled texts that weights are learned from at most: those with the smallest hash of their ID
SHARD_ROWS = 4_096  # labelled texts that one task learns from, about
BLOCK = 1 << 23  # features that a shard holds at once; it goes over them several times before it takes the next ones
HELD_OUT, PARTS = 2, 4  # rows whose crc32(doc_id) leaves this remainder are not learned from
THRESHOLD = 0.3
SKIPS = (1, 2, 3)  # a pair of words lies so many words apart
STEMS = (4, 5, 6, 7, 8)  # bytes of the beginnings of words
LEAST_TEXTS = 3  # a feature is learned if so many texts of a block have it


@dataclass(frozen=True)
class Rates:
    """Rates of FTRL-proximal: ``alpha`` and ``beta`` of the step of each coordinate, its L1 and L2, and the passes."""

    alpha: float = 0.6
    beta: float = 1.0
    l1: float = 4.0
    l2: float = 0.1
    passes: int = 10


def _letters(texts: Texts) -> Texts:
    """The same texts with A-Z lower-cased and a blank for whatever is neither a letter nor beyond ASCII."""
    code = np.arange(256)
    lower = np.where((code >= 65) & (code <= 90), code + 32, code)
    kept = np.where((code >= 0x80) | ((lower >= 97) & (lower <= 122)), lower, 0x20).astype(np.uint8)
    found = object.__new__(Texts)
    found.data, found.offsets = kept[texts.data], texts.offsets
    return found


def features(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """(text, 32-bit name) of each feature, not yet distinct."""
    words = Words(_letters(texts))
    names = words.hashes()
    owners, found = [words.text], [names]
    padded = np.concatenate([words.texts.data, np.zeros(8, np.uint8)])
    heads = np.ascontiguousarray(padded[words.starts[:, None] + np.arange(8)]).view("<u8").ravel()
    for size in STEMS:
        longer = words.ends - words.starts > size
        owners.append(words.text[longer])
        found.append(mix((heads[longer] & np.uint64(2 ** (8 * size) - 1)) + np.uint64(size)))
    for skip in SKIPS:
        at = np.flatnonzero(words.text[skip:] == words.text[: max(0, len(words) - skip)])
        owners.append(words.text[at])
        found.append(mix(names[at] * np.uint64(2 * skip + 1) ^ (names[at + skip] >> np.uint64(1))))
    return np.concatenate(owners), (np.concatenate(found) >> np.uint64(32)).astype(np.uint32)


def _distinct(owners: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    both = np.unique((owners.astype(np.uint64) << np.uint64(32)) | names)
    return (both >> np.uint64(32)).astype(np.int64), both.astype(np.uint32)


class Learner:
    """State of FTRL-proximal for the coordinates that were met often enough; the last one is the intercept."""

    def __init__(self, rates: Rates, share: float):
        self.rates = rates
        self.names = np.zeros(0, np.uint32)
        self.z, self.n = np.zeros(0), np.zeros(0)
        self.share = min(max(share, 1e-6), 1 - 1e-6)
        self.intercept, self.intercept_n = math.log(self.share / (1 - self.share)), 0.0

    def weights(self, z: np.ndarray, n: np.ndarray) -> np.ndarray:
        r = self.rates
        shrunk = np.sign(z) * r.l1 - z
        return np.where(np.abs(z) <= r.l1, 0.0, shrunk / ((r.beta + np.sqrt(n)) / r.alpha + r.l2))

    def learn(self, rows: list[np.ndarray], labels: list[int]) -> None:
        """Several passes over one block of texts, given by their features."""
        names, counts = np.unique(np.concatenate(rows), return_counts=True)
        self._admit(names[(counts >= LEAST_TEXTS) & ~np.isin(names, self.names)])
        places = [self._places(row) for row in rows]
        r = self.rates
        for _ in range(r.passes):
            for at, label in zip(places, labels):
                z, n = self.z[at], self.n[at]
                w = self.weights(z, n)
                g = _sigmoid(self.intercept + w.sum()) - label
                sigma = (np.sqrt(n + g * g) - np.sqrt(n)) / r.alpha
                self.z[at], self.n[at] = z + g - sigma * w, n + g * g
                self.intercept_n += g * g
                self.intercept -= g * r.alpha / (10 * (r.beta + math.sqrt(self.intercept_n)))

    def _admit(self, names: np.ndarray) -> None:
        order = np.argsort(np.concatenate([self.names, names]), kind="stable")
        new = np.zeros(len(names))
        self.z, self.n = (np.concatenate([v, new])[order] for v in (self.z, self.n))
        self.names = np.concatenate([self.names, names])[order]

    def _places(self, row: np.ndarray) -> np.ndarray:
        if not len(self.names):
            return np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.names, row), len(self.names) - 1)
        return at[self.names[at] == row]


def _sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-x)) if x >= 0 else math.exp(x) / (1 + math.exp(x))


def held_out() -> Column:
    """Whether a row is kept out of learning; a row without an ID has no label and is not."""
    rest = F.crc32(F.col("doc_id").cast("string")) % PARTS
    return F.coalesce(rest == HELD_OUT, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = LABELLED_ROWS) -> DataFrame:
    """(doc_id, label, place, features) of at most ``rows`` labelled texts that are not held out.

    Of repeated labels of an ID the highest counts, of repeated texts of an ID that with the smallest hash. The labels
    that are broadcast are bounded by ``rows``, and so are the texts that move, one for each task and ID.
    """
    chosen = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out())
        .groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    )
    wanted = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")

    def work(part, texts: Texts):
        owners, names = _distinct(*features(texts))
        offsets = np.searchsorted(owners, np.arange(len(texts) + 1))
        packed = [names[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:])]
        return {"doc_id": part["doc_id"], "label": part["label"], "features": packed}

    made = by_slices(wanted, work, "doc_id long, label int, features binary")
    return first_per_key(made, ["doc_id"], [F.xxhash64("features"), F.col("features")])


@dataclass(frozen=True)
class Model:
    """Names and weights of the features that have one, by name, and the intercept."""

    names: np.ndarray
    weights: np.ndarray
    intercept: float

    def scores(self, texts: Texts) -> np.ndarray:
        """The score of each text, from 0 to 1."""
        total = np.full(len(texts), self.intercept)
        if len(self.names) and len(texts):
            near = np.zeros(1 << 16, bool)  # which first halves of names have a weight at all
            near[self.names >> np.uint32(16)] = True
            owners, names = features(texts)
            likely = near[names >> np.uint32(16)]
            owners, names = _distinct(owners[likely], names[likely])
            at = np.minimum(np.searchsorted(self.names, names), len(self.names) - 1)
            hit = self.names[at] == names
            total += np.bincount(owners[hit], self.weights[at[hit]], len(texts))
        return 1 / (1 + np.exp(-np.clip(total, -500, 500)))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = LABELLED_ROWS, rates: Rates = Rates()) -> Model:
    """Weights learned from at most ``rows`` labelled texts; without any, every text scores a half.

    Each task learns from a shard and returns its coordinates that have a weight and the squares of their gradients.
    """
    place = F.xxhash64(F.lit(1), "doc_id")

    def shard(batches):
        learner = Learner(rates, share)
        rows, labels, size = [], [], 0
        for batch in batches:
            for label, packed in zip(batch["label"].to_pylist(), batch["features"]):
                row = np.frombuffer(packed.as_py(), np.uint32)
                if rows and size + len(row) > BLOCK:
                    learner.learn(rows, labels)
                    rows, labels, size = [], [], 0
                rows.append(row)
                labels.append(label)
                size += len(row)
        if rows:
            learner.learn(rows, labels)
            weights = learner.weights(learner.z, learner.n)
            kept = weights != 0
            arrays = (learner.names[kept].astype("<u4"), weights[kept], learner.n[kept])
            columns = [*[pa.array([a.tobytes()]) for a in arrays], pa.array([learner.intercept])]
            yield pa.RecordBatch.from_arrays(columns, names=["names", "weights", "seen", "intercept"])

    with Staging() as staging:
        found = staging.materialise(sample(docs, labels, label, rows), "toxic-sample")
        n, share = found.agg(F.count("*"), F.avg("label")).first()
        if not n:
            return Model(np.zeros(0, np.uint32), np.zeros(0), 0.0)
        shards = -(-n // SHARD_ROWS)
        dealt = found.repartition(shards, F.pmod(place, F.lit(shards))).sortWithinPartitions(place, "doc_id")
        learned = dealt.mapInArrow(shard, "names binary, weights binary, seen binary, intercept double").collect()
    return _averaged(sorted(learned, key=lambda r: bytes(r.names)))


def _averaged(shards) -> Model:
    """The mean over shards; at each coordinate by the squares of the gradients that a shard has seen there."""
    every = np.concatenate([np.frombuffer(r.names, np.uint32) for r in shards])
    weights, seen = (np.concatenate([np.frombuffer(r[c], np.float64) for r in shards]) for c in ("weights", "seen"))
    names, at = np.unique(every, return_inverse=True)
    sums = np.bincount(at, weights * seen, len(names)), np.bincount(at, seen, len(names))
    return Model(names, sums[0] / np.maximum(sums[1], 1e-12), float(np.mean([r.intercept for r in shards])))


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of each row; whole texts, nothing is shuffled.

    A null or empty text has no features and scores what the intercept says. Of ``docs`` only ID and text are read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select("doc_id", held_out().alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))
    scored = by_slices(
        rows, lambda part, texts: {"doc_id": part["doc_id"], "held_out": part["held_out"], "score": shared.value.scores(texts)},
        "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
