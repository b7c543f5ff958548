"""Token counts by rank-synchronous merging of arrays.

Distinct pre-tokens of a part of a batch are held as one ragged array of symbols. Each round looks up the rank of
every adjacent pair, takes the lowest of each sequence, and merges all its places in all sequences at once, from
left to right where they overlap. A merged pair only makes pairs of higher rank, so this equals merging one by one.
Sequences without a pair left are done: their surviving symbols are counted. Very long sequences have as many rounds as
they have distinct ranks; there, places are kept by rank, and a round looks only at its own and those beside them.
"""

from __future__ import annotations

import heapq
import re
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, functions as F

from litscreen.llm import vocabulary
from litscreen.llm.texts import Texts, by_slices, text_rows

LIMIT = 1024
KEPT_COUNTS = 400_000  # counts of strings that a worker keeps at once; the result does not depend on it
NO_RANK = np.iinfo(np.int64).max
LONG = 512  # bytes from which on a sequence is merged by itself; the result does not depend on it


class Merges:
    """Ranks of pairs of symbols as one sorted array."""

    def __init__(self, vocab: vocabulary.Vocabulary):
        ids = vocab.ids
        self.of_byte = np.array([ids[s] for s in vocabulary.byte_symbols()], np.int64)
        self.size = np.int64(max(ids.values()) + 1)
        left, right = (np.array([ids[m[i]] for m in vocab.merges], np.int64) for i in (0, 1))
        keys = left * self.size + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order
        self.made = np.array([ids[a + b] for a, b in vocab.merges], np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NO_RANK)

    def counts(self, sequences: list[bytes]) -> np.ndarray:
        """Symbols that survive in each sequence; an empty sequence has none."""
        found = np.zeros(len(sequences), np.int64)
        short = [i for i, s in enumerate(sequences) if len(s) < LONG]
        found[short] = self._counts([sequences[i] for i in short])
        for i in set(range(len(sequences))).difference(short):
            found[i] = self._count_long(sequences[i])
        return found

    def _count_long(self, sequence: bytes) -> int:
        """One sequence: the places of each rank are merged at once, then the pairs beside them are ranked anew."""
        n = len(sequence)
        symbols = np.append(self.of_byte[np.frombuffer(sequence, np.uint8)], -1)
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        alive = np.ones(n, bool)
        places: dict[int, list[np.ndarray]] = {}
        waiting: list[int] = []

        def rank(lefts: np.ndarray) -> None:
            lefts = lefts[after[lefts] < n]
            ranks = self.rank(symbols[lefts], symbols[after[lefts]])
            order = np.argsort(ranks, kind="stable")
            order = order[: np.searchsorted(ranks[order], NO_RANK)]
            lefts, ranks = lefts[order], ranks[order]
            cuts = np.flatnonzero(np.diff(ranks)) + 1
            for some, r in zip(np.split(lefts, cuts), ranks[np.append(0, cuts)].tolist() if len(ranks) else ()):
                if r not in places:
                    places[r] = []
                    heapq.heappush(waiting, r)
                places[r].append(some)

        rank(np.arange(n - 1))
        while waiting:
            lowest = heapq.heappop(waiting)
            at = np.unique(np.concatenate(places.pop(lowest)))
            at = at[alive[at] & (after[at] < n)]
            at = at[self.rank(symbols[at], symbols[after[at]]) == lowest]
            if not len(at):
                continue
            at = at[_every_second(np.concatenate([[True], after[at[:-1]] != at[1:]]))]
            right = after[at]
            symbols[at], alive[right], after[at] = self.made[lowest], False, after[right]
            inner = after[at] < n
            before[after[at][inner]] = at[inner]
            beside = before[at]
            rank(np.unique(np.concatenate([beside[beside >= 0], at])))
        return int(alive.sum())

    def _counts(self, sequences: list[bytes]) -> np.ndarray:
        lengths = np.fromiter(map(len, sequences), np.int64, len(sequences))
        result = lengths.copy()
        symbols = self.of_byte[np.frombuffer(b"".join(sequences), np.uint8)]
        owner = np.repeat(np.arange(len(sequences)), lengths)
        while len(symbols):
            rank = np.full(len(symbols), NO_RANK)  # of the pair that begins here
            rank[:-1] = np.where(owner[1:] == owner[:-1], self.rank(symbols[:-1], symbols[1:]), NO_RANK)
            first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            sizes = np.diff(np.append(first, len(symbols)))
            lowest = np.minimum.reduceat(rank, first)
            result[owner[first]] = sizes
            going = lowest < NO_RANK
            if not going.any():
                break
            least = np.repeat(lowest, sizes)
            hit = (rank == least) & (least < NO_RANK)
            # Of overlapping places (x x x), every second counts, from the first of the run on.
            at = np.flatnonzero(hit)
            at = at[_every_second(np.concatenate([[True], np.diff(at) > 1]))]
            symbols[at] = self.made[rank[at]]
            keep = np.repeat(going, sizes)
            keep[at + 1] = False
            symbols, owner = symbols[keep], owner[keep]
        return result


def _every_second(begins: np.ndarray) -> np.ndarray:
    """The first, third .. place of each run, where runs begin as marked."""
    first = np.flatnonzero(begins)
    return (np.arange(len(begins)) - np.repeat(first, np.diff(np.append(first, len(begins))))) % 2 == 0


# A space beside other white space, or white space at an end: the text is split as a whole, else at its spaces.
_odd_space = re.compile(r" \s|\s |^\s|\s$")


class Counter:
    """Counts tokens of texts; keeps the counts of strings met before, up to a limit."""

    def __init__(self, vocab: vocabulary.Vocabulary):
        self.vocab, self.merges, self.known = vocab, Merges(vocab), {}

    def _units(self, text: str) -> list[str]:
        """Strings that are split by the pattern alone, whatever stands beside them."""
        if _odd_space.search(text):
            return vocabulary.split(vocabulary.BYTE_PATTERN, text)
        head, *rest = text.split(" ")
        return [head, *[" " + r for r in rest]] if head else []

    def _learn(self, units: set[str]) -> None:
        units = list(units)
        pieces = [[p.encode() for p in vocabulary.split(vocabulary.BYTE_PATTERN, u)] for u in units]
        distinct = list({p for some in pieces for p in some})
        counts = dict(zip(distinct, self.merges.counts(distinct).tolist()))
        if len(self.known) + len(units) > KEPT_COUNTS:
            self.known = {}
        self.known.update((u, sum(map(counts.__getitem__, some))) for u, some in zip(units, pieces))

    def count(self, texts: list[str]) -> list[int]:
        parts = [self.vocab.split_special(t) for t in texts]
        units = [[self._units(p) for p in some[::2]] for some in parts]
        unknown = {u for some in units for part in some for u in part}.difference(self.known)
        if len(self.known) + len(unknown) > KEPT_COUNTS:
            self.known, unknown = {}, {u for some in units for part in some for u in part}
        self._learn(unknown)
        known = self.known.__getitem__
        return [len(some) // 2 + sum(sum(map(known, part)) for part in parted) for some, parted in zip(parts, units)]


@lru_cache(2)
def counter(path: str) -> Counter:
    return Counter(vocabulary.load(path))


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """Tokens of each whole text by the vocabulary at ``path``; null counts as empty, which has none.

    One row for each row; nothing is shuffled. Special tokens in a text count as one.
    """

    def work(part, texts: Texts):
        counted = counter(path).count([t.decode() for t in texts.bytes()])
        return {"doc_id": part["doc_id"], "n_bytes": np.diff(texts.offsets), "n_tokens": counted}

    counted = by_slices(text_rows(docs, "doc_id"), work, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
