"""Substring dedup by recompression.

Rounds of recompression give every text a parse into symbols. A round names the runs of two equal words, or, after a
fixed random partition of all names into left and right ones, every pair of a left and a right name. Names are hashes
of what they stand for, so they are the same in all tasks, and a name depends on nothing but its neighbours: inside
two equal substrings the same symbols arise, apart from a few words at the ends. A round only takes names of up to a
number of words, which bounds how many words it can spoil at an end: ``LOSS`` for all rounds.

So two equal windows of ``WINDOW`` words share a symbol boundary among their first ``LOSS`` words and one among their
last, and all symbols between the two. The symbols behind a boundary, as many as fit into ``INSIDE`` words, are named
once more: such names that occur twice or more reveal long repeats. Only windows around them are verified, by 96 bits of
a name of the whole window: its symbols from the first boundary behind ``LOSS`` words to the last one before the last
``LOSS``, which all equal windows share, and the single words on both sides. The first occurrence of each is kept.

Texts are dealt into groups by the hash of ID and text. Groups send names in one array for each bucket of hashes, each
name once, so that no passage is ever gathered in one task however often it occurs; what comes back is one bit for
each name sent. Texts are shuffled once, and arrays are bounded by the size of a group and of a bucket.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from litscreen.llm.texts import BASE, SLICE_BYTES, Texts, Words, mix, powers, slices, text_rows

WINDOW = 20
RUN = 2  # words of a run that is named; of a longer run a window does not see the ends
CAPS = (1, 2)  # longest symbols, in words, that the rounds of pairs take
LOSS = RUN + sum(CAPS)
INSIDE = WINDOW - 2 * LOSS  # words of a window whose symbols do not depend on what stands around it, at least
SECOND_BASE = 0xD6E8FEB86659FD93
GROUP_BYTES = 8 << 20  # text that a group is meant to have
NO_ID = 2**63 - 1  # missing IDs come last
KEY_BITS = np.uint64((1 << 48) - 1)  # of a phrase; a wrong match only costs a verification


# ---------------------------------------------------------------- parse of one group

def parse(names: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words at which the symbols of the parse begin, and the names of the symbols.

    ``text`` tells texts apart; no symbol reaches over its end.
    """
    names, first = names.copy(), np.arange(len(names))
    span = np.ones(len(names), np.int64)

    def merge(hit: np.ndarray) -> None:
        nonlocal names, first, span, text
        at = np.flatnonzero(hit)
        names[at] = mix(names[at] * np.uint64(3) + mix(names[at + 1]))
        span[at] += span[at + 1]
        keep = np.ones(len(names), bool)
        keep[at + 1] = False
        names, first, span, text = names[keep], first[keep], span[keep], text[keep]

    if len(names) > 1:
        same = np.zeros(len(names) + 1, bool)
        same[1:-1] = (names[1:] == names[:-1]) & (text[1:] == text[:-1])
        merge(same[1:-1] & ~same[:-2] & ~same[2:])
    for number, cap in enumerate(CAPS):
        right = mix(names + np.uint64(number)) >> np.uint64(63) == 1
        taken = span <= cap
        left = taken & ~right
        right &= taken
        merge(left[:-1] & right[1:] & (text[1:] == text[:-1]))
    return first, names


class Sums:
    """Hashes of stretches of a sequence of names, from the sums of its beginnings."""

    def __init__(self, names: np.ndarray, base: int):
        n = len(names)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(names * powers(base, n)[:n])])
        self.back = powers(pow(base, -1, 2**64), n)

    def __call__(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[begin]) * self.back[begin])


class Group:
    """Texts of a group in the order of ID and text, with what every step computes of them anew."""

    def __init__(self, table: pa.Table):
        ids = table["doc_id"].combine_chunks()
        order = np.lexsort((np.asarray(pc.rank(table["text"], "ascending")), np.asarray(ids.fill_null(NO_ID)),
                            np.asarray(ids.is_null())))
        table = table.take(pa.array(order)).combine_chunks()
        self.ids = table["doc_id"].combine_chunks()
        self.order_ids = np.asarray(self.ids.fill_null(NO_ID))
        self.texts = table["text"].combine_chunks()
        names, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for batch in table.select(["text"]).to_batches():
            for _, part in slices(batch, size=SLICE_BYTES):
                words = Words(part)
                names.append(words.hashes())
                counts.append(words.counts)
        self.names, self.counts = np.concatenate(names), np.concatenate(counts)
        self.text = np.repeat(np.arange(len(self.counts)), self.counts)
        self.end = np.repeat(np.cumsum(self.counts), self.counts)  # of the text of each word

        self.first, self.symbols = parse(self.names, self.text)
        self.borders = np.append(self.first, len(self.names))

    def phrases(self) -> tuple[np.ndarray, np.ndarray]:
        """Boundaries with ``INSIDE`` words behind them, and the name of the symbols that lie in these words."""
        begin = np.flatnonzero(self.first + INSIDE <= self.end[self.first]) if len(self.first) else self.first
        at = self.first[begin]
        end = np.searchsorted(self.borders, at + INSIDE, "right") - 1
        return at, Sums(self.symbols, BASE)(begin, end) & KEY_BITS

    def around(self, at: np.ndarray) -> np.ndarray:
        """Begins of the windows that may share the symbols behind one of these boundaries."""
        change = np.zeros(len(self.names) + 1, np.int64)
        begin = self.end[at] - self.counts[self.text[at]]
        np.add.at(change, np.maximum(at - LOSS, begin), 1)
        np.add.at(change, at + 1, -1)
        wanted = np.cumsum(change)[:-1] > 0
        return np.flatnonzero(wanted & (np.arange(len(self.names)) + WINDOW <= self.end))

    def _names(self, at: np.ndarray, base: int) -> np.ndarray:
        """Of whole windows: words before the first boundary that all equal ones share, symbols, words behind the last."""
        begin = np.searchsorted(self.borders, at + LOSS)
        end = np.searchsorted(self.borders, at + WINDOW - LOSS, "right") - 1
        words, symbols = Sums(self.names, base), Sums(self.symbols, base)
        head, tail = words(at, self.borders[begin]), words(self.borders[end], at + WINDOW)
        return mix(mix(head * np.uint64(3) + symbols(begin, end)) * np.uint64(3) + tail)

    def windows(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Two names of each window, and whether it is the first of its kind in the group."""
        name = self._names(at, BASE)
        check = (self._names(at, SECOND_BASE) >> np.uint64(32)).astype(np.uint32)
        order = np.lexsort((check, name))  # stable: equal windows stay in the order of places
        again = np.zeros(len(at), bool)
        again[order[1:]] = (name[order[1:]] == name[order[:-1]]) & (check[order[1:]] == check[order[:-1]])
        return name, check, ~again


def _by_bucket(names: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of names by bucket, the buckets that occur, and where each begins in that order."""
    bucket = names % np.uint64(buckets)
    order = np.argsort(bucket, kind="stable")
    found, begin = np.unique(bucket[order], return_index=True)
    return order, found.astype(np.int64), np.append(begin, len(order))


def _bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def _flags(bits: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(bits, np.uint8), count=n).astype(bool)


def _restored(answers: dict[int, bytes], names: np.ndarray, buckets: int) -> np.ndarray:
    """Bits that came back bucket by bucket, in the order of ``names``."""
    flags = np.zeros(len(names), bool)
    order, found, begin = _by_bucket(names, buckets)
    for bucket, a, b in zip(found.tolist(), begin[:-1], begin[1:]):
        flags[order[a:b]] = _flags(answers[bucket], b - a)
    return flags


# ---------------------------------------------------------------- steps

def _send_phrases(buckets: int):
    def step(key: tuple, table: pa.Table) -> pa.Table:
        group = Group(table)
        names = np.unique(group.phrases()[1])
        order, found, begin = _by_bucket(names, buckets)
        short = names[order].view(np.uint16).reshape(-1, 4)[:, :3]
        return pa.table({
            "bucket": found, "grp": np.full(len(found), key[0].as_py()),
            "names": pa.array([short[a:b].tobytes() for a, b in zip(begin[:-1], begin[1:])], pa.binary())})
    return step


def _meet_phrases(table: pa.Table) -> pa.Table:
    """Whether a phrase was sent by another group too."""
    sent = table["names"].to_pylist()
    short = np.frombuffer(b"".join(sent), np.uint16).reshape(-1, 3)
    names = np.zeros((len(short), 4), np.uint16)
    names[:, :3] = short
    names = names.view(np.uint64).ravel()
    order = np.argsort(names, kind="stable")
    same = names[order[1:]] == names[order[:-1]]
    shared = np.zeros(len(names), bool)
    shared[order[1:]] |= same
    shared[order[:-1]] |= same
    ends = np.cumsum([len(s) // 6 for s in sent])
    return pa.table({"grp": table["grp"], "bucket": table["bucket"],
                     "bits": pa.array([_bits(f) for f in np.split(shared, ends[:-1])], pa.binary())})


def _send_windows(buckets: int):
    """Windows around shared phrases go to the buckets of their hashes; which they are goes along for the group itself."""
    def step(key: tuple, texts: pa.Table, answers: pa.Table) -> pa.Table:
        group, own = Group(texts), key[0].as_py()
        at, phrase = group.phrases()
        names, index, count = np.unique(phrase, return_inverse=True, return_counts=True)
        shared = _restored(dict(zip(answers["bucket"].to_pylist(), answers["bits"].to_pylist())), names, buckets) | (count > 1)
        at = group.around(at[shared[index]])
        name, check, first = group.windows(at)
        place = np.zeros(len(group.names), bool)
        place[at] = True
        name, check, ids = name[first], check[first], group.order_ids[group.text[at[first]]]
        order, found, begin = _by_bucket(name, buckets)
        low = int(ids.min()) if len(ids) else 0
        wide = len(ids) and int(ids.max()) - low >= 2**32
        ids = ids if wide else (ids - low).astype(np.uint32)
        cut = lambda x: [x[order[a:b]].tobytes() for a, b in zip(begin[:-1], begin[1:])]
        n = len(found)
        return pa.table({
            "bucket": np.append(found, own % buckets), "grp": np.full(n + 1, own), "sent": np.append(np.ones(n, bool), False),
            "names": pa.array([*cut(name), None], pa.binary()), "checks": pa.array([*cut(check), None], pa.binary()),
            "ids": pa.array([*cut(ids), None], pa.binary()), "low": np.full(n + 1, low),
            "bits": pa.array([None] * n + [_bits(place)], pa.binary())})
    return step


_WINDOWS = "bucket long, grp long, sent boolean, names binary, checks binary, ids binary, low long, bits binary"


def _meet_windows(table: pa.Table) -> pa.Table:
    """Whether a window occurs earlier, in a text of a smaller ID of another group. Other rows pass through."""
    sent = table.filter(table["sent"])
    names, checks = [b"".join(sent[c].to_pylist()) for c in ("names", "checks")]
    names, checks = np.frombuffer(names, np.uint64), np.frombuffer(checks, np.uint32)
    sizes, ids = [], [np.zeros(0, np.int64)]
    for name, raw, low in zip(sent["names"].to_pylist(), sent["ids"].to_pylist(), sent["low"].to_pylist()):
        n = len(name) // 8
        sizes.append(n)
        ids.append(np.frombuffer(raw, np.int64 if len(raw) == 8 * n else np.uint32).astype(np.int64) + (0 if len(raw) == 8 * n else low))
    groups = np.repeat(sent["grp"].to_numpy(), sizes)
    order = np.lexsort((groups, np.concatenate(ids), checks, names))
    later = np.zeros(len(names), bool)
    later[order[1:]] = (names[order[1:]] == names[order[:-1]]) & (checks[order[1:]] == checks[order[:-1]])
    bits = [_bits(f) for f in np.split(later, np.cumsum(sizes)[:-1])] if sizes else []
    own = table.filter(pc.invert(table["sent"])).select(["grp", "bucket", "sent", "bits"])
    return pa.concat_tables([
        own, pa.table({"grp": sent["grp"], "bucket": sent["bucket"], "sent": sent["sent"], "bits": pa.array(bits, pa.binary())})])


def _remove(buckets: int):
    def step(key: tuple, texts: pa.Table, answers: pa.Table) -> pa.Table:
        group = Group(texts)
        came = answers.to_pylist()
        place = next((r["bits"] for r in came if not r["sent"]), b"")
        at = np.flatnonzero(_flags(place, len(group.names))) if place else np.zeros(0, np.int64)
        name, _, first = group.windows(at)
        repeated = ~first
        repeated[first] = _restored({r["bucket"]: r["bits"] for r in came if r["sent"]}, name[first], buckets)
        change = np.zeros(len(group.names) + 1, np.int64)
        np.add.at(change, at[repeated], 1)
        np.add.at(change, at[repeated] + WINDOW, -1)
        covered = np.cumsum(change)[:-1] > 0
        kept = []
        for text, keep in zip(group.texts, np.split(~covered, np.cumsum(group.counts)[:-1])):
            words = text.as_py().encode().split()
            kept.append(b" ".join([w for w, k in zip(words, keep.tolist()) if k] if not keep.all() else words).decode())
        removed = np.bincount(group.text[covered], minlength=len(group.counts)).astype(np.int64)
        return pa.table({"doc_id": group.ids, "n_words": group.counts, "n_removed": removed, "kept": pa.array(kept, pa.string())})
    return step


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed`` and the ``kept`` words of each text, joined by one space.

    A word goes if a window over it has the words of a window that begins earlier: in a text of a smaller ID, or
    before it in the same text. A null text has no words. Rows without an ID come last; rows with the same ID come in
    an order of their texts that is fixed, by hash first, so of two equal rows one keeps its words. Rows of one ID are
    dealt out by their texts, so only rows that are equal in both are held together. One row for each row.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(1, math.ceil(size / GROUP_BYTES))
    buckets = max(1, groups // 2)
    spread = F.pmod(F.xxhash64("doc_id", "text"), F.lit(groups))
    texts = text_rows(docs, "doc_id").withColumn("grp", spread).repartition("grp")
    by_group = texts.groupBy("grp")
    shared = (
        by_group.applyInArrow(_send_phrases(buckets), "bucket long, grp long, names binary")
        .groupBy("bucket").applyInArrow(_meet_phrases, "grp long, bucket long, bits binary")
    )
    later = (
        by_group.cogroup(shared.groupBy("grp")).applyInArrow(_send_windows(buckets), _WINDOWS)
        .groupBy("bucket").applyInArrow(_meet_windows, "grp long, bucket long, sent boolean, bits binary")
    )
    return by_group.cogroup(later.groupBy("grp")).applyInArrow(
        _remove(buckets), "doc_id long, n_words long, n_removed long, kept string")
