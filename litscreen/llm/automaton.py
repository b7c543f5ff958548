"""BPE as a deterministic automaton over tokens.

The automaton begins with one state that every base symbol leads back to. Each merge, in order of rank, puts in one
gadget: where the right token could follow the left one, the left token now leads to a copy of its state without the
arc of the right one, and every state with an arc of the left token gets an arc of the merged token, to where the
right token leads. At the end exactly one path reads a given word, and its arc labels are the BPE tokens.

All arcs of a token lead to one state, and a state lacks an arc only if a gadget took it away or the arc was made
from one taken away before. With the tokens numbered so that those made later from a token stand next behind it, what
a gadget takes away is one interval of numbers. The table of a state is thus a short sorted list of intervals.

A word is read from left to right. The prefix up to each place has one path, so one arc leads to the place, and it is
found by trying the tokens that end there against the tables. Decoding joins the labels of the arcs.
"""

from __future__ import annotations

import unicodedata
from array import array
from bisect import bisect_right
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from litscreen.llm import vocabulary
from litscreen.llm.texts import Texts, by_slices, text_rows, with_struct

START = 0
KEPT_WORDS, KEPT_ARCS = 300_000, 1_000_000  # what a worker keeps at once; results do not depend on it


class Automaton:
    """States by token (``target``) and the tokens that each state lacks, as bounds of intervals of ``number``."""

    def __init__(self, vocab: vocabulary.Vocabulary):
        ids, n = vocab.ids, max(vocab.ids.values()) + 1
        merges = [(ids[a], ids[b], ids[a + b]) for a, b in vocab.merges]
        self.number, after = self._numbers(n, merges)
        self.target, self.dead = [START] * n, set()
        above, taken = [START], [(0, 0)]  # of each state: the one it is a copy of, and the interval it lacks besides
        for rank, (left, right, made) in enumerate(merges):
            state, follows = self.target[left], self.target[right]
            at, lacks = state, False
            while at and not lacks:
                lacks = taken[at][0] <= self.number[right] < taken[at][1]
                at = above[at]
            if lacks or left in self.dead or right in self.dead:
                self.dead.add(made)  # the pair never stands side by side
                continue
            above.append(state)
            taken.append((self.number[right], after[rank]))
            self.target[left], self.target[made] = len(above) - 1, follows
        self.bounds = {state: self._union(state, above, taken) for state in set(self.target)}
        # Tokens by string: those that end a word, and the others with all their beginnings (-1 if only a beginning).
        end = vocabulary.WORD_END
        alive = {s: i for s, i in ids.items() if i not in self.dead}
        self.last = {s.removesuffix(end): i for s, i in alive.items() if s.endswith(end)}
        self.inner = {s[:k]: -1 for s in alive if not s.endswith(end) for k in range(1, len(s))}
        self.inner |= {s: i for s, i in alive.items() if not s.endswith(end)}
        self.longest = max(map(len, self.last))
        self.arcs: dict[int, bool] = {}
        self.size = n

    @staticmethod
    def _numbers(n: int, merges: list[tuple[int, int, int]]) -> tuple[list[int], list[int]]:
        """Numbers of the tokens, and by merge the end of the numbers that its gadget takes from its right token on.

        A token is followed by those made with it on the left, the latest first, each with its own behind it.
        """
        size = [1] * n
        for left, _, made in reversed(merges):  # a merged token is complete before the token on its left
            size[left] += size[made]
        later = [1] * n  # numbers taken so far by a token and those made from it, from the latest merge back
        offset, reach = [0] * n, [0] * len(merges)
        made_set = {made for _, _, made in merges}
        for rank in range(len(merges) - 1, -1, -1):
            left, right, made = merges[rank]
            offset[made] = later[left]
            later[left] += size[made]
            reach[rank] = later[right]  # tokens made from the right one by this merge or later ones
        number, next_root = [0] * n, 0
        for token in range(n):
            if token not in made_set:
                number[token], next_root = next_root, next_root + size[token]
        for left, _, made in merges:
            number[made] = number[left] + offset[made]
        return number, [number[right] + reach[rank] for rank, (_, right, _) in enumerate(merges)]

    @staticmethod
    def _union(state: int, above: list[int], taken: list[tuple[int, int]]) -> list[int]:
        found = []
        while state:
            found.append(taken[state])
            state = above[state]
        bounds: list[int] = []
        for first, end in sorted(found):
            if bounds and first <= bounds[-1]:
                bounds[-1] = max(bounds[-1], end)
            else:
                bounds += [first, end]
        return bounds

    def has_arc(self, state: int, token: int) -> bool:
        key = state * self.size + token
        found = self.arcs.get(key)
        if found is None:
            if len(self.arcs) >= KEPT_ARCS:
                self.arcs.clear()
            found = self.arcs[key] = bisect_right(self.bounds[state], self.number[token]) % 2 == 0
        return found

    def path(self, word: str) -> list[int]:
        """Arc labels of the path of a word of base symbols; the last one carries the end of the word."""
        n, size, arcs = len(word), self.size, self.arcs
        states, labels, begins = [-1] * (n + 1), [-1] * (n + 1), [0] * (n + 1)
        states[0] = START
        for at in range(n):
            state = states[at]
            for to in range(at + 1, n):
                token = self.inner.get(word[at:to])
                if token is None:
                    break  # no token begins like this
                if token >= 0 and states[to] < 0:
                    known = arcs.get(state * size + token)
                    if known or known is None and self.has_arc(state, token):
                        states[to], labels[to], begins[to] = self.target[token], token, at
            if n - at <= self.longest and labels[n] < 0:
                token = self.last.get(word[at:])
                if token is not None and self.has_arc(state, token):
                    labels[n], begins[n] = token, at
        if n and labels[n] < 0:
            raise ValueError(f"no path reads {word!r}")
        found = []
        while n:
            found.append(labels[n])
            n = begins[n]
        return found[::-1]


_separators = regex.compile(r"\s+")
_python_only_space = regex.compile(r"[\x1c-\x1f]")


class Codec:
    """Encodes whole texts and decodes ids; keeps the ids of words met before, up to a limit."""

    def __init__(self, path: str):
        vocab = vocabulary.load(path)
        self.vocab, self.automaton, self.known, self.pieces = vocab, Automaton(vocab), {}, {}
        self.later = vocabulary.Later(path)
        self.symbols = vocabulary.byte_symbols()
        labels = {i: s for s, i in [*vocab.ids.items(), *vocab.special.items()]}
        self.labels = np.array([labels.get(i, "") for i in range(max(labels) + 1)], object)

    def _word(self, word: str) -> bytes:
        """Ids of a word without white space: normal form, lower case letter by letter, split, bytes as symbols."""
        if word.isascii():
            pieces = vocabulary.WORD_PATTERN.findall(word.lower())
        else:
            word = unicodedata.normalize("NFC", word).replace("Σ", "σ").lower().translate(self.later.lower)
            pieces = ["".join([self.symbols[b] for b in p.encode()]) if not p.isascii() else p
                      for p in vocabulary.split(vocabulary.WORD_PATTERN, word, self.later.classes)]
        return b"".join([self.pieces.get(p) or self._piece(p) for p in pieces])

    def _piece(self, piece: str) -> bytes:
        if piece.isascii() and not piece.isprintable():
            piece = "".join([self.symbols[b] for b in piece.encode()])
        if len(self.pieces) >= KEPT_WORDS:
            self.pieces.clear()
        found = self.pieces[piece] = array("i", self.automaton.path(piece)).tobytes()
        return found

    def _ordinary(self, text: str) -> bytes:
        words = _separators.split(text) if _python_only_space.search(text) else text.split()
        known = self.known
        try:
            return b"".join(map(known.__getitem__, words))
        except KeyError:
            pass
        if len(known) >= KEPT_WORDS:
            known.clear()
        new = {w: self._word(w) for w in set(words).difference(known)}
        known.update(new)
        return b"".join(map(known.__getitem__, words))

    def encode(self, text: str) -> np.ndarray:
        parts = [
            array("i", [self.vocab.special[part]]).tobytes() if i % 2 else self._ordinary(part)
            for i, part in enumerate(self.vocab.split_special(text))
        ]
        return np.frombuffer(b"".join(parts), np.int32)

    def decode(self, ids: np.ndarray) -> str:
        """Labels joined by one space, special tokens included."""
        return " ".join(self.labels[ids].tolist())


@lru_cache(2)
def codec(path: str) -> Codec:
    return Codec(path)


def _columns(path: str, texts: Texts, decode: bool) -> dict:
    own = codec(path)
    ids = [own.encode(t.decode()) for t in texts.bytes()]
    offsets = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
    found = {"n_tokens": np.diff(offsets).astype(np.int64), "ids": pa.ListArray.from_arrays(offsets, np.concatenate(ids))}
    return found | ({"decoded": pa.array(map(own.decode, ids), pa.string())} if decode else {})


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``docs`` with ``n_tokens`` and ``ids`` of the whole text in place of columns of these names; null counts as empty."""
    docs = docs.drop("n_tokens", "ids")
    encoded, made = with_struct(docs, lambda part, texts: _columns(path, texts, False), "n_tokens long, ids array<int>")
    return encoded.select(*[encoded[c] for c in docs.columns], f"{made}.n_tokens", f"{made}.ids")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids`` and the text ``decoded`` from them. One row for each row, no shuffle."""
    return by_slices(text_rows(docs, "doc_id"), lambda part, texts: {"doc_id": part["doc_id"], **_columns(path, texts, True)},
                     "doc_id long, n_tokens long, ids array<int>, decoded string")
