"""Vocabulary files of byte-level BPE: symbols, merges in order of rank, and special tokens."""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

import regex
from tokenizers import Tokenizer
from tokenizers.normalizers import Normalizer
from tokenizers.pre_tokenizers import PreTokenizer


def byte_symbols() -> list[str]:
    """The character that stands for each byte: itself if it is printable Latin-1, else one from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


@dataclass(frozen=True)
class Vocabulary:
    ids: dict[str, int]
    merges: list[tuple[str, str]]  # by rank
    special: dict[str, int]

    def split_special(self, text: str) -> list[str]:
        """Ordinary text and special tokens in turn; special tokens have the odd places."""
        if not any(s in text for s in self.special):
            return [text]
        longest_first = sorted(self.special, key=lambda s: (-len(s), s))
        return re.split("(" + "|".join(map(re.escape, longest_first)) + ")", text)


def load(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as file:
        found = json.load(file)
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in found["model"]["merges"]]
    special = {t["content"]: t["id"] for t in found["added_tokens"]}
    return Vocabulary(found["model"]["vocab"], merges, special)


#: The patterns that the vocabularies were made with.
BYTE_PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
WORD_PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
WORD_END = "</w>"
LETTER, DIGIT, SYMBOL = 0x4E00, 0x0660, 0xE000  # a code point of each class of the patterns


class _Assigned(dict):
    """Maps code points that Unicode does not assign to one without a class, and others to themselves."""

    def __missing__(self, code: int) -> int:
        self[code] = found = SYMBOL if unicodedata.category(chr(code)) == "Cn" else code
        return found


_assigned = _Assigned()


def split(pattern: regex.Pattern, text: str, classes: dict[int, int] = _assigned) -> list[str]:
    """Matches of the pattern. ``regex`` knows later letters than the vocabularies do; those count as symbols.

    ``classes`` maps each code point to one that the pattern is to take it for.
    """
    if text.isascii():
        return pattern.findall(text)
    return [text[m.start():m.end()] for m in pattern.finditer(text.translate(classes))]


class Later:
    """What the library that a vocabulary belongs to makes of characters that Python's Unicode does not assign.

    Its tables are of other versions of Unicode. Each such character is asked for when it is met first: ``lower`` maps
    it to its folded form, ``classes`` to a letter, a digit or a symbol that stands for it in the pattern.
    """

    def __init__(self, path: str):
        self.path = path
        self.lower, self.classes = _Asked(self._lower), _Asked(self._class)

    @cached_property
    def _library(self) -> tuple[Normalizer, PreTokenizer]:
        whole = Tokenizer.from_file(self.path)
        return whole.normalizer, whole.pre_tokenizer

    def _lower(self, character: str) -> str:
        return self._library[0].normalize_str(character)

    def _class(self, character: str) -> int:
        def pieces(text: str) -> int:
            return len(self._library[1].pre_tokenize_str(text))

        if pieces("a" + character) == 1:
            return LETTER
        return SYMBOL if pieces("!" + character) == 1 else DIGIT


class _Asked(dict):
    """Maps code points without a class to what ``ask`` says, and others to themselves."""

    def __init__(self, ask: Callable[[str], str | int]):
        super().__init__()
        self.ask = ask

    def __missing__(self, code: int) -> str | int:
        known = unicodedata.category(chr(code)) != "Cn"
        self[code] = found = code if known else self.ask(chr(code))
        return found
