"""Quality rules: a decision list learned from labelled statistics of texts.

Sequential covering: a rule is a conjunction of thresholds that is grown on two thirds of the labelled rows until
it covers no wanted text, and pruned on the last third as long as that does not make it worse. The rows it covers
are taken away and the next rule is learned from the rest. The list becomes one ordered conditional expression of
Spark columns; what no rule covers is kept. Statistics are computed over whole texts, for all documents.
"""

from __future__ import annotations

import operator
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from litscreen.llm.texts import Texts, Words, by_slices, text_rows, with_struct

LABELLED_ROWS = 20_000  # rows that the list is fitted on at most: those with the smallest hash of their ID
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20
WINDOW = 5

#: Counts of one text. Shares are built of them below.
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_lines", "n_upper", "n_digits", "n_marks", "n_alone")
COUNT_COLUMNS = ", ".join(f"{name} long" for name in COUNTS)
STATISTICS = f"doc_id long, {COUNT_COLUMNS}"

_bytes = np.arange(256)
IS_SYMBOL = np.isin(_bytes, list(b"[#*$%&|<>]"[1:-1]))
IS_UPPER = (_bytes >= 65) & (_bytes <= 90)
IS_DIGIT = (_bytes >= 48) & (_bytes <= 57)
IS_MARK = np.isin(_bytes, list(b"!?;:=_@/\\^~`{}[]()\"'+-"))


def repeated(words: Words, size: int = WINDOW) -> np.ndarray:
    """Words that lie in a window of ``size`` words found twice or more in their text."""
    at, window = words.windows(words.hashes(), size)
    order = np.lexsort((window, words.text[at]))
    text, name = words.text[at][order], window[order]
    same = (text[1:] == text[:-1]) & (name[1:] == name[:-1])
    again = np.zeros(len(at), bool)
    again[1:] |= same
    again[:-1] |= same
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, at[order[again]], 1)
    np.add.at(change, at[order[again]] + size, -1)
    return np.cumsum(change)[:-1] > 0


def _lines(text: bytes) -> tuple[int, int]:
    """Lines with a word, and those of them equal to an earlier line."""
    lines = [line for line in text.split(b"\n") if line.strip(b" \t\n\x0b\x0c\r")]
    return len(lines), len(lines) - len(set(lines))


def text_counts(texts: Texts) -> dict[str, np.ndarray]:
    words = Words(texts)
    data = texts.data
    lines = np.array([_lines(t) for t in texts.bytes()], np.int64).reshape(-1, 2)
    of_words = lambda flags: np.bincount(words.text[flags], minlength=len(texts)).astype(np.int64)
    return {
        "n_words": words.counts,
        "word_chars": texts.sums(words.inside & ((data & 0xC0) != 0x80)),
        "n_symbols": texts.sums(IS_SYMBOL[data]),
        "n_dup_lines": lines[:, 1],
        "n_repeat_words": of_words(repeated(words)),
        "n_lines": lines[:, 0],
        "n_upper": texts.sums(IS_UPPER[data]),
        "n_digits": texts.sums(IS_DIGIT[data]),
        "n_marks": texts.sums(IS_MARK[data]),
        "n_alone": of_words(words.ends - words.starts == 1),
    }


def statistics(docs: DataFrame) -> DataFrame:
    """Counts of each text by ``doc_id``; a null text has none. One row for each row, nothing is shuffled."""
    return by_slices(text_rows(docs, "doc_id"), lambda part, texts: {"doc_id": part["doc_id"], **text_counts(texts)},
                     STATISTICS)


def base_failed(at: str = "") -> Column:
    """Too few words, or too many of them repeated. ``at`` stands before the names of the counts."""
    words = F.col(f"{at}n_words")
    return (words < MIN_WORDS) | (100 * F.col(f"{at}n_repeat_words") > MAX_REPEAT_PERCENT * words)


def features(at: str = "") -> dict[str, Column]:
    """What the thresholds are set on: shares of the counts, zero for a text without words."""
    count = lambda name: F.col(at + name).cast("double")
    share = lambda a, b: F.coalesce(F.try_divide(count(a), count(b)), F.lit(0.0))
    return {
        "words": count("n_words"),
        "word_length": share("word_chars", "n_words"),
        "symbols_per_word": share("n_symbols", "n_words"),
        "symbol_share": share("n_symbols", "word_chars"),
        "dup_line_share": share("n_dup_lines", "n_lines"),
        "repeat_share": share("n_repeat_words", "n_words"),
        "words_per_line": share("n_words", "n_lines"),
        "upper_share": share("n_upper", "word_chars"),
        "digit_share": share("n_digits", "word_chars"),
        "mark_share": share("n_marks", "word_chars"),
        "alone_share": share("n_alone", "n_words"),
    }


@dataclass(frozen=True)
class Threshold:
    feature: str
    above: bool
    value: float

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.feature] > self.value if self.above else x[self.feature] <= self.value

    def column(self, at: str = "") -> Column:
        x = features(at)[self.feature]
        return x > self.value if self.above else x <= self.value

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.value:g}"


Rule = tuple[Threshold, ...]


def covers(rule: Rule, x: dict[str, np.ndarray]) -> np.ndarray:
    n = len(next(iter(x.values())))
    return np.logical_and.reduce([t.holds(x) for t in rule], initial=True) & np.ones(n, bool)


def _best_threshold(x: dict[str, np.ndarray], bad: np.ndarray) -> tuple[float, Threshold | None]:
    """The threshold of the highest gain: bad rows kept, times what the share of bad rows grows by in bits."""
    p, n = bad.sum(), len(bad)
    best, chosen = 1e-9, None
    for name in sorted(x):
        order = np.argsort(x[name], kind="stable")
        value, hit = x[name][order], np.cumsum(bad[order])
        cuts = np.flatnonzero(value[1:] > value[:-1])
        if not len(cuts):
            continue
        for above in (True, False):
            kept_bad = p - hit[cuts] if above else hit[cuts]
            kept = n - cuts - 1 if above else cuts + 1
            gain = kept_bad * (np.log2(np.maximum(kept_bad, 1e-9) / kept) - np.log2(p / n))
            i = int(np.argmax(gain))
            if gain[i] > best:
                middle = (value[cuts[i]] + value[cuts[i] + 1]) / 2
                best, chosen = gain[i], Threshold(name, above, float(middle))
    return best, chosen


def _grow(x: dict[str, np.ndarray], bad: np.ndarray, longest: int) -> Rule:
    rule: Rule = ()
    held = np.ones(len(bad), bool)
    while len(rule) < longest and bad[held].any() and not bad[held].all():
        _, found = _best_threshold({k: v[held] for k, v in x.items()}, bad[held])
        if found is None:
            break
        rule += (found,)
        held &= found.holds(x)
    return rule


def _worth(rule: Rule, x: dict[str, np.ndarray], bad: np.ndarray) -> float:
    held = covers(rule, x)
    return (2.0 * bad[held].sum() - held.sum()) / max(1, held.sum())


def _prune(rule: Rule, x: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """Drop last conditions as long as the rule does not get worse on rows that it was not grown on."""
    worth = {k: _worth(rule[:k], x, bad) for k in range(1, len(rule) + 1)}
    return rule[: max(worth, key=lambda k: (worth[k], -k))] if worth else rule


def learn(x: dict[str, np.ndarray], bad: np.ndarray, *, precision: float = 0.9, least: int = 5, longest: int = 4,
          most: int = 16, seed: int = 7) -> list[Rule]:
    """Rules that reject. A rule stays if it covers ``least`` rows and is right in ``precision`` of them.

    No rows, or rows of one class only: an empty list, which keeps everything.
    """
    third = np.random.Generator(np.random.PCG64(seed)).random(len(bad)) < 1 / 3
    left, rules = np.ones(len(bad), bool), []
    while len(rules) < most and bad[left].any():
        pick = lambda flags: ({k: v[flags] for k, v in x.items()}, bad[flags])
        rule = _prune(_grow(*pick(left & ~third), longest), *pick(left & third))
        held = covers(rule, x) & left
        if not rule or held.sum() < least or bad[held].mean() < precision:
            break
        rules.append(rule)
        left &= ~held
    return rules


def labelled(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = LABELLED_ROWS) -> DataFrame:
    """Features and ``bad`` of at most ``rows`` labelled documents, by the hash of the ID; rows of one ID count once."""
    chosen = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .groupBy("doc_id").agg(F.min(label).alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    )
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id", "left_semi")
    # One row for each ID, whatever the number of its rows: the one of the least counts.
    one = statistics(texts).groupBy("doc_id").agg(F.min(F.struct(*COUNTS)).alias("least")).select("doc_id", "least.*")
    counted = one.join(F.broadcast(chosen), "doc_id")
    return counted.select(*[c.alias(n) for n, c in features().items()], (F.col("label") == 0).alias("bad"))


def fit(docs: DataFrame, labels: DataFrame, rows: int = LABELLED_ROWS) -> list[Rule]:
    """The decision list of a corpus. At most ``rows`` rows of a dozen numbers come to the driver."""
    found = labelled(docs, labels, rows=rows).toPandas()
    # The order in which rows arrive must not decide which third they are in.
    found = found.sort_values(list(found.columns), kind="stable")
    return learn({n: found[n].to_numpy(float) for n in features()}, found["bad"].to_numpy(bool))


def condition(rule: Rule, at: str = "") -> Column:
    return reduce(operator.and_, [t.column(at) for t in rule])


def verdict(rules: list[Rule], at: str = "") -> Column:
    """The first rule that holds rejects; without one the text is kept."""
    held = [condition(rule, at) for rule in rules]
    if not held:
        return F.lit(True)
    chain = F.when(held[0], F.lit(False))
    for column in held[1:]:
        chain = chain.when(column, F.lit(False))
    return chain.otherwise(F.lit(True))


def fired(rules: list[Rule]) -> Column:
    """The rule that rejects, as text; null if none does."""
    chain = F.lit(None).cast("string")
    for rule in reversed(rules):
        chain = F.when(condition(rule), F.lit(" and ".join(map(str, rule)))).otherwise(chain)
    return chain


def judge(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """Counts, ``base_failed``, ``kept`` and the ``rule`` that rejects, one row for each document.

    A null text has no words and fails the base rules; a row without an ID is judged like any other.
    """
    return statistics(docs).select(
        "doc_id", *COUNTS, base_failed().alias("base_failed"),
        (~base_failed() & verdict(rules)).alias("kept"), fired(rules).alias("rule"))


def kept_rows(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """The rows of ``docs`` that the base rules and the list keep, with all their columns."""
    counted, made = with_struct(docs, lambda part, texts: text_counts(texts), COUNT_COLUMNS)
    return counted.where(~base_failed(f"{made}.") & verdict(rules, f"{made}.")).drop(made)
