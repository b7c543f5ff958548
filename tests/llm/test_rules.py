import re
from collections import Counter

import numpy as np
import pytest

from litscreen.llm import rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = [None, "", " \n\t", "a", "one two three four five one two three four five x y", "x\nx\n\nx \n \n \nx", "é ü ß z\n##|<>&%$*",
         "a b c d e " * 50, "w" * 5000 + " " + "w" * 5000, "a " * 30000, "\x0b\x0c\r\n", "Ünï\r\nÜnï\r\nend"]


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 5)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def check(row, text):
    n, chars, symbols, lines, again = brute(text)
    assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == (n, chars, symbols, lines, again)
    assert row.base_failed == (n < 10 or 100 * again > 20 * n)


def test_counts_of_odd_texts(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)] + [(None, "a", "x"), (0, None, "x")],
                                 "doc_id long, text string, n_words string")
    rows = rules.judge(docs, []).collect()
    assert len(rows) == len(TEXTS) + 2
    for row in rows:
        if row.doc_id is not None:
            check(row, TEXTS[row.doc_id])
        assert row.kept == (not row.base_failed) and row.rule is None
    assert rules.judge(docs.limit(0), []).count() == 0


def test_query_on_whole_table(spark, data):
    from litscreen.llm.queries import op1_quality_rules

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    rows = op1_quality_rules(spark, data).collect()
    assert len(rows) == len(texts)
    for row in rows:
        check(row, texts[row.doc_id])
    labels = {r.doc_id: r for r in spark.read.parquet(f"{data}/labels.parquet").collect()}
    seen = [(labels[r.doc_id].quality, r.kept) for r in rows if r.doc_id in labels]
    assert np.mean([kept for quality, kept in seen if quality == 1]) > 0.93


def test_learns_the_rule(spark):
    rng = np.random.default_rng(1)
    x = {"a": rng.random(3000), "b": rng.random(3000), "noise": rng.random(3000)}
    bad = ((x["a"] > 0.7) & (x["b"] <= 0.4)) | (x["b"] > 0.9)
    found = rules.learn(x, bad)
    predicted = np.logical_or.reduce([rules.covers(rule, x) for rule in found])
    assert (predicted == bad).mean() > 0.98 and not any(t.feature == "noise" for rule in found for t in rule[:2])


@pytest.mark.parametrize("bad", [np.zeros(50, bool), np.ones(50, bool), np.zeros(0, bool)])
def test_one_class_or_nothing(bad):
    x = {"a": np.arange(len(bad), dtype=float), "flat": np.ones(len(bad))}
    assert rules.learn(x, bad) == []


def test_without_labels(spark, data):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, None), (None, 0)], "doc_id long, quality int")
    assert rules.fit(docs, labels) == []


def test_kept_rows_keep_all_columns(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    docs = docs.withColumnRenamed("lang", "made").withColumnRenamed("source", "kept")
    found = rules.fit(docs, spark.read.parquet(f"{data}/labels.parquet"))
    kept = rules.kept_rows(docs, found)
    assert kept.columns == docs.columns
    judged = {r.doc_id for r in rules.judge(docs, found).where("kept").collect()}
    assert {r.doc_id for r in kept.collect()} == judged and 0 < len(judged) < docs.count()


def test_an_id_of_many_rows_is_one_row_of_the_fit(spark):
    docs = spark.range(3000).selectExpr("if(id % 3 = 0, 7L, id) AS doc_id", "concat('text ', id % 5) AS text")
    labels = spark.createDataFrame([(7, 0), (8, 1)], "doc_id long, quality int")
    assert rules.labelled(docs, labels).count() == 2
