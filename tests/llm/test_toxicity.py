import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from litscreen.llm import toxicity
from litscreen.llm.texts import Texts
from odd import ODD

SCHEMA = "doc_id long, text string, score string, label string"


def _corpus(spark, n=1500, seed=3):
    """Prose in which some words, and one pair of words with a word between, make a text toxic."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("abdeilmnorstu") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    rows = []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(5, 60))]
        kind = rng.random()
        if kind < 0.1:
            text.insert(rng.randrange(len(text) + 1), rng.choice(["vilest", "Grubby"]))
        elif kind < 0.2:
            at = rng.randrange(len(text))
            text[at:at] = ["green", rng.choice(words), "goose"]
        elif kind < 0.4:
            text += [rng.choice(["green", "goose"])]
        rows.append((i, " ".join(text), int(kind < 0.2)))
    return rows


def _trainable(i):
    return zlib.crc32(str(i).encode()) % 4 != 2


def test_learns_words_and_skips(spark):
    rows = _corpus(spark)
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t, _ in rows], SCHEMA)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    assert 0 < len(model.names) < 2000 and (np.diff(model.names.astype(np.int64)) > 0).all()
    truth = {i: y for i, _, y in rows}
    found = toxicity.score(docs, model).collect()
    assert len(found) == len(rows) and {r.doc_id for r in found if r.held_out} == {i for i in truth if not _trainable(i)}
    held = [r for r in found if r.held_out]
    hit = np.mean([r.predicted == 1 for r in held if truth[r.doc_id]])
    wrong = np.mean([r.predicted == 1 for r in held if not truth[r.doc_id]])
    assert hit > 0.85 and wrong < 0.03


def test_held_out_labels_are_never_learned_from(spark):
    rows = _corpus(spark, 400)
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t, _ in rows], SCHEMA)
    schema = "doc_id long, toxic int"
    honest = toxicity.fit(docs, spark.createDataFrame([(i, y) for i, _, y in rows], schema))
    turned = toxicity.fit(docs, spark.createDataFrame([(i, y if _trainable(i) else 1 - y) for i, _, y in rows], schema))
    assert (honest.names == turned.names).all() and (honest.weights == turned.weights).all()


def test_weights_do_not_depend_on_partitions(spark):
    rows = _corpus(spark, 300)
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t, _ in rows], SCHEMA)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    one, other = (toxicity.fit(docs.repartition(n, F.rand(n)), labels) for n in (1, 7))
    assert (one.names == other.names).all() and (one.weights == other.weights).all()


def test_several_shards_and_blocks(spark, monkeypatch):
    rows = _corpus(spark)
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t, _ in rows], SCHEMA)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    monkeypatch.setattr(toxicity, "SHARD_ROWS", 400)
    monkeypatch.setattr(toxicity, "BLOCK", 40_000)
    truth = {i: y for i, _, y in rows}
    found = toxicity.score(docs, toxicity.fit(docs, labels)).where("held_out").collect()
    right = np.mean([r.predicted == truth[r.doc_id] for r in found])
    assert right > 0.93


def test_one_learner_equals_the_plain_rule():
    """A block against FTRL-proximal written with dictionaries."""
    rng = np.random.default_rng(5)
    rows = [np.unique(rng.integers(0, 60, 12)).astype(np.uint32) for _ in range(80)]
    labels = [int((row < 6).any()) for row in rows]
    rates = toxicity.Rates(passes=3, l1=0.5)
    learner = toxicity.Learner(rates, 0.5)
    learner.learn(rows, labels)
    z, n = {}, {}
    intercept, seen = 0.0, 0.0
    often = {f for f in range(60) if sum(f in row for row in rows) >= toxicity.LEAST_TEXTS}

    def weight(f):
        if abs(z.get(f, 0.0)) <= rates.l1:
            return 0.0
        return -(z[f] - np.sign(z[f]) * rates.l1) / ((rates.beta + n[f] ** 0.5) / rates.alpha + rates.l2)

    for _ in range(rates.passes):
        for row, label in zip(rows, labels):
            have = [f for f in row.tolist() if f in often]
            w = {f: weight(f) for f in have}
            g = 1 / (1 + np.exp(-(intercept + sum(w.values())))) - label
            for f in have:
                sigma = ((n.get(f, 0.0) + g * g) ** 0.5 - n.get(f, 0.0) ** 0.5) / rates.alpha
                z[f] = z.get(f, 0.0) + g - sigma * w[f]
                n[f] = n.get(f, 0.0) + g * g
            seen += g * g
            intercept -= g * rates.alpha / (10 * (rates.beta + seen**0.5))
    assert np.allclose(learner.weights(learner.z, learner.n), [weight(f) for f in learner.names.tolist()], atol=1e-9)


def test_scores_equal_a_plain_sum(spark):
    """Scores from sets of features of single texts, made one by one."""
    rng = np.random.default_rng(1)
    texts = [t or "" for t in ODD]
    each = [np.unique(toxicity.features(Texts(pa.array([t])))[1]) for t in texts]
    names = np.unique(rng.choice(np.concatenate(each), 400))
    model = toxicity.Model(names, rng.normal(size=len(names)), -0.5)
    weight = dict(zip(names.tolist(), model.weights.tolist()))
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(ODD)], SCHEMA)
    for row in toxicity.score(docs, model).collect():
        x = -0.5 + sum(weight.get(f, 0.0) for f in each[row.doc_id].tolist())
        assert row.score == pytest.approx(1 / (1 + np.exp(-x)), abs=1e-9) and 0 <= row.score <= 1


def test_odd_rows(spark):
    rows = [(None, "vile words", "a", "b"), (None, None, None, None), (1, "", "a", "b"), (1, "", "a", "b"), (1, "vile", None, "b"),
            (2, "x" * 100_000, "a", "b"), (3, "w " * 50_000, "a", "b")]
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(None, 1), (1, None), (1, 0), (1, 1), (2, 0), (9, 1)], "doc_id long, toxic int")
    found = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
    assert len(found) == len(rows) and not any(r.held_out for r in found if r.doc_id is None)
    assert all(r.predicted == int(r.score >= 0.3) for r in found)
    assert toxicity.score(docs.limit(0), toxicity.fit(docs.limit(0), labels)).count() == 0
    none = toxicity.fit(docs, labels.limit(0))
    assert {r.score for r in toxicity.score(docs, none).collect()} == {0.5}


def test_repeated_ids_of_a_label_stay_one_row(spark):
    docs = spark.range(3000).select(F.lit(4).cast("long").alias("doc_id"), F.concat(F.lit("some text "), "id").alias("text"))
    labels = spark.createDataFrame([(4, 1)], "doc_id long, toxic int")
    assert toxicity.sample(docs, labels).count() == (1 if _trainable(4) else 0) == 1


def test_query_on_whole_table(spark, data):
    from litscreen.llm.queries import op11_ftrl_toxicity

    rows = op11_ftrl_toxicity(spark, data).collect()
    assert len(rows) == spark.read.parquet(f"{data}/documents.parquet").count()
    assert all(r.held_out != _trainable(r.doc_id) and r.predicted == int(r.score >= 0.3) for r in rows)
