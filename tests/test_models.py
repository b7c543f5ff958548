import datetime
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from litscreen import schemas, settings
from litscreen.functions import scores
from litscreen.operators import encode, ensemble, evaluate, heads
from litscreen.plans import jobs
from litscreen.sources import tables


def test_clip_keeps_missing(spark):
    df = spark.createDataFrame([(-0.5,), (0.3,), (1.7,), (None,), (float("nan"),)], "x double")
    assert [r[0] for r in df.select(scores.clip(F.col("x"))).collect()] == [0.0, 0.3, 1.0, None, None]


def test_thresholds_are_inclusive_and_missing_fails(spark):
    rows = [("a", 0.7, 0.4), ("b", 0.69, 0.9), ("c", 0.9, 0.39), ("d", None, 0.9), ("e", 1.0, 1.0)]
    df = spark.createDataFrame(rows, "ID string, Predicted_AwT_score double, Predicted_SoE_score double")
    assert [r.ID for r in heads.keep_relevant(df).collect()] == ["a", "e"]
    assert heads.keep_relevant(df).columns == ["ID", *settings.PREDICTED_COLUMNS]
    assert [r.ID for r in heads.keep_relevant(df, {"Predicted_AwT_score": 0.95}).collect()] == ["e"]


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(3)
    x, w, b = rng.normal(size=(40, 5)), rng.normal(size=(4, 2, 5)), rng.normal(size=(4, 2))
    rows = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "ID int, v array<float>")
    table = spark.createDataFrame(
        [(m, t, float(b[m, k]), [float(v) for v in w[m, k]]) for m in range(4) for k, t in enumerate(settings.SCORE_COLUMNS)],
        schemas.HEADS,
    )
    raw = np.einsum("nd,mkd->nmk", x.astype("float32").astype(float), w) + b
    return rows, table, raw


def test_heads_and_means(spark, vectors):
    rows, table, raw = vectors
    out = heads.member_outputs(rows, table, "v").orderBy("ID").collect()
    np.testing.assert_allclose([r.AwT_score_members for r in out], raw[:, :, 0], atol=1e-12)
    scored = heads.score(rows, table, "v").orderBy("ID").collect()
    np.testing.assert_allclose([r.Predicted_SoE_score for r in scored], raw[:, :, 1].mean(axis=1).clip(0, 1), atol=1e-12)
    outputs = heads.member_outputs(rows, table, "v")
    for link, f in (("identity", lambda y: y.mean(axis=1).clip(0, 1)), ("sigmoid", lambda y: (1 / (1 + np.exp(-y))).mean(axis=1))):
        got = ensemble.averaged(outputs, ("a", "s"), link).orderBy("ID").collect()
        np.testing.assert_allclose([(r.a, r.s) for r in got], f(raw), atol=1e-12)
    with pytest.raises(ValueError):
        heads.ensemble_mean(F.col("x"), "log")


def test_members_in_python(spark, vectors):
    rows, _, _ = vectors

    def members():
        return [lambda x, k=k: np.stack([x.sum(axis=1) * k, x[:, 0]], axis=1) for k in (1, 2)]

    got = rows.select("v", ensemble.predict_batches("v", members, 5).alias("y")).collect()
    for r in got:
        total = sum(r.v)
        np.testing.assert_allclose(r.y, [total, r.v[0], 2 * total, r.v[0]], atol=1e-5)


def test_vocabulary_and_encoding(spark):
    docs = spark.createDataFrame(
        [(1, "b a b. c"), (2, ""), (3, "B " * 600), (4, None)], "id int, text string"
    )
    vocab = encode.vocabulary(docs, "text", 3)
    assert [(r.term, r.n, r.token_id) for r in vocab.orderBy("token_id").collect()] == [("b", 602, 4), (".", 1, 5), ("a", 1, 6)]
    encoded = encode.encode(docs.filter("id < 4"), vocab, "id", "text", slots=2)
    got = {r.id: r.input_ids for r in encoded.collect()}
    assert got == {1: [2, 4, 6, 4, 5, 1, 3], 2: [2, 3], 3: [2] + [4] * 510 + [3]}
    padded = {r.id: r for r in encode.pad(encoded).collect()}
    assert all(len(r.input_ids) == len(r.attention_mask) == 512 for r in padded.values())
    assert padded[2].input_ids == [2, 3] + [0] * 510 and sum(padded[1].attention_mask) == 7
    short = encode.encode(docs.filter("id = 1"), vocab, "id", "text", max_tokens=4)
    assert encode.pad(short, 6).first().input_ids == [2, 4, 6, 3, 0, 0]


def test_a_vocabulary_beyond_the_bound_gives_the_same_ids(spark):
    rows = [(1, "b a b. c"), (2, ""), (3, "B " * 600), (4, None), (1, "a"), (None, "c d e f"), (1, "a"), (7, "the " * 40 + "rare")]
    docs = spark.createDataFrame(rows, "id int, text string").repartition(3)
    vocab = encode.vocabulary(docs, "text", 4)
    plain = sorted(map(repr, encode.encode(docs, vocab, "id", "text").collect()))
    joined = encode.encode(docs, vocab, "id", "text", most_terms=3)
    assert sorted(map(repr, joined.collect())) == plain and len(plain) == len(rows)
    assert sorted(map(repr, encode.encode(docs, vocab, "id", "text", terms=5, most_terms=4).collect())) == plain
    assert sorted(map(repr, encode.encode(docs, vocab, "id", "text", max_tokens=4, most_terms=0).collect())) == \
        sorted(map(repr, encode.encode(docs, vocab, "id", "text", max_tokens=4).collect()))


def test_summaries_leave_out_the_long_tail(spark):
    """A few frequent terms among very many rare ones; then terms that are all alike, where nothing is certain."""
    docs = spark.range(20_000).selectExpr("id", "concat('common word', id % 7, ' rare', id, ' x', id % 90) AS text").repartition(4)
    for size in (1, 5, 40):
        plain, pruned = (encode.vocabulary(docs, "text", size, prune) for prune in (False, True))
        assert plain.orderBy("token_id").collect() == pruned.orderBy("token_id").collect()
    tokens = docs.select(F.explode(F.split("text", " ")).alias("term"))
    counts = encode.heavy_terms(tokens, 40, 4096)
    assert counts is not None and 40 <= counts.count() <= 4096 < tokens.distinct().count()
    flat = spark.range(9000).select(F.concat(F.lit("t"), "id").alias("term"))
    assert encode.heavy_terms(flat, 40, 1024) is None


def test_bootstrap_follows_poisson(spark):
    df = ensemble.with_bootstrap(spark.range(20_000), "id", 2)
    row = df.agg(
        F.avg("weight_0").alias("mean"), F.var_samp("weight_0").alias("var"),
        F.avg((F.col("weight_0") == 0).cast("int")).alias("zero"), F.corr("weight_0", "weight_1").alias("corr"),
    ).first()
    assert abs(row["mean"] - 1) < 0.03 and abs(row["var"] - 1) < 0.05
    assert abs(row.zero - math.exp(-1)) < 0.015 and abs(row["corr"]) < 0.03
    again = ensemble.with_bootstrap(spark.range(20_000).repartition(7), "id", 2)
    assert again.agg(F.sum("weight_1")).first() == df.agg(F.sum("weight_1")).first()


@pytest.fixture(scope="module")
def trained(spark, tmp_path_factory):
    texts = [("gene variant study", 0.9, 0.8), ("weather report today", 0.1, 0.05), ("gene weather", 0.5, 0.4)]
    rows = [(f"{t} {i % 5}", a, s, f"PMC{i}") for i in range(90) for t, a, s in [texts[i % 3]]]
    training = spark.createDataFrame(rows, schemas.TRAINING_DATASET)
    path = str(tmp_path_factory.mktemp("model") / "ensemble")
    return training, path, jobs.train_ensemble(training, path, width=64)


def test_training_job(spark, trained):
    training, path, (model, compared, mse) = trained
    rows = compared.collect()
    assert len(rows) == 18 and {"AwT_score_members", *settings.EVALUATED_COLUMNS} <= set(compared.columns)
    for r in rows:
        expected = sum(1 / (1 + math.exp(-y)) for y in r.AwT_score_members) / 4
        assert abs(r.predicted_AwT_score - expected) < 1e-9 and len(set(r.AwT_score_members)) > 1
    expected = sum((r.predicted_SoE_score - r.randomized_SoE_score) ** 2 for r in rows) / 18
    assert abs(mse.first().SoE_score - expected) < 1e-9
    with pytest.raises(ValueError, match="missing cells"):
        jobs.train_ensemble(training.withColumn("ID", F.lit(None).cast("string")), path)


def test_training_losses(spark, trained, tmp_path):
    training, path, _ = trained
    losses = str(tmp_path / "losses")
    jobs.train_ensemble(training, path, width=64, losses=losses)
    rows = spark.read.parquet(losses)
    assert rows.count() == 12 and 0 < evaluate.epoch_loss(rows).first().loss < 0.2


def test_steps_of_the_bootstrap_end_below_the_resolution():
    steps = ensemble.poisson_steps()
    assert 1 - steps[-1] > 2**-32 and 1 - steps[-1] < 2**-28 and steps == sorted(steps)


def test_scoring_job(spark, trained, tmp_path):
    _, path, _ = trained
    rows = [("gene variant study", "1"), ("weather report today", "2"), ("gene variant study gene", "3")]
    dataset = spark.createDataFrame(rows, schemas.ABSTRACT_DATASET)
    predictions, filtered = str(tmp_path / "p"), str(tmp_path / "f")
    jobs.score_articles(spark, dataset, path, predictions, filtered)
    written = tables.read_version(spark, predictions, schemas.PREDICTIONS)
    got = {r.ID: r for r in written.collect()}
    assert got["1"].Abstract == rows[0][0] and abs(got["1"].Predicted_AwT_score - 0.9) < 0.15
    kept = tables.read_version(spark, filtered, schemas.FILTERED)
    assert kept.columns == ["ID", *settings.PREDICTED_COLUMNS]
    assert "1" in {r.ID for r in kept.collect()} and "2" not in {r.ID for r in kept.collect()}


def test_saved_heads_and_embeddings(spark, trained):
    training, path, (model, _, _) = trained
    table = ensemble.heads_table(spark, model)
    assert table.count() == 8
    given = training.limit(20)
    out = ensemble.outputs(ensemble.load(path), given, embeddings=True)
    by_heads = heads.member_outputs(out.select("ID", F.col("embedding"), F.col("AwT_score_members").alias("ml")), table, "embedding")
    for r in by_heads.collect():
        np.testing.assert_allclose(r.ml, r.AwT_score_members, atol=1e-4)
        assert len(r.embedding) == 64


def test_sums_give_the_fits_of_the_solver(spark):
    """Members and targets from one pass, against one fit of Spark ML for each; one feature never varies."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    from litscreen.operators import gram

    rng = np.random.default_rng(11)
    x = np.concatenate([rng.normal(size=(3000, 5)) * [1, 10, 0.1, 3, 1], np.full((3000, 1), 4.0)], axis=1)
    y = x @ [1, -0.2, 3, 0, 0.5, 0] + rng.normal(size=3000)
    names = [f"x{i}" for i in range(6)]
    rows = spark.createDataFrame([(i, *map(float, r), float(t), float(-2 * t + 1)) for i, (r, t) in enumerate(zip(x, y))],
                                 ["ID", *names, "one", "two"]).repartition(5)
    rows = VectorAssembler(inputCols=names, outputCol="features").transform(rows)
    weighted = ensemble.with_bootstrap(rows, "ID", 2).cache()
    sums = gram.weighted_sums(weighted, "features", [F.col("one"), F.col("two")], [F.col("weight_0"), F.col("weight_1")])
    for member in range(2):
        for place, target in enumerate(("one", "two")):
            weights, bias = sums[member].ridge(place, 0.01)
            fitted = LinearRegression(labelCol=target, weightCol=f"weight_{member}", regParam=0.01, solver="normal").fit(weighted)
            np.testing.assert_allclose(weights, fitted.coefficients.toArray(), atol=1e-6)
            assert abs(bias - fitted.intercept) < 1e-6
            stage = ensemble.linear_stage(spark, weights, bias, "y")
            assert abs(stage.transform(weighted).first().y - fitted.transform(weighted).first().prediction) < 1e-6
            predicted = np.asarray(x @ weights + bias)
            w = np.array([r[0] for r in weighted.orderBy("ID").select(f"weight_{member}").collect()])
            truth = y if target == "one" else -2 * y + 1
            assert abs(sums[member].loss(place, weights, bias) - (w * (predicted - truth) ** 2).sum() / w.sum()) < 1e-8


def test_a_target_that_does_not_vary(spark):
    from pyspark.ml.linalg import Vectors

    from litscreen.operators import gram

    rows = spark.createDataFrame([(Vectors.dense(1.0, 2.0), 3.0), (Vectors.sparse(2, [1], [5.0]), 3.0)], ["v", "y"])
    (sums,) = gram.weighted_sums(rows, "v", [F.col("y")], [F.lit(1.0)])
    weights, bias = sums.ridge(0, 0.01)
    assert weights.tolist() == [0, 0] and bias == 3.0
    assert gram.weighted_sums(rows.limit(0), "v", [F.col("y")], [F.lit(1.0)]) == []


def test_epochs_follow_the_gradient_row_by_row(spark):
    from pyspark.ml.linalg import Vectors

    from litscreen.operators import order

    rng = np.random.default_rng(2)
    x, y = rng.normal(size=(50, 3)), rng.normal(size=50)
    rows = spark.createDataFrame([(str(i), Vectors.dense(r), float(t)) for i, (r, t) in enumerate(zip(x, y))], ["ID", "v", "y"]).repartition(4)
    found = ensemble.train_epochs(rows, "v", "y", epochs=5, steps=4, rate=0.1).orderBy("epoch").collect()
    place = {int(r.ID): r.row for r in order.number_rows(rows, "ID", settings.SPLIT_SEED).collect()}
    w, b = np.zeros(3), 0.0
    for epoch in range(5):
        losses = []
        for k in range(4):
            some = [i for i in range(50) if place[i] % 4 == k]
            gap = x[some] @ w + b - y[some]
            losses.append((gap ** 2).mean())
            w, b = w - 0.1 * 2 * (gap[:, None] * x[some]).mean(axis=0), b - 0.1 * 2 * gap.mean()
        r = found[epoch]
        assert r.epoch == epoch + 1 and abs(r.loss - np.mean(losses)) < 1e-9 and abs(r.bias - b) < 1e-9
        np.testing.assert_allclose(r.weights, w, atol=1e-9)
    assert found[-1].loss < found[0].loss
    assert ensemble.train_epochs(rows.limit(0), "v", "y").count() == 0


def test_the_mean_model_scores_like_all_members(spark, trained):
    training, path, (model, _, _) = trained
    every = ensemble.averaged(ensemble.outputs(model, training), settings.PREDICTED_COLUMNS, "identity")
    one = ensemble.scored(model, training)
    both = every.join(one.select("ID", *[F.col(c).alias(f"one_{c}") for c in settings.PREDICTED_COLUMNS]), "ID").collect()
    for r in both:
        for c in settings.PREDICTED_COLUMNS:
            assert abs(r[c] - r[f"one_{c}"]) < 1e-9
    assert len(ensemble.mean_model(model, spark).stages) == len(model.stages) - 6
