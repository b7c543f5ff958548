import hashlib
import math

from pyspark.sql import functions as F

from litscreen.operators import evaluate, order


def _sorted(ids, seed=42):
    return sorted(ids, key=lambda i: (hashlib.md5(f"{i}:{seed}".encode()).hexdigest(), i))


def test_split_is_exact(spark):
    for n in (0, 1, 5, 13, 65, 1001):
        ids = [f"PMC{i}" for i in range(n)]
        df = spark.createDataFrame([(i,) for i in ids], "ID string")
        train, test = order.split(df, "ID")
        test_ids = {r.ID for r in test.collect()}
        size = math.ceil(0.2 * n)
        assert test_ids == set(_sorted(ids)[:size])
        assert {r.ID for r in train.collect()} == set(ids) - test_ids


def test_split_keeps_copies_together(spark):
    df = spark.createDataFrame([("hot", i) for i in range(500)] + [(f"k{i}", i) for i in range(99)], "ID string, i int")
    train, test = order.split(df, "ID")
    assert test.select("ID").distinct().count() == 20
    assert not {r.ID for r in test.collect()} & {r.ID for r in train.collect()}
    assert train.count() + test.count() == 599


def test_numbers_and_batches(spark):
    ids = list(range(200))
    df = spark.range(200).withColumnRenamed("id", "ID")
    numbered = {r.ID: r.row for r in order.number_rows(df, "ID", 42).collect()}
    assert numbered == {i: n for n, i in enumerate(_sorted(ids))}
    sizes = [r.n for r in evaluate.counts_by(order.batches(df, "ID", 6), "batch").orderBy("batch").collect()]
    assert sizes == [6] * 33 + [2]


def test_epoch_loss_weighs_batches_equally(spark):
    df = spark.createDataFrame([(0, 1.0, 0.0), (0, 0.0, 0.0), (1, 2.0, 0.0)], "batch int, p double, t double")
    loss = evaluate.epoch_loss(evaluate.batch_losses(df, "batch", [("p", "t"), ("t", "t")])).first()
    assert (loss.loss, loss.batches) == ((0.25 + 2.0) / 2, 2)
    assert evaluate.mse(df, {"m": ("p", "t")}).first().m == 5 / 3


def test_missing_cells(spark):
    import pytest

    df = spark.createDataFrame([("a", 1.0), (None, float("nan")), ("b", None)], "s string, x double")
    assert evaluate.missing_counts(df).first().asDict() == {"s": 1, "x": 2}
    with pytest.raises(ValueError, match="'x': 2"):
        evaluate.require_complete(df)
    assert evaluate.require_complete(df.na.drop()).count() == 1


def test_noise_stays_in_its_bounds(spark):
    df = spark.range(2000).select(F.col("id").alias("ID"), (F.col("id") % 101 / 100).alias("AwT_score"), F.lit(1.0).alias("SoE_score"))
    rows = evaluate.add_noise(df, "ID").collect()
    for r in rows:
        for score, noised in ((r.AwT_score, r.randomized_AwT_score), (r.SoE_score, r.randomized_SoE_score)):
            assert 0.0 <= noised <= 1.0 and abs(noised - score) <= 0.05 * score + 1e-12
    ratios = [r.randomized_AwT_score / r.AwT_score - 1 for r in rows if 0 < r.AwT_score < 0.9]
    assert abs(sum(ratios) / len(ratios)) < 0.003 and max(ratios) > 0.045 and min(ratios) < -0.045
    assert len({r.randomized_SoE_score for r in rows}) > 900


def test_missing_ids_are_numbered_and_split_too(spark):
    df = spark.createDataFrame([("a",), (None,), ("b",), (None,)], "ID string")
    assert sorted(r.row for r in order.number_rows(df, "ID", 42).collect()) == [0, 1, 2, 3]
    for seed in range(6):
        train, test = order.split(df, "ID", 0.4, seed)
        assert train.count() + test.count() == 4 and test.select("ID").distinct().count() == 2


def test_rows_without_an_id_are_dealt_out(spark):
    rows = [(None, f"t{i}", [float(i)]) for i in range(400)] + [(f"k{i}", None, None) for i in range(100)]
    df = spark.createDataFrame(rows, "ID string, `a.b` string, v array<double>")

    def numbers(parts):
        found = order.number_rows(df.repartition(parts), "ID", 42).collect()
        return {(r.ID, r["a.b"]): r.row for r in found}

    first = numbers(3)
    assert sorted(first.values()) == list(range(500)) and numbers(7) == first
    missing = sorted(n for (i, _), n in first.items() if i is None)
    assert missing[-1] - missing[0] > 450  # not one stretch, as rows of one hash would be
    assert order._hashed(df, "ID", 42, by_row=True).select("_part").distinct().count() > 450
