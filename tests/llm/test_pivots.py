import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from litscreen.llm import pivots
from litscreen.llm.queries import SQL, op6_exact_topk


def brute(rows, k=5):
    """Rows are (id, vector); all inner products."""
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    found = []
    for i, q in good:
        if i % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in good if j != i)[:k]
            found += [(i, r, j, -s) for r, (s, j) in enumerate(scored, 1)]
    return sorted(found)


@pytest.fixture()
def small(monkeypatch):
    for name, value in {"PART": 64, "PER_PIVOT": 40, "SAMPLE": 200}.items():
        monkeypatch.setattr(pivots, name, value)


@pytest.mark.parametrize("kind", ["scattered", "clusters", "copies", "large", "very large", "some very large", "a large query"])
def test_equals_brute_force(spark, small, kind):
    rng = np.random.default_rng(len(kind))
    x = rng.normal(size=(900, 6))
    if kind == "clusters":
        x = rng.normal(size=(9, 6))[rng.integers(0, 9, 900)] * 5 + x * 0.05
    if kind == "copies":
        x[100:600] = x[50]
    if kind == "large":
        x *= 1e5
    if kind == "very large":
        x *= 1e6
    if kind == "some very large":
        x[[7, 77, 777]] *= 1e9
    if kind == "a large query":
        x[100] *= 1e10
    rows = [(int(i), [float(c) for c in v.astype(np.float32)]) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    found = pivots.top_k(pivots.scaled(df), F.col("vec_id") % 50 == 0)
    assert sorted(map(tuple, found.collect())) == brute(rows)


def test_prunes(spark, small):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(20, 8))[rng.integers(0, 20, 2000)] * 9 + rng.normal(size=(2000, 8)) * 0.1
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    vectors = pivots.scaled(df)
    index, _ = pivots.build(vectors)
    queries = vectors.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"), F.lit(40_000_000).cast("long").alias("bound"))
    assert pivots._visits(queries, index, True).count() < 0.2 * 40 * len(index.cells)


def test_odd_vectors(spark, small):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (50, [0.5, -1.0]), (1, [nan, 1.0]), (2, [inf, 1.0]), (3, None), (4, [None, 1.0]), (None, [1.0, 1.0]), (5, [3.0, 1.0]), (-50, [0.0, 0.0])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, cell int")
    assert sorted(map(tuple, pivots.top_k(pivots.scaled(df), F.col("vec_id") % 50 == 0).collect())) == brute(rows)
    one = spark.createDataFrame([(0, [1.0, 2.0])], "vec_id long, embedding array<float>")
    for few in (one, one.limit(0), df.where("vec_id = 3")):
        assert pivots.top_k(pivots.scaled(few), F.col("vec_id") % 50 == 0).count() == 0
    short = spark.createDataFrame([(0, [1.0, 2.0]), (1, [3.0]), (2, []), (1, [3.0])], "vec_id long, embedding array<float>")
    found = pivots.top_k(pivots.scaled(short), F.col("vec_id") % 50 == 0).collect()
    assert [(r.rank, r.vec_id, r.score) for r in sorted(found, key=lambda r: r.rank)] == [(1, 1, 196608), (2, 1, 196608), (3, 2, 0)]


@pytest.mark.parametrize("scale", [1, 5e3])
def test_repeated_queries_take_no_places(spark, small, scale):
    """A query that is repeated nine times, in the cell of all that is near it."""
    x = np.random.default_rng(9).normal(size=(50, 4)) * scale
    x[0] *= 9
    x[1:7] = x[0]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + 8 * [(0, x[0].tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = pivots.top_k(pivots.scaled(df), F.col("vec_id") % 50 == 0).where("query_id = 0")
    assert sorted(map(tuple, found.collect())) == brute(rows[:50])


def test_query_equals_sql(spark, data):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{data}/embeddings.parquet'")
    truth = con.execute(SQL["op6_exact_topk"]).fetchall()
    assert sorted(map(tuple, op6_exact_topk(spark, data).collect())) == sorted(truth) and truth


def test_large_components_take_part(spark):
    """Components of 2 ** 23 and more are candidates; scores beyond 53 bits are exact."""
    rows = [(0, [1.0, 2.0]), (1, [2.0**23, 1.0]), (2, [3.0, 1.0]), (3, [-(2.0**40), 0.5]), (4, [2.0**45, -1.0]), (50, [2.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = sorted(map(tuple, pivots.top_k(pivots.scaled(df), F.col("vec_id") % 50 == 0, 3).collect()))
    assert found == brute(rows, 3) and found[0] == (0, 1, 4, found[0][3])
    rng = np.random.default_rng(4)
    rows = [(i, [float(c) for c in 8e6 + rng.integers(0, 1000, 2)]) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = pivots.top_k(pivots.scaled(df), F.col("vec_id") % 50 == 0)
    assert sorted(map(tuple, found.collect())) == brute(rows)


def test_a_score_that_is_no_long_is_an_error(spark):
    for rows in ([(0, [1e20]), (1, [1e20])], [(0, [1e20]), (1, [-1e20])]):
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        with pytest.raises(Exception, match="no long"):
            pivots.top_k(pivots.scaled(df), F.col("vec_id") % 50 == 0).collect()
    fine = spark.createDataFrame([(0, [1e20]), (1, [-1e20]), *[(i, [float(i) / 1e10]) for i in range(2, 9)]], "vec_id long, embedding array<double>")
    assert [r.vec_id for r in pivots.top_k(pivots.scaled(fine), F.col("vec_id") == 0).orderBy("rank").collect()] == [2, 3, 4, 5, 6]


def test_products_of_any_size():
    rng = np.random.default_rng(6)
    q, v = (np.floor(rng.normal(size=(n, 3)) * 10.0 ** rng.integers(0, 9, (n, 1))) for n in (12, 15))
    assert pivots.products(q, v).tolist() == [[sum(int(a) * int(b) for a, b in zip(x, y)) for y in v] for x in q]
