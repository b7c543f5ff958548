import hashlib
import math

import duckdb
import pytest
from pyspark.sql import functions as F

from litscreen.llm import mixing
from litscreen.llm.queries import SQL, WEIGHTS, op7_poisson_mixing


def test_query_equals_sql(spark, data):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{data}/documents.parquet'")
    result = con.execute(SQL["op7_poisson_mixing"])
    names = [c[0] for c in result.description]
    mixed = op7_poisson_mixing(spark, data)
    assert sorted(mixed.columns) == sorted(names)
    assert sorted(map(repr, map(tuple, mixed.select(*names).collect()))) == sorted(map(repr, result.fetchall()))


def test_copies_follow_the_distribution(spark):
    docs = spark.range(40_000).selectExpr("id AS doc_id", "if(id % 4 = 0, 'a', if(id % 4 = 1, 'b', null)) AS source", "'x' AS copy")
    mixed = mixing.replicate(docs, {"a": 0.5, "b": 0.1, "none": 0.2})
    shares = {r.source: r["count"] / 40_000 for r in mixed.groupBy("source").count().collect()}
    assert shares["a"] == pytest.approx(0.5, abs=0.02) and shares["b"] == pytest.approx(0.1, abs=0.02)
    assert shares[None] == pytest.approx(0.2, abs=0.02) and mixed.columns == ["doc_id", "source", "copy"]
    counts = {r.doc_id: r["count"] for r in mixed.where("source = 'a'").groupBy("doc_id").count().collect()}
    for i in range(0, 4000, 4):  # one by one, with mean 2
        u = int(hashlib.md5(f"17:{i}".encode()).hexdigest()[:8], 16) / 2**32
        k, below = 0, math.exp(-2)
        while below <= u:
            k += 1
            below += math.exp(-2) * 2**k / math.factorial(k)
        assert counts.get(i, 0) == k


def test_odd_input(spark):
    docs = spark.createDataFrame([(1, "a"), (1, "a"), (None, None), (2, "b")], "doc_id long, source string")
    mixed = mixing.replicate(docs, {"a": 0.5}, total=40).collect()
    ones = [r.copy for r in mixed if r.doc_id == 1]
    assert sorted(ones) == sorted(2 * list(range(1, len(ones) // 2 + 1)))
    assert mixing.replicate(docs.limit(0), {"a": 1.0}).count() == 0 and mixing.replicate(docs, {}).count() >= 0
    assert mixing.thresholds(0) == [] and mixing.thresholds(900)[-1] < 2**32
    with pytest.raises(ValueError):
        mixing.replicate(docs, {"a": 1.5})


def test_a_rare_source_is_repeated_as_often_as_it_takes(spark):
    docs = spark.createDataFrame([(0, "rare", "x"), *[(i, "other", "x") for i in range(1, 3000)]], "doc_id long, source string, text string")
    found = mixing.replicate(docs, {"rare": 0.9}, total=40_000)
    rare = sorted(r.copy for r in found.where("source = 'rare'").collect())
    assert rare == list(range(1, len(rare) + 1)) and abs(len(rare) - 36_000) < 6 * 36_000**0.5
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    rows = con.execute(mixing.sql({"rare": 0.5}, ["doc_id", "source", "text"])).fetchall()
    again = mixing.replicate(docs, {"rare": 0.5}).select("doc_id", "source", "text", "copy")
    assert sorted(rows) == sorted(map(tuple, again.collect())) and sum(r[1] == "rare" for r in rows) > 1000


@pytest.mark.parametrize("doc_id", [None, 5])
def test_rows_of_one_id_or_none_do_not_meet_in_one_task(spark, doc_id):
    docs = spark.range(30_000).selectExpr(
        f"if(id % 3 = 0, cast({'null' if doc_id is None else doc_id} as long), id) AS doc_id", "'a' AS source", "'same' AS text")
    held = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        sizes = mixing.replicate(docs, {"a": 1.0}, total=120_000).groupBy(F.spark_partition_id()).count().toPandas()["count"]
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    assert sizes.max() < 2 * sizes.median()


def test_rows_without_an_id_are_drawn_apart(spark):
    docs = spark.range(2000).selectExpr("cast(null as long) AS doc_id", "'a' AS source", "cast(id as string) AS text")
    assert 1700 < mixing.replicate(docs, {"a": 1.0}).count() < 2300
