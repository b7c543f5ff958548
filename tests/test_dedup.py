import random

from pyspark.sql import functions as F

from litscreen.operators import dedup, joins


def _rows(spark, rows):
    return spark.createDataFrame(rows, "ID string, day int, text string")


def test_first_per_key_with_a_hot_and_a_missing_key(spark):
    rows = [("hot" if i % 3 else f"k{i % 40}", (i * 7919) % 5003, f"t{i}") for i in range(5000)]
    rows += [(None, i, f"n{i}") for i in (5, 2, 9)]
    got = dedup.first_per_key(_rows(spark, rows).repartition(6), ["ID"], [F.col("day"), F.col("text")])
    expected = {}
    for row in sorted(rows, key=lambda r: (r[1], r[2])):
        expected.setdefault(row[0], row)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, expected.values()))
    again = dedup.first_per_key(got, ["ID"], [F.col("day"), F.col("text")])
    assert again.count() == got.count()


def test_many_per_key_beyond_the_limit_of_the_plan(spark):
    rows = [("hot" if i % 3 else "cold", (i * 7919) % 5003, f"t{i}") for i in range(5000)]
    order = [F.col("day").desc(), F.col("text")]
    df = _rows(spark, rows).repartition(6)
    for count in (50, 1500):
        got = {tuple(r) for r in dedup.first_per_key(df, ["ID"], order, count).collect()}
        expected = set()
        for key in ("hot", "cold"):
            mine = [r for r in rows if r[0] == key]
            expected |= set(sorted(mine, key=lambda r: (-r[1], r[2]))[:count])
        assert got == expected


def test_union_and_append_agree(spark):
    old = _rows(spark, [("a", 5, "old a"), (None, 1, "old none"), ("b", 1, "old b")])
    new = _rows(spark, [("a", 1, "new a"), ("c", 2, "late c"), ("c", 1, "new c"), (None, 0, "new none")])
    order = [F.col("day")]
    union = {r.text for r in dedup.union_first(old, new, "ID", order).collect()}
    added = {r.text for r in dedup.unseen(old, new, "ID", order).collect()}
    assert union == {"old a", "old none", "old b", "new c"}
    assert added == {"new c"}


def test_salted_join_equals_the_plain_join(spark):
    random.seed(1)
    rows = spark.createDataFrame([("hot" if random.random() < 0.5 else f"k{i % 7}", i) for i in range(2000)], "k string, i int")
    lookup = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3), ("k2", 4)], "k string, v int")
    for how in ("inner", "left"):
        plain = {tuple(r) for r in rows.join(lookup, "k", how).collect()}
        assert {tuple(r) for r in joins.salted_join(rows, lookup, "k", "i", how).collect()} == plain
        assert {tuple(r) for r in joins.attach(rows, lookup, "k", "i", how).collect()} == plain
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        salted = joins.salted_join(rows, lookup, "k", "i").withColumn("task", F.spark_partition_id())
        sizes = [r["count"] for r in salted.filter("k = 'hot'").groupBy("task").count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) > 1 and max(sizes) < 0.6 * sum(sizes)  # the hot key is in several tasks


def test_measure(spark):
    assert joins.measure(spark.range(10), 10, F.max("id")) == (True, 9)
    assert joins.measure(spark.range(11), 10)[0] is False
    assert joins.measure(spark.range(10).select(F.repeat(F.lit("x"), 1000)), 10, max_bytes=5000)[0] is False
    assert joins.measure(spark.range(0))[0] is True
