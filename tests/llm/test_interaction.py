import re
from itertools import permutations
from math import factorial

import duckdb

from litscreen.llm import interaction
from odd import ODD

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, failed string, n long"
LABELS = "doc_id long, quality int, toxic int, part string"


def _fails(text, i, smaller):
    words = WORD.findall(text)
    found = ""
    found += "A" if len(words) < 200 else ""
    found += "B" if 100 * len(set(words)) < 50 * len(words) else ""
    found += "C" if 100 * len(re.findall("[A-Z]", text)) > 3 * len(text) else ""
    found += "D" if re.search(r"[#$%&*|]", text) else ""
    return found + ("E" if i is not None and any(j < i for j in smaller[text]) else "")


def brute(docs, labels):
    """Each order applied to the documents one by one."""
    ids = {}
    for i, text, *_ in docs:
        ids.setdefault(text or "", []).extend([] if i is None else [i])
    good = {i for i, q, t, _ in labels if q == 1 and i is not None}
    toxic = {i for i, q, t, _ in labels if t == 1 and i is not None}
    rows, shapley = {}, {}
    for part in {d[2] or "" for d in docs}:
        own = [(d[0], _fails(d[1] or "", d[0], ids)) for d in docs if (d[2] or "") == part]
        for order in permutations("ABCDE"):
            left, gone = own, []
            for step, f in enumerate(order, 1):
                out = [d for d in left if f in d[1]]
                again = [d for d in gone if f in d[1]]
                left, gone = [d for d in left if f not in d[1]], gone + out
                shapley[part, f] = shapley.get((part, f), 0) + len(out)
                rows[part, "".join(order), step] = (
                    len(left), len(out), len(again), sum(d[1] == f for d in own), sum(d[0] in good for d in out), sum(d[0] in toxic for d in out))
    return {(*k, *v, shapley[k[0], k[1][k[2] - 1]]) for k, v in rows.items()}


def test_equals_orders_applied_one_by_one(spark):
    texts = [*ODD, "Word " * 300, "Word " * 300, " ".join(f"w{i}" for i in range(250)), " ".join(f"w{i}" for i in range(250)) + " A#",
             " ".join(f"W{i}" for i in range(250)), "x" * 50_000, "a b " * 20_000]
    docs = [(i, t, [None, "", "en", "de"][i % 4], "x", 1) for i, t in enumerate(texts * 2)]
    docs += [(3, "a", "en", "x", 1), (3, "a", "en", "x", 1), (None, "a", "en", "x", 1), (None, "a", "fr", "x", 1), (-5, "a", None, "x", 1), (3, "b", "en", None, None)]
    labels = [(i, i % 2, i % 3 // 2, "p") for i in range(0, len(docs), 2)] + [(2, None, 1, None), (2, 1, None, None), (None, 1, 1, "p")]
    found = interaction.audit(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS))
    rows = [tuple(r) for r in found.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == brute(docs, labels)


def test_empty(spark):
    empty = interaction.audit(spark.createDataFrame([], DOCS), spark.createDataFrame([(1, 1, 1, "p")], LABELS))
    assert empty.collect() == []
    one = interaction.audit(spark.createDataFrame([(1, None, None, None, None)], DOCS), spark.createDataFrame([], LABELS))
    assert {tuple(r) for r in one.collect()} == brute([(1, None, None)], []) and one.count() == 600


def test_lattice_counts_orders():
    for n in range(6):
        edges = interaction.lattice(n)
        assert len(edges) == n * 2 ** max(0, n - 1)
        for e in edges:
            before = bin(e.state).count("1")
            assert e.orders == factorial(before) * factorial(n - before - 1)
        assert all(sum(e.orders for e in edges if e.place == p) == factorial(n) for p in range(n))


def test_copies_are_counted_before_they_move(spark):
    docs = spark.range(2000).selectExpr("id as doc_id", "'same text' as text", "'en' as lang")
    rows = interaction.audit(docs, spark.createDataFrame([], LABELS)).where("filter_order = 'EABCD'").collect()
    assert {r.step: (r.kept, r.removed) for r in rows} == {1: (1, 1999), 2: (0, 1), 3: (0, 0), 4: (0, 0), 5: (0, 0)}


def test_query_equals_sql(spark, data):
    from litscreen.llm.queries import SQL, op12_filter_interaction

    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{data}/{name}.parquet'")
    result = con.execute(SQL["op12_filter_interaction"])
    names = [c[0] for c in result.description]
    rows = op12_filter_interaction(spark, data).select(*names).collect()
    assert sorted(map(tuple, rows)) == sorted(result.fetchall())
