import numpy as np
import pytest
import xxhash
from odd import ODD
from pyspark.sql import functions as F

from litscreen.llm import vantage
from litscreen.llm.links import components


def brute_fingerprint(text):
    words = "".join(c.lower() if c.isascii() else c for c in text or "")
    import re
    words = re.findall(r"[^\x20\x09-\x0D]+", words)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def brute_components(fps, radius=2):
    """By comparing all pairs; fps is a list of (id, fingerprint)."""
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i][1] ^ fps[j][1]).bit_count() <= radius:
                root[find(i)] = find(j)
    least = {}
    for i, (own, _) in enumerate(fps):
        least[find(i)] = min(own, least.get(find(i), own))
    return [least[find(i)] for i in range(len(fps))]


def test_fingerprints_of_odd_texts(spark):
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate([*ODD, "One two THREE", "one two"])], "doc_id long, text string, fp int")
    rows = {r.doc_id: r.fp % 2**64 for r in vantage.fingerprints(docs).collect()}
    assert rows == {i: brute_fingerprint(t) for i, t in enumerate([*ODD, "One two THREE", "one two"])}


@pytest.mark.parametrize("n, spread", [(3000, 64), (3000, 9), (900, 2), (1, 64), (0, 64)])
def test_pairs_of_shards_are_exact(n, spread):
    """Scattered fingerprints, and dense balls around few centres that hardly part."""
    rng = np.random.default_rng(n + spread)
    centres = rng.integers(0, 2**63, 12, dtype=np.uint64)
    fps = np.unique(np.array([int(c) ^ sum(1 << int(b) for b in set(rng.integers(0, 64, spread).tolist()))
                              for c in rng.choice(centres, n)], np.uint64))
    tree = vantage.grow(fps[:256], 8)
    at, shard = tree.shards_of(fps)
    together = np.zeros((len(fps), len(fps)), bool)
    found = np.zeros((len(fps), len(fps)), bool)
    for s in range(tree.shards):
        own = at[shard == s]
        together[np.ix_(own, own)] = True
        a, b = vantage.close_pairs(fps[own])
        found[own[a], own[b]] = found[own[b], own[a]] = True
    close = vantage.distance(fps[:, None], fps[None, :]) <= 2
    np.fill_diagonal(close, False)
    assert not (close & ~together).any() and (found == close).all()


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(0, i) for i in range(1, 50)] + [(7, 7), (500, 501), (501, 500)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**{i: 100 for i in range(101, 161)}, **{i: 0 for i in range(1, 50)}, 501: 500}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_query_on_whole_table(spark, data):
    from litscreen.llm.queries import op8_simhash_vantage

    docs = spark.read.parquet(f"{data}/documents.parquet").collect()
    fps = [(d.doc_id, brute_fingerprint(d.text)) for d in docs]
    truth = {i: (f"{fp:016x}", c) for (i, fp), c in zip(fps, brute_components(fps))}
    rows = op8_simhash_vantage(spark, data).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == truth and len(rows) == len(docs)


def test_one_of_each(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").withColumnRenamed("lang", "key")
    more = docs.union(docs.withColumn("doc_id", F.col("doc_id") + 1000)).union(docs).union(
        docs.limit(3).withColumn("doc_id", F.lit(None).cast("long")).withColumn("text", F.lit("quite another text here")))
    fps = [(d.doc_id, brute_fingerprint(d.text)) for d in docs.collect()]
    rows = vantage.one_of_each(more)
    assert rows.columns == docs.columns
    ids = [r.doc_id for r in rows.collect()]
    assert sorted(ids, key=lambda i: (i is None, i)) == [*sorted(set(brute_components(fps))), None]
    assert vantage.one_of_each(docs.limit(0)).count() == 0


def test_each_component_keeps_a_row_whatever_the_ids(spark):
    """Texts without an ID, and several texts under one ID, one of them a copy of a document with a smaller ID."""
    one, two, three, four = ("a b c d e f g", "quite another text stands here", "and a third one of some words", "the last of all texts is this")
    rows = [(None, one), (None, two), (None, one), (7, three), (7, four), (3, three), (9, four), (None, None), (2**63 - 1, "")]
    docs = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(rows)], "doc_id long, text string, n int").repartition(3)
    assert len(set(brute_components([(n, brute_fingerprint(t)) for n, (_, t) in enumerate(rows)]))) == 5
    found = sorted((r.text or "", r.doc_id) for r in vantage.one_of_each(docs).collect())
    assert [t for t, _ in found] == sorted([one, two, three, four, ""])
    assert dict(found[1:]) == {one: None, two: None, three: 3, four: 7}


def test_components_over_several_shards(spark, data, monkeypatch):
    """Boundary bands, trees of shards and components together: the table dealt to many shards gives the same."""
    monkeypatch.setattr(vantage, "SHARD", 16)
    docs = spark.read.parquet(f"{data}/documents.parquet")
    rows = vantage.near_duplicates(docs).collect()
    given = docs.select("doc_id", "text").collect()
    fps = {r.doc_id: brute_fingerprint(r.text) for r in given}
    want = brute_components([(i, fp) for i, fp in fps.items()])
    assert {r.component_id for r in rows} == set(want) and len(rows) == len(given)
    assert len({r.component_id for r in rows}) < len(rows)
