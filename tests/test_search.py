import datetime
import random
import re

import pytest
from pyspark.sql import functions as F

from litscreen import schemas
from litscreen.operators import incremental, search

WORDS = ["gene", "variant", "müller", "duct", "pcos", "s", "a", "b2", "of", "the", "cushing"]


def _fold(text):
    return " " + " ".join(re.findall(r"[^\W_]+", text.lower())) + " "


def _brute(docs, terms):
    """All pairs, by looking for each term in each text."""
    clauses = {}
    for query, clause, term, _ in terms:
        if _fold(term).strip():
            clauses.setdefault(query, {}).setdefault(clause, []).append(_fold(term))
    return {
        (doc, query)
        for doc, text in docs
        for query, needed in clauses.items()
        if all(any(t in _fold(text) for t in any_of) for any_of in needed.values())
    }


@pytest.fixture(scope="module")
def case(spark):
    rng = random.Random(7)
    seps = [" ", ", ", "-", ". ", "  ", "\n", "'"]
    docs = [
        (i, "".join(rng.choice(WORDS).title() + rng.choice(seps) for _ in range(rng.randint(0, 12))))
        for i in range(150)
    ] + [(1000, ""), (1001, "...")]
    terms = []
    for q in range(12):
        for clause in range(rng.randint(1, 4)):
            for _ in range(rng.randint(1, 3)):
                term = rng.choice([" ", "-"]).join(rng.choice(WORDS) for _ in range(rng.choice([1, 1, 2, 3])))
                terms.append((f"q{q}", clause * 5, term, "Abstract"))
    terms += [("empty", 0, "...", "Abstract"), ("odd", 0, "GENE", "Abstract"), ("odd", 1, "!", "Abstract")]
    terms += [("long", c, w, "Abstract") for c, w in enumerate(["gene", "the", "of"] * 30)]  # 90 clauses
    docs.append((1002, "the gene of"))
    return docs, terms


@pytest.mark.parametrize("broadcast_rows", [100_000, 0])
def test_matches_equal_brute_force(spark, case, broadcast_rows):
    docs, terms = case
    articles = spark.createDataFrame(docs, "id int, text string").repartition(3)
    given = spark.createDataFrame(terms, schemas.QUERY_TERMS)
    for chosen, label in ((given, "all"), (given.filter("query_id <> 'long'"), "few")):
        kept = [t for t in terms if label == "all" or t[0] != "long"]
        got = search.matches(articles, chosen, "id", {"Abstract": "text"}, broadcast_rows=broadcast_rows)
        pairs = [tuple(r) for r in got.collect()]
        assert len(pairs) == len(set(pairs)) and set(pairs) == _brute(docs, kept)
    assert (1002, "long") in _brute(docs, terms)


def test_an_index_finds_the_same(spark, case, tmp_path):
    docs, terms = case
    articles = spark.createDataFrame(docs, "id int, text string").repartition(3)
    given = spark.createDataFrame(terms, schemas.QUERY_TERMS)
    index = str(tmp_path / "index")
    search.build_index(articles, "id", {"Abstract": "text"}, index, buckets=7)
    got = search.matches(articles, given, "id", {"Abstract": "text"}, index=index)
    assert sorted(map(tuple, got.collect())) == sorted(_brute(docs, terms))
    one = search.prepare_terms(given.filter("query_id = 'odd'"), ["Abstract"])
    read = search._indexed_words(spark, index, one)
    assert len(read.inputFiles()) > 0 and "PartitionFilters: [isnotnull(bucket" in read._jdf.queryExecution().executedPlan().toString() or \
        "PartitionFilters: [bucket" in read._jdf.queryExecution().executedPlan().toString()


def test_fields_are_searched_apart(spark):
    articles = spark.createDataFrame([(1, "gene", "duct"), (2, "duct", "gene")], "id int, title string, text string")
    terms = spark.createDataFrame(
        [("q", 0, "gene", "Title"), ("q", 1, "duct", "Abstract")], schemas.QUERY_TERMS
    )
    got = search.matches(articles, terms, "id", {"Title": "title", "Abstract": "text"})
    assert [r.id for r in got.collect()] == [1]


def test_planned_search_takes_the_newest_in_range(spark):
    day = datetime.date(2024, 1, 1)
    docs = [(i, "gene" if i % 3 else "gene duct", day + datetime.timedelta(i % 20)) for i in range(300)]
    articles = spark.createDataFrame(docs, "id int, abstract string, pub_date date")
    terms = spark.createDataFrame(
        [("old", 0, "gene", "Abstract"), ("new", 0, "duct", "Abstract"), ("done", 0, "gene", "Abstract")],
        schemas.QUERY_TERMS,
    )
    queries = spark.createDataFrame([(q, q, q) for q in ("old", "new", "done")], schemas.QUERIES)
    current, last = datetime.date(2024, 1, 15), datetime.date(2024, 1, 10)
    state = spark.createDataFrame([("old", last), ("done", current)], schemas.RUN_STATE)
    fields = {"Abstract": "abstract"}

    def run(run_state, count):
        plan = incremental.plan_queries(queries, run_state, current)
        return [tuple(r) for r in search.search_planned(articles, terms, plan, "id", "pub_date", fields, count).collect()]

    got = run(state, 50)
    expected_old = sorted([(d[2], -d[0]) for d in docs if last <= d[2] <= current], reverse=True)[:50]
    assert {(q, i) for q, i, _ in got if q == "old"} == {("old", -i) for _, i in expected_old}
    # "new" has no state: all dates, those after today included; 100 match, 50 are kept.
    newest = sorted([(d[2], -d[0]) for d in docs if d[0] % 3 == 0], reverse=True)[:50]
    assert {i for q, i, _ in got if q == "new"} == {-i for _, i in newest}
    assert not [q for q, _, _ in got if q == "done"]
    assert len([1 for q, _, _ in run(state, None) if q == "new"]) == 100
    everything_seen = queries.select("query_id", F.lit(last).alias("last_fetch"))
    assert {d for _, _, d in run(everything_seen, None)} == {day + datetime.timedelta(i) for i in range(9, 15)}


def test_no_usable_term_finds_nothing(spark):
    articles = spark.createDataFrame([(1, "some text")], "id long, text string")
    terms = "query_id string, clause int, term string, field string"
    for rows in ([], [("q", 0, "...", "Abstract"), ("q", 1, None, "Abstract")]):
        found = search.matches(articles, spark.createDataFrame(rows, terms), "id", {"Abstract": "text"})
        assert found.count() == 0


def test_a_new_query_does_not_widen_the_scan_of_the_others(spark, tmp_path):
    import datetime

    day = datetime.date(2024, 1, 1)
    rows = [(i, f"alpha beta{i % 2}", day + datetime.timedelta(days=i)) for i in range(40)] + [(99, "beta1", None)]
    spark.createDataFrame(rows, "id long, text string, pub_date date").write.parquet(str(tmp_path / "corpus"))
    corpus = spark.read.parquet(str(tmp_path / "corpus"))
    terms = spark.createDataFrame([("old", 0, "alpha", "Abstract"), ("new", 0, "beta1", "Abstract")],
                                  "query_id string, clause int, term string, field string")
    plan = spark.createDataFrame([("old", "INCREMENTAL", datetime.date(2024, 2, 1), datetime.date(2024, 2, 5)), ("new", "FULL", None, None)],
                                 "query_id string, mode string, since date, until date")
    found = search.search_planned(corpus, terms, plan, "id", "pub_date", {"Abstract": "text"}, count=None)
    got = {(r.query_id, r.id) for r in found.collect()}
    assert got == {("old", i) for i in range(31, 36)} | {("new", i) for i in range(1, 40, 2)} | {("new", 99)}
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(pub_date,2024-02-01)" in text and "LessThanOrEqual(pub_date,2024-02-05)" in text
