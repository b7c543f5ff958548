"""The plans are those that hold for large tables."""

import datetime
import re

import pytest
from pyspark.sql import functions as F

from litscreen import schemas
from litscreen.operators import dedup, encode, extract, heads, order, search
from litscreen.plans import queries as contract
from litscreen.sources import tables

PYTHON = ("PythonUDF", "ArrowEvalPython", "BatchEvalPython", "MapInPandas", "FlatMapGroups")
WRITING = {"landing_upsert", "abstract_dataset", "abstract_table", "body_table", "query_list", "csv_round_trip", "select_articles", "select_incremental", "landed_files",
           "ml_ensemble", "ml_score", "training_epochs", "stream_ingest", "stream_dedup", "batch_predict"}


def _plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.mark.parametrize("query", [q for q in contract.ALL if q.__name__ not in WRITING], ids=lambda q: q.__name__)
def test_no_python_and_no_cross_join(spark, data, query):
    plan = _plan(query(spark, data))
    for name in (*PYTHON, "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert name not in plan


def test_extraction_runs_once_and_without_a_shuffle(spark, data):
    pages = tables.read_table(spark, data, "pages").select("page_id", F.col("html").alias("page"))
    plan = _plan(extract.with_element(pages, "body").select("page_id", "element"))
    assert "Exchange" not in plan
    tree = pages.withColumn("query_folder", F.lit("q")).withColumn("id", F.lit("1")).withColumn("fetched_at", F.lit(1))
    rows = extract.dataset_rows(extract.abstracts(tree, "article")).filter("Abstract <> 'x'")
    # The scanning pattern is written once: in the explode that computes the element.
    assert _plan(rows).count("<article[") == _plan(extract.with_element(tree, "article")).count("<article[")


def test_dates_reach_the_scan(spark, data):
    events = tables.read_table(spark, data, "events")
    day = F.col("ts").between(F.lit(datetime.datetime(2024, 1, 2)).cast("timestamp_ntz"), F.lit(datetime.datetime(2024, 1, 3)).cast("timestamp_ntz"))
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(ts", _plan(events.filter(day).select("event_id")))


def test_search_moves_nothing(spark, data):
    articles = tables.read_table(spark, data, "documents").select("doc_id", "text")
    terms = spark.createDataFrame([("q", 0, "thand", "Abstract"), ("q", 1, "of the", "Abstract")], schemas.QUERY_TERMS)
    plan = _plan(search.matches(articles, terms, "doc_id", {"Abstract": "text"}))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    # Whatever is shuffled are the terms; nothing is after the texts are scanned.
    assert not any("doc_id#" in s or "_texts#" in s for s in re.findall(r"\) Exchange\nInput[^\n]*", plan))
    tree = search.matches(articles, terms, "doc_id", {"Abstract": "text"})._jdf.queryExecution().executedPlan().toString()
    above_join = tree[:tree.index("BroadcastHashJoin")]
    assert "Exchange" not in above_join and "Aggregate" not in above_join


def test_ranks_are_cut_before_the_shuffle(spark, data):
    events = tables.read_table(spark, data, "events").select("user_id", "event_id", "ts")
    plan = _plan(dedup.latest_per_key(events, ["user_id"], [F.col("ts").desc()]))
    assert plan.index("WindowGroupLimit") < plan.rindex("WindowGroupLimit") and plan.count("+- Exchange") == 1


def _main_plan(df):
    return _plan(df).split("===== Subqueries =====")[0]


def test_splits_and_scores_move_no_rows(spark, data):
    documents = tables.read_table(spark, data, "documents").select("doc_id", "text")
    vectors = tables.read_table(spark, data, "embeddings")
    scored = heads.score(vectors, contract.rule_heads(spark), "embedding")
    vocab = encode.vocabulary(documents, "text", 50)
    for df in (*order.split(documents, "doc_id"), scored, encode.encode(documents, vocab, "doc_id", "text")):
        plan = _main_plan(df)
        assert "Exchange" not in plan and "Join" not in plan and "Scan parquet" in plan


def test_encoding_reads_only_what_it_needs(spark, data):
    documents = tables.read_table(spark, data, "documents")
    vocab = encode.vocabulary(documents, "text", 50)
    plan = _plan(encode.encode(documents, vocab, "doc_id", "text"))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan
    assert "TakeOrderedAndProject" in _plan(vocab)
