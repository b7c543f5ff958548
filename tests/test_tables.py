import datetime
import os
import re
import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from litscreen import schemas
from litscreen.operators import extract
from litscreen.plans import jobs
from litscreen.sinks import tables as sinks
from litscreen.sources import files, tables

FOLDER = "(a Mü [x]"


def test_landing_scan_and_decoding(spark, corpus):
    articles = files.read_articles(spark, corpus)
    decoded = files.decode(articles)
    seen = {(r.query_folder, r.id) for r in articles.collect()}
    assert seen == {("qA", "101"), ("qA", "102"), ("qB", "101"), ("qB", "103"), ("qB", "104"), (FOLDER, "107")}
    assert [(r.query_folder, r.id) for r in files.rejects(decoded).collect()] == [("qB", "104")]
    with pytest.raises(Exception, match="UTF"):
        files.decode(articles, strict=True).collect()


def test_extraction(spark, corpus):
    decoded = files.decode(files.read_articles(spark, corpus))
    got = {(r.query_folder, r.id): r for r in extract.abstracts(decoded).collect()}
    assert set(got) == {("qA", "101"), ("qB", "101"), ("qB", "103"), (FOLDER, "107")}
    assert got["qA", "101"].abstract_text == "The first & only part. Second\n   line."
    assert got["qA", "101"].abstract_html.startswith("<abstract><sec>")
    assert got["qB", "103"].abstract_text == ""
    assert {(r.query_folder, r.id) for r in extract.without_element(decoded, "abstract").collect()} == {("qA", "102")}
    bodies = {(r.query_folder, r.id): r.body_html for r in extract.bodies(decoded).collect()}
    assert bodies["qA", "101"] == "<body><p>Text</p></body>" and len(bodies) == 3


def test_abstract_job_appends_once(spark, corpus, tmp_path):
    articles = files.read_articles(spark, corpus)
    dataset, rejected = str(tmp_path / "dataset"), str(tmp_path / "rejected")
    first = articles.filter("query_folder = 'qA'")
    for batch in (first, articles, articles):
        jobs.build_abstract_dataset(batch, dataset, rejected)
    rows = {r.ID: r for r in spark.read.parquet(dataset).collect()}
    assert spark.read.parquet(dataset).count() == 2 and set(rows) == {"101", "107"}
    assert rows["101"].query_folder == "qA"
    assert rows["101"].Abstract == "The first & only part. Second line."
    assert spark.read.parquet(rejected).select("id").collect()[0].id == "104"


def test_body_job(spark, corpus, tmp_path):
    target = str(tmp_path / "bodies")
    jobs.extract_bodies(files.read_articles(spark, corpus), target)
    assert spark.read.parquet(target).count() == 3


def test_extracted_text_files(spark, tmp_path):
    for name, content in {
        "q 1+%/txt_abstracts/12_abstract.txt": " a\n\n b ", "q 1+%/txt_abstracts/a_b_abstract.txt": "x",
        "q 1+%/other/13_abstract.txt": "no", "q 1+%/txt_abstracts/14.txt": "no",
    }.items():
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(content)
    extracted = files.read_extracted(spark, str(tmp_path))
    assert {(r.query_folder, r.id, r.abstract_text) for r in extracted.collect()} == {
        ("q 1+%", "12", " a\n\n b "), ("q 1+%", "a", "x"),
    }
    jobs.append_abstracts(extracted, str(tmp_path / "dataset"))
    rows = spark.read.parquet(str(tmp_path / "dataset")).collect()
    assert {(r.ID, r.Abstract) for r in rows} == {("12", "a b"), ("a", "x")}


def test_extracted_table_gives_the_same_data_set(spark, corpus, tmp_path):
    table, one, two = (str(tmp_path / name) for name in ("table", "one", "two"))
    articles = files.read_articles(spark, corpus)
    jobs.extract_abstracts(articles, table)
    jobs.append_abstracts(spark.read.parquet(table), one)
    jobs.build_abstract_dataset(articles, two)
    assert {tuple(r) for r in spark.read.parquet(one).collect()} == {tuple(r) for r in spark.read.parquet(two).collect()}


def test_query_list(spark, tmp_path):
    path = tmp_path / "queries.txt"
    path.write_text("  (a OR b)[Abstract] \n\n \t\nc\n")
    got = {r.query_text: r.query_id for r in files.read_queries(spark, str(path)).collect()}
    assert set(got) == {"(a OR b)[Abstract]", "c"} and got["c"] == "c_4a8a08f0"


def test_upsert_keeps_the_last_fetch(spark, tmp_path):
    path = str(tmp_path / "landing")

    def batch(*rows):
        return spark.createDataFrame(
            [(f, i, c.encode(), datetime.datetime(2024, 1, day)) for f, i, c, day in rows], schemas.ARTICLES_RAW
        )

    sinks.upsert_articles(batch(("a", "1", "old", 1), ("a", "2", "keep", 1), ("b", "1", "other", 1)), path)
    sinks.upsert_articles(batch(("a", "1", "new", 2), ("c", "9", "x", 2)), path)
    sinks.upsert_articles(batch(("a", "1", "late copy", 1)), path)
    got = {(r.query_folder, r.id): r.content.decode() for r in spark.read.schema(schemas.ARTICLES_RAW).parquet(path).collect()}
    assert got == {("a", "1"): "new", ("a", "2"): "keep", ("b", "1"): "other", ("c", "9"): "x"}


def test_versions(spark, tmp_path):
    path = str(tmp_path / "state")
    assert tables.read_run_state(spark, path).count() == 0
    day = datetime.date(2024, 5, 28)
    sinks.commit_run_state(spark.createDataFrame([("q", day)], schemas.RUN_STATE), path)
    later = tables.read_run_state(spark, path).withColumn("last_fetch", F.date_add("last_fetch", 7))
    sinks.commit_run_state(later, path)
    os.makedirs(os.path.join(path, "rows-x"))  # written, but not committed
    assert tables.versions(spark, path) == [1, 2]
    assert tables.read_run_state(spark, path).first().last_fetch == datetime.date(2024, 6, 4)


def test_csv(spark, tmp_path):
    path = str(tmp_path / "csv")
    rows = [('say "x",\nthen', '"PMC1"'), ("plain", "2"), ("back\\slash", "3"), ("", "4"), (None, "5")]
    sinks.export_csv(spark.createDataFrame(rows, schemas.ABSTRACT_DATASET), path)
    got = {r.ID: r.Abstract for r in files.read_abstracts_csv(spark, path).collect()}
    assert got["PMC1"] == 'say "x",\nthen' and got["2"] == "plain" and got["3"] == "back\\slash"
    hand = tmp_path / "training.csv"
    hand.write_text('text,AwT_score,SoE_score,ID\n"a ""b"", c",0.9,0.2,"""PMC9569987"""\nx,1,,11143662\n')
    got = files.read_training_csv(spark, str(hand)).orderBy("AwT_score").collect()
    assert [tuple(r) for r in got] == [('a "b", c', 0.9, 0.2, "PMC9569987"), ("x", 1.0, None, "11143662")]
    with pytest.raises(Exception):
        files.read_abstracts_csv(spark, str(tmp_path / "nowhere")).collect()


def test_blanks_survive_csv(spark, tmp_path):
    rows = [("  lead and trail  ", "1"), ("\ttab\n", "2"), (" ", "3"), (None, "4"), ("", "5")]
    sinks.export_csv(spark.createDataFrame(rows, schemas.ABSTRACT_DATASET), str(tmp_path / "csv"))
    got = {r.ID: r.Abstract for r in files.read_abstracts_csv(spark, str(tmp_path / "csv")).collect()}
    assert got == {"1": "  lead and trail  ", "2": "\ttab\n", "3": " ", "4": None, "5": None}


def test_second_batch_keeps_the_first(spark, corpus, tmp_path):
    """Artefacts of one folder from two batches; numbers as folder names stay texts."""
    articles = files.read_articles(spark, corpus).withColumn("query_folder", F.when(F.col("query_folder") == "qA", "007").otherwise(F.col("query_folder")))
    bodies, abstracts, missing = (str(tmp_path / n) for n in ("bodies", "abstracts", "missing"))
    for part in ("id = '101'", "id <> '101'", "id = '107'"):
        jobs.extract_bodies(articles.filter(part), bodies)
        jobs.extract_abstracts(articles.filter(part), abstracts, missing=missing)
    assert {(r.query_folder, r.id) for r in tables.read_bodies(spark, bodies).collect()} == {("007", "101"), ("qB", "101"), (FOLDER, "107")}
    got = {(r.query_folder, r.id) for r in tables.read_abstracts_table(spark, abstracts).collect()}
    assert got == {("007", "101"), ("qB", "101"), ("qB", "103"), (FOLDER, "107")}
    jobs.extract_bodies(articles, bodies, missing=missing)
    assert ("007", "102") in {(r.query_folder, r.id) for r in spark.read.parquet(missing).collect()}


def test_upsert_without_folder_and_without_moving_contents(spark, tmp_path):
    path = str(tmp_path / "landing")
    day = datetime.datetime(2024, 1, 1)
    batch = lambda *rows: spark.createDataFrame([(f, i, c.encode(), d) for f, i, c, d in rows], schemas.ARTICLES_RAW)
    sinks.upsert_articles(batch((None, "1", "a", day), ("", "2", "b", day), ("x", "1", "c", None)), path)
    sinks.upsert_articles(batch((None, "3", "d", day), (None, "1", "later", day), ("x", "1", "e", None), ("x", None, "f", day)), path)
    sinks.upsert_articles(batch(("x", None, "g", None)), path)
    got = {(r.query_folder, r.id, r.content.decode()) for r in tables.read_landed(spark, path).collect()}
    assert got == {(None, "1", "later"), (None, "2", "b"), (None, "3", "d"), ("x", "1", "e"), ("x", None, "f")}


def _batch(spark, *rows):
    return spark.createDataFrame([(f, i, c.encode(), d) for f, i, c, d in rows], schemas.ARTICLES_RAW)


def _parts(path):
    return {str(p.relative_to(path)) for p in Path(path).rglob("*.parquet")}


DAY = datetime.datetime(2024, 1, 1)


def test_an_article_rewrites_one_bucket_of_its_folder(spark, tmp_path):
    path = tmp_path / "landing"
    sinks.upsert_articles(_batch(spark, *[(f, str(i), "x", DAY) for f in "ab" for i in range(200)]), str(path))
    before = _parts(path)
    sinks.upsert_articles(_batch(spark, ("a", "7", "new", DAY)), str(path))
    folders = {os.path.dirname(name) for name in _parts(path) ^ before}
    assert len(folders) == 1 and len({os.path.dirname(name) for name in before}) > 10
    got = {(r.query_folder, r.id): r.content for r in tables.read_landed(spark, str(path)).collect()}
    assert len(got) == 400 and got["a", "7"] == b"new" and got["b", "7"] == b"x"


def test_contents_that_stay_do_not_move(spark, tmp_path):
    path = str(tmp_path / "landing")
    sinks.upsert_articles(_batch(spark, *[("a", str(i), "x", DAY) for i in range(50)]), path)
    sinks._keys_and_times(_batch(spark, ("a", "7", "new", DAY))).write.parquet(str(tmp_path / "times"))
    times = spark.read.parquet(str(tmp_path / "times"))
    plan = sinks.staying(tables.read_landed(spark, path), times)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and not re.search(r"(?<!Broadcast)Exchange", plan)


@pytest.mark.parametrize("lost_after", [0, 1, 2])
def test_a_lost_writer_is_made_up_for(spark, tmp_path, monkeypatch, lost_after):
    """The driver is lost before, between or after the first partitions are put in place, old ones deleted."""
    path = str(tmp_path / "landing")
    sinks.upsert_articles(_batch(spark, *[("a", str(i), "old", DAY) for i in range(60)]), path)
    listed = sinks.partition_folders

    def lost(session, folder, levels):
        names = listed(session, folder, levels)
        if sinks.PENDING not in folder:
            return names
        shutil.rmtree(f"{path}/{names[lost_after]}")  # deleted, not yet replaced
        return [*names[:lost_after], "query_folder=a/bucket=none"]

    monkeypatch.setattr(sinks, "partition_folders", lost)
    with pytest.raises(Exception):
        sinks.upsert_articles(_batch(spark, *[("a", str(i), "new", DAY) for i in range(40)]), path)
    monkeypatch.undo()
    sinks.upsert_articles(_batch(spark, ("b", "1", "x", DAY)), path)
    got = {(r.query_folder, r.id): r.content for r in tables.read_landed(spark, path).collect()}
    assert got == {("b", "1"): b"x"} | {("a", str(i)): b"new" if i < 40 else b"old" for i in range(60)}
    assert not [n for n in os.listdir(path) if n.startswith(sinks.PENDING)]


def test_the_first_writer_decides_the_buckets(spark, tmp_path):
    path = str(tmp_path / "landing")
    rows = _batch(spark, *[("a", str(i), "x", DAY) for i in range(30)])
    for buckets in (3, 50):
        sinks.upsert_by_folder(rows, path, schemas.ARTICLES_RAW, buckets)
    assert tables.read_landed(spark, path).count() == 30
    assert len({os.path.dirname(n) for n in _parts(path)}) == 3


def test_a_small_batch_looks_at_its_own_buckets(spark, tmp_path):
    path = str(tmp_path / "dataset")
    rows = lambda ids: spark.createDataFrame([("text", i) for i in ids], schemas.ABSTRACT_DATASET)
    everything = [str(i) for i in range(2000)]
    sinks.append_unseen(rows(everything), path, "ID", [F.col("Abstract")], buckets=64)
    small = str(tmp_path / "small")
    sinks.append_unseen(rows(everything[:10] + ["new"]), small, "ID", [F.col("Abstract")], buckets=64)
    known = sinks._same_partitions(spark, path, small, 1, spark.read.parquet(path).schema)
    assert 0 < len(known.inputFiles()) <= 11 < len(_parts(path))
    plan = known.select("ID")._jdf.queryExecution().executedPlan().toString()
    assert "Abstract" not in plan.split("ReadSchema")[1]
    before = _parts(path)
    sinks.append_unseen(rows(everything[:10] + ["new"]), path, "ID", [F.col("Abstract")])
    assert before < _parts(path) and spark.read.parquet(path).count() == 2001


def test_two_runs_of_the_same_version(spark, tmp_path):
    path = str(tmp_path / "state")
    day = datetime.date(2024, 5, 28)
    one = lambda query: spark.createDataFrame([(query, day)], schemas.RUN_STATE)
    sinks.commit_run_state(one("q"), path)
    tries = []

    def slow(now):
        """Another run commits while this one is at work."""
        tries.append(now.count())
        if len(tries) == 1:
            sinks.update_run_state(spark, path, lambda found: found.union(one("faster")))
        return now.union(one("slower"))

    sinks.update_run_state(spark, path, slow)
    assert tries == [1, 2] and tables.versions(spark, path) == [1, 2, 3]
    assert {r.query_id for r in tables.read_run_state(spark, path).collect()} == {"q", "faster", "slower"}


def test_records_lie_in_files_by_bytes(spark, tmp_path):
    rows = _batch(spark, *[("a b" if i % 3 else "é", str(i), "line\n\x00é", DAY) for i in range(300)], (None, "x", "y", None))
    root = str(tmp_path / "records")
    sinks.land_records(rows, root)
    got = files.read_records(spark, root)
    assert got.columns == schemas.ARTICLES_RAW.names
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in rows.collect()}
    few = len(list(Path(root).rglob("*.json")))
    assert few <= 6
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "2k")
    try:
        sinks.land_records(rows.withColumn("content", F.sha2(F.col("id"), 512).cast("binary")), str(tmp_path / "large"))
    finally:
        spark.conf.unset(size)
    assert len(list((tmp_path / "large").rglob("*.json"))) > few


def test_selection_lands_articles_without_a_date(spark, tmp_path):
    corpus = spark.createDataFrame([("1", "alpha", "one", datetime.date(2024, 1, 2)), ("2", "alpha", "two", None)],
                                   "id string, abstract string, content string, pub_date date")
    queries = spark.createDataFrame([("q", "alpha", "q")], schemas.QUERIES)
    terms = spark.createDataFrame([("q", 0, "alpha", "Abstract")], schemas.QUERY_TERMS)
    landing, state = str(tmp_path / "landing"), str(tmp_path / "state")
    jobs.select_articles(spark, corpus, queries, terms, landing, state, datetime.date(2024, 1, 5), first_run=True)
    assert {r.id for r in tables.read_landed(spark, landing).collect()} == {"1", "2"}
