import shutil

import pytest
from pyspark.sql import functions as F

from litscreen.operators import dedup
from litscreen.plans import jobs, queries
from litscreen.sources import files
from litscreen.streaming import ingest


def _run(query):
    query.awaitTermination()
    assert query.exception() is None


def _content(spark, path):
    return {(r.ID, r.Abstract) for r in spark.read.parquet(path).collect()}


def test_stream_equals_batch_and_takes_up_what_is_new(spark, corpus, tmp_path):
    target, checkpoint, batch = (str(tmp_path / n) for n in ("stream", "checkpoint", "batch"))
    _run(ingest.abstract_stream(ingest.article_stream(spark, corpus), target, checkpoint))
    jobs.build_abstract_dataset(files.read_articles(spark, corpus), batch)
    assert _content(spark, target) == _content(spark, batch)
    # The same ID in another folder adds nothing, a new one does.
    shutil.copy(f"{corpus}/qA/101.xml", f"{corpus}/qA/200.xml")
    shutil.copy(f"{corpus}/qA/101.xml", f"{corpus}/qA/107.xml")
    _run(ingest.abstract_stream(ingest.article_stream(spark, corpus, 1), target, checkpoint))
    assert {i for i, _ in _content(spark, target)} == {"101", "107", "200"}
    assert spark.read.parquet(target).count() == 3


def test_a_repeated_batch_adds_nothing(spark, corpus, tmp_path):
    target = str(tmp_path / "stream")
    for run in ("first", "lost checkpoint"):
        _run(ingest.abstract_stream(ingest.article_stream(spark, corpus, 2), target, str(tmp_path / run)))
    assert spark.read.parquet(target).count() == 2


def test_records_stream_in_batches_of_files(spark, data, tmp_path):
    root, target, checkpoint = queries._landed_records(spark, data), str(tmp_path / "stream"), str(tmp_path / "checkpoint")
    _run(ingest.abstract_stream(ingest.record_stream(spark, root, 1), target, checkpoint, "article"))
    jobs.build_abstract_dataset(files.read_records(spark, root), str(tmp_path / "batch"), element="article")
    assert _content(spark, target) == _content(spark, str(tmp_path / "batch"))


def test_a_batch_that_was_appended_is_skipped_at_once(spark, corpus, tmp_path, monkeypatch):
    """Spark repeats a batch that was lost before it was marked as done."""
    target, checkpoint = str(tmp_path / "stream"), tmp_path / "checkpoint"
    stream = ingest.article_stream(spark, corpus)
    _run(ingest.abstract_stream(stream, target, str(checkpoint)))
    assert [p.name for p in (checkpoint / "appended").iterdir() if not p.name.startswith(".")] == ["0"]
    for name in ("0", ".0.crc"):
        (checkpoint / "commits" / name).unlink()

    def never(*_):
        raise AssertionError("the batch was looked at again")

    monkeypatch.setattr(ingest, "append_unseen", never)
    _run(ingest.abstract_stream(stream, target, str(checkpoint)))
    monkeypatch.undo()
    shutil.copy(f"{corpus}/qA/101.xml", f"{corpus}/qA/300.xml")
    _run(ingest.abstract_stream(stream, target, str(checkpoint)))
    assert {i for i, _ in _content(spark, target)} == {"101", "107", "300"}


def test_state_drops_seen_keys(spark, tmp_path):
    source = tmp_path / "rows"
    source.mkdir()
    stream = spark.readStream.schema("ID string, at timestamp").json(str(source))

    def land(name, *lines):
        (source / name).write_text("\n".join('{"ID": "%s", "at": "2024-01-0%d 00:00:00"}' % line for line in lines))

    def run(df, name):
        target = str(tmp_path / name)
        query = (
            df.writeStream.format("parquet").option("checkpointLocation", target + "-state")
            .trigger(availableNow=True).start(target)
        )
        query.awaitTermination()
        return sorted(r.ID for r in spark.read.schema("ID string, at timestamp").parquet(target).collect())

    land("1.json", ("a", 1), ("a", 1), ("b", 1))
    assert run(ingest.drop_seen(stream, "ID"), "all") == ["a", "b"]
    assert run(ingest.drop_seen(stream, "ID", "at", "1 day"), "bounded") == ["a", "b"]
    land("2.json", ("a", 2), ("c", 2))
    assert run(ingest.drop_seen(stream, "ID"), "all") == ["a", "b", "c"]
    assert run(ingest.drop_seen(stream, "ID", "at", "1 day"), "bounded") == ["a", "b", "c"]


@pytest.mark.parametrize("live, again", [("9 days", ["c"]), ("2 days", ["a", "b", "c"])])
def test_state_ends_and_outlives_a_restart(spark, tmp_path, live, again):
    """Runs from the same checkpoint: live keys are known, expired ones come again."""
    source, target, checkpoint = tmp_path / "rows", str(tmp_path / "out"), str(tmp_path / "state")
    source.mkdir()

    def run(name, *rows):
        (source / name).write_text("\n".join('{"ID": "%s", "n": %d, "at": "2024-01-%02d 12:00:00"}' % row for row in rows))
        stream = spark.readStream.schema("ID string, n int, at timestamp").json(str(source))
        (ingest.first_seen(stream, "ID", "n", "at", live, "1 hour").writeStream.format("parquet")
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(target).awaitTermination())
        return sorted((r.ID, r.n) for r in spark.read.parquet(target).collect())

    assert run("1.json", ("a", 3, 1), ("a", 1, 1), ("b", 9, 1), ("b", 8, 2), ("b", 10, 1)) == [("a", 1), ("b", 8)]
    assert run("2.json", ("d", 1, 5)) == [("a", 1), ("b", 8), ("d", 1)]  # time goes on
    late = run("3.json", ("a", 30, 6), ("b", 30, 6), ("b", 31, 6), ("c", 30, 6))
    assert [i for i, n in late if n == 30] == again and len(late) == 3 + len(again)


def test_each_landed_page_is_an_article_of_its_own(spark, data, tmp_path):
    """The newest page of each address, as the batch job takes it in."""
    newest = dedup.latest_per_key(queries._raw_articles(spark, data), ["query_folder", "id"], [F.col("fetched_at").desc()])
    jobs.build_abstract_dataset(newest, str(tmp_path / "batch"), element="article")
    rows = queries.stream_ingest(spark, data).collect()
    assert {(r.ID, r.Abstract) for r in rows} == _content(spark, str(tmp_path / "batch"))
    assert len(rows) == newest.select("id").distinct().count()
