import gzip
import hashlib

import duckdb
from pyarrow import fs
from pyspark.sql import functions as F

from litscreen.llm import warc
from litscreen.llm.queries import SQL, op2_warc_index

PAGES = [(1, "u1", "é" * 600), (2, "u2", "é" * 600), (3, None, "é" * 600), (4, "u4", "x" * 999), (5, "u4", "x" * 999), (6, "u 6\r\nX: y", ""),
         (7, "u7", None), (None, "n", "é" * 600), (None, "n", "only" * 400), (None, "n", "only" * 400), (9, "u9", "a\r\n\r\nb\x00" + "z" * 100_000),
         (10, "u", "q" * 2000), (10, "u", "q" * 2000), (8, "u", "q" * 2000)]


def truth(rows):
    found = []
    for i, _, html in rows:
        data = (html or "").encode()
        same = [j for j, _, h in rows if (h or "") == (html or "") and j is not None]
        keeper = max(same) if same and len(data) >= 1000 else i
        found.append((i, len(data), hashlib.sha1(data).hexdigest(), "response" if i == keeper else "revisit", None if i == keeper else keeper))
    return sorted(found, key=repr)


def test_round_trip(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("payload", F.lit(1)).repartition(3)
    index = warc.write(warc.planned(pages), str(tmp_path / "w"))
    index.write.parquet(str(tmp_path / "index"))
    index = spark.read.parquet(str(tmp_path / "index"))
    rows = warc.read(index, str(tmp_path / "w")).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows), key=repr) == truth(PAGES)
    html = {i: h for i, _, h in PAGES}
    for r in rows:
        assert r.intact and (r.payload is None) == (r.record_type == "revisit")
        if r.payload is not None and r.page_id is not None:
            assert bytes(r.payload).decode() == (html[r.page_id] or "")
    # The files are plain WARC: unpacked as a whole, one record follows the other.
    names = {r.file for r in index.select("file").collect()}
    whole = b"".join(gzip.decompress((tmp_path / "w" / n).read_bytes()) for n in names)
    assert whole.count(b"WARC/1.1\r\n") == len(PAGES) and b"\r\nX: y" not in whole
    one = warc.read(index.where("page_id = 9"), str(tmp_path / "w")).collect()
    assert len(one) == 1 and bytes(one[0].payload).startswith(b"a\r\n\r\nb\x00")
    assert warc.read(index.limit(0), str(tmp_path / "w")).count() == 0


def test_files_that_are_full_are_followed_by_new_ones(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 500)
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").coalesce(1)
    warc.write(warc.planned(pages), str(tmp_path / "w")).write.parquet(str(tmp_path / "index"))
    index = spark.read.parquet(str(tmp_path / "index"))
    assert warc.read(index, f"file://{tmp_path}/w").count() == len(PAGES)
    assert fs.LocalFileSystem().get_file_info(str(tmp_path / "w")).type == fs.FileType.Directory


def test_ranges():
    assert warc.ranges([(0, 10), (10, 5), (20, 5), (100, 5)], most=50, gap=5) == [(0, 25, 3), (100, 5, 1)]
    assert warc.ranges([(0, 10), (10, 45), (55, 1)], most=50, gap=5) == [(0, 10, 1), (10, 46, 2)]
    assert warc.ranges([(0, 10), (0, 10)]) == [(0, 10, 1), (0, 10, 1)] and warc.ranges([]) == []


def test_query_equals_sql(spark, data):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{data}/pages.parquet'")
    result = con.execute(SQL["op2_warc_index"])
    names = [c[0] for c in result.description]
    assert sorted(map(tuple, op2_warc_index(spark, data).select(*names).collect())) == sorted(result.fetchall())
