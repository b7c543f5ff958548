import hashlib
import re

import pytest
from hypothesis import HealthCheck, given, settings as h
from hypothesis import strategies as st
from pyspark.sql import functions as F

from litscreen import settings
from litscreen.functions import text

QUERIES = [
    '("infertility" OR PCOS OR Müllerian Duct)[Abstract] AND ("genetic variant")[Abstract]',
    "a/b\\c|d?e*f:g<h>i", "", "x" * 80, "_[a] (b) __ c_", "Cushing's Syndrome [x](y",
]


def _apply(spark, column, values):
    # Repeated blanks and line breaks must survive the way in, so no CSV and no SQL strings.
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(column(F.col("v"))).collect()]


def _short(query):
    return re.sub(settings.FORBIDDEN_NAME_CHARS, "", query.replace(" ", "_"))[:50]


def test_query_names(spark):
    hashes = [hashlib.md5(q.encode()).hexdigest()[:8] for q in QUERIES]
    assert _apply(spark, text.folder_name, QUERIES) == [_short(q) for q in QUERIES]
    assert _apply(spark, text.short_hash, QUERIES) == hashes
    assert _apply(spark, text.query_key, QUERIES) == [f"{_short(q)}_{x}" for q, x in zip(QUERIES, hashes)]


def test_long_names(spark):
    got = _apply(spark, text.long_folder_name, QUERIES)
    assert got == [
        "AND", "abcdefghi", "", "x" * 80, "c", "Cushing's_Syndrome_(y",
    ]


def test_dates(spark):
    assert _apply(spark, text.reformat_date, ["2024-05-28", None]) == ["2024/05/28", None]
    loose = _apply(spark, lambda c: text.reformat_date(c, strict=False), ["2024-05-28", "x"])
    assert loose == ["2024/05/28", None]
    with pytest.raises(Exception, match="not a date: 2024/05/28"):
        _apply(spark, text.reformat_date, ["2024/05/28"])


def test_search_text(spark):
    row = spark.sql("SELECT 'q' q, date'2024-05-28' a, date'2024-06-04' b")
    got = row.select(
        *[text.search_text(F.col("q"), F.lit(m), F.col("a"), F.col("b")) for m in ("FULL", "INCREMENTAL", "SKIP")]
    ).first()
    assert list(got) == ["q", "q AND (2024/05/28[PubDate] : 2024/06/04[PubDate])", None]


def test_ids_and_quotes(spark):
    assert _apply(spark, text.clean_id, ['"PMC9569987"', " 21429654 ", "11143662", None]) == [
        "PMC9569987", "21429654", "11143662", None,
    ]
    assert _apply(spark, text.without_quotes, ['a "b" c', '"']) == ["a b c", ""]


def _lines(value):
    return " ".join(line.strip() for line in re.split("\r\n|\r|\n", value) if line.strip())


@h(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("ab \n\r\t  \x85\x1f", max_size=30), min_size=1, max_size=40))
def test_one_line_is_strip_and_join(spark, values):
    assert _apply(spark, text.one_line, values) == [_lines(v) for v in values]
    assert _apply(spark, text.strip, values) == [v.strip() for v in values]


def test_words_and_tokens(spark):
    assert _apply(spark, text.words, ["Müllerian-Duct,  x2.", "...", "Cushing's"]) == [
        " müllerian duct x2 ", "  ", " cushing s ",
    ]
    assert _apply(spark, text.tokens, ["A b-c: 1,5!"]) == [["a", "b", "-", "c", ":", "1", ",", "5", "!"]]
