import time
import random
import unicodedata

import public_tokenizers
import pytest
from odd import ODD
from tokenizers import Tokenizer

from litscreen.llm import counts

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def truth(library, text):
    return len(library.encode(text or "", add_special_tokens=False).ids)


def test_odd_texts(spark, library):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(ODD)] + [(None, "a b", "x"), (0, None, "x")],
                                 "doc_id long, text string, n_tokens string")
    rows = counts.count_tokens(docs, PATH).collect()
    assert len(rows) == len(ODD) + 2
    for r in rows:
        if r.doc_id is not None:
            assert r.n_tokens == truth(library, ODD[r.doc_id]), ODD[r.doc_id]
            assert r.n_bytes == len((ODD[r.doc_id] or "").encode()) and r.over_limit == (r.n_tokens > 1024)
    assert counts.count_tokens(docs.limit(0), PATH).count() == 0


def test_every_character(library):
    """Each assigned code point between letters and beside spaces."""
    texts = [f"a{chr(c)}b {chr(c)}c{chr(c)} {chr(c)}\n" for c in range(0x3400) if unicodedata.category(chr(c)) not in ("Cn", "Cs")]
    for some in (texts, [f"x{chr(c)} y" for c in range(0x3400, 0x30000, 61) if unicodedata.category(chr(c)) not in ("Cn", "Cs")]):
        assert counts.counter(PATH).count(some) == [truth(library, t) for t in some]


def test_query_on_whole_table(spark, data, library):
    from litscreen.llm.queries import op3_token_counts

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    rows = op3_token_counts(spark, data).collect()
    assert {r.doc_id: r.n_tokens for r in rows} == {i: truth(library, t) for i, t in texts.items()} and len(rows) == len(texts)


def test_long_words_are_merged_in_seconds():
    """Random letters, runs of one letter and of two, far beyond the length from which on a word is merged by itself."""
    rng = random.Random(9)
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    texts = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n)) for n in (511, 512, 513, 5000, 128_000)]
    texts += ["a" * 30_000, "ab" * 7000 + "a", "é" * 999, "".join(rng.choice("aeé") for _ in range(20_000)), "x" * 511 + " " + "x" * 512]
    start = time.time()
    found = counts.counter(path).count(texts)
    assert time.time() - start < 30
    assert found == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
