import hashlib
import itertools
import unicodedata

import public_tokenizers
import pytest
import regex
from hypothesis import given, settings, strategies as st
from odd import ODD
from tokenizers import Tokenizer

from litscreen.llm import automaton, vocabulary

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def check(row, library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    assert row.n_tokens == len(ids), text
    assert row.ids_sha256 == digest(" ".join(map(str, ids))), text
    assert row.decoded_sha256 == digest(library.decode(ids, skip_special_tokens=False)), text


def test_odd_texts(spark, library):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(ODD)] + [(None, "a b", "x"), (0, None, "x")],
                                 "doc_id long, text string, ids string")
    from litscreen.llm.queries import digests

    rows = digests(automaton.round_trip(docs, PATH)).collect()
    assert len(rows) == len(ODD) + 2
    for r in rows:
        if r.doc_id is not None:
            check(r, library, ODD[r.doc_id])
    assert automaton.encode(docs, PATH).columns == ["doc_id", "text", "n_tokens", "ids"]
    assert automaton.round_trip(docs.limit(0), PATH).count() == 0


def test_every_character(library):
    texts = [f"a{chr(c)}b {chr(c)}c{chr(c)} {chr(c)}\n" for c in range(0x3400) if unicodedata.category(chr(c)) not in ("Cn", "Cs")]
    texts += [f"x{chr(c)} y" for c in range(0x3400, 0x30000, 61) if unicodedata.category(chr(c)) not in ("Cn", "Cs")]
    own = automaton.codec(PATH)
    wrong = [t for t in texts if own.encode(t).tolist() != library.encode(t, add_special_tokens=False).ids]
    assert not wrong


def test_characters_unknown_to_python(library):
    """Letters, digits and folds of later versions of Unicode, and every 41st code point of no version."""
    unknown = [chr(c) for c in range(0x34000) if unicodedata.category(chr(c)) == "Cn"]
    later = [c for c in unknown if regex.match(r"\P{Cn}", c)]
    assert len(later) > 1000
    own = automaton.codec(PATH)
    for c in later + unknown[::41]:
        text = f"a{c}b {c}c{c} 1{c}!{c}{c}é"
        assert own.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids, hex(ord(c))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aabcdehilnorst'1.! éΣ", max_size=60))
def test_any_text(text):
    library = Tokenizer.from_file(PATH)
    assert automaton.codec(PATH).encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def _merge(word, merges):
    """BPE by its definition: the lowest rank first, from left to right."""
    symbols = [*word[:-1], word[-1] + "</w>"]
    for a, b in merges:
        i = 0
        while i < len(symbols) - 1:
            if (symbols[i], symbols[i + 1]) == (a, b):
                symbols[i:i + 2] = [a + b]
            i += 1
    return symbols


def test_small_vocabularies_by_all_words():
    """Random proper merge lists, self-merges and dead merges among them, against the definition."""
    import random

    rng = random.Random(5)
    for _ in range(30):
        base = [c + e for c in "ab" for e in ("", "</w>")]
        tokens, merges = list(base), []
        while len(merges) < 9:
            a, b = rng.choice([t for t in tokens if not t.endswith("</w>")]), rng.choice(tokens)
            if a + b not in tokens:
                merges.append((a, b))
                tokens.append(a + b)
        vocab = vocabulary.Vocabulary({t: i for i, t in enumerate(tokens)}, merges, {})
        own = automaton.Automaton(vocab)
        for n in range(1, 10):
            for word in map("".join, itertools.product("ab", repeat=n)):
                assert [tokens[i] for i in own.path(word)] == _merge(word, merges), (word, merges)


def test_query_on_whole_table(spark, data, library):
    from litscreen.llm.queries import op10_bpe_automaton

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    rows = op10_bpe_automaton(spark, data).collect()
    assert len(rows) == len(texts)
    for r in rows:
        check(r, library, texts[r.doc_id])
