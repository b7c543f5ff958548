import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from odd import ODD

from litscreen.llm import recompress


def brute(rows):
    """Rows are (id, text) in order; the words that stay, by row."""
    seen, result = set(), []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = set()
        for i in range(len(words) - 19):
            window = tuple(words[i:i + 20])
            if window in seen:
                gone.update(range(i, i + 20))
            seen.add(window)
        result.append((len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)))
    return result


def passages(seed, n=300):
    """Texts of few and many words with shared passages, runs, periods and copies."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(rng.choice([2, 40, 3000]))]
    pool = [[rng.choice(vocabulary) for _ in range(rng.randint(15, 60))] for _ in range(12)]
    pool += [["a"] * rng.randint(1, 70), ["x", "y"] * 30, ["x", "y", "z"] * rng.randint(5, 30)]
    rows = []
    for _ in range(n):
        words = []
        for _ in range(rng.randint(0, 5)):
            p = rng.choice(pool)
            a = rng.randint(0, 5)
            words += rng.choice([p, p[a:], p[: len(p) - a], [rng.choice(vocabulary) for _ in range(rng.randint(1, 30))]])
        rows.append(" ".join(words))
    return rows


@pytest.fixture()
def small_groups(monkeypatch):
    monkeypatch.setattr(recompress, "GROUP_BYTES", 3000)


@pytest.mark.parametrize("seed", range(4))
def test_equals_brute_force(spark, small_groups, seed):
    texts = passages(seed)
    rows = [(i * 3 + 2**40 * (i % 7 == 0), t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in recompress.remove_repeats(docs).collect()}
    rows.sort()
    assert found == dict(zip([i for i, _ in rows], brute(rows)))
    assert sum(r[1] for r in found.values()) > 0


@pytest.mark.parametrize("words", [2, 5, 300])
def test_equal_windows_share_symbols(words):
    """Whatever stands around two equal windows, they share the symbols that reveal them, and have one name."""
    rng = np.random.default_rng(words)
    vocabulary = [f"w{i}" for i in range(words)]
    for _ in range(400):
        window = rng.choice(vocabulary, 20).tolist()
        if rng.random() < 0.3:
            window = np.resize(rng.choice(vocabulary, rng.integers(1, 4)), 20).tolist()
        revealed, named = [], []
        for _ in range(2):
            before, after = (rng.choice(vocabulary, rng.integers(0, 12)).tolist() for _ in range(2))
            if rng.random() < 0.5:
                before, after = window[len(window) - len(before):], window[:len(after)]
            group = recompress.Group(pa.table({"doc_id": [1], "text": [" ".join(before + window + after)]}))
            at, phrase = group.phrases()
            near = (at >= len(before)) & (at <= len(before) + recompress.LOSS)
            revealed.append({(int(a) - len(before), int(p)) for a, p in zip(at[near], phrase[near])})
            named.append([int(x[0]) for x in group.windows(np.array([len(before)]))[:2]])
        assert revealed[0] & revealed[1]
        assert named[0] == named[1]


def test_symbols_name_what_they_hold():
    """Symbols with the same name stand for the same words, and are up to four words long."""
    rng = np.random.default_rng(1)
    words = rng.choice(recompress.mix(np.arange(1, 5, dtype=np.uint64)), 4000)
    first, names = recompress.parse(words, np.repeat(np.arange(40), 100))
    held = {}
    for name, begin, end in zip(names.tolist(), first, np.append(first[1:], len(words))):
        assert held.setdefault(name, words[begin:end].tolist()) == words[begin:end].tolist()
    assert {len(h) for h in held.values()} == {1, 2, 3, 4} and set(range(0, 4000, 100)) <= set(first.tolist())


def test_hot_id_is_dealt_out(spark, small_groups):
    """Rows of one ID, or none, are spread over groups; of each passage one occurrence stays."""
    passage = " ".join(f"p{i}" for i in range(25))
    rows = [(i % 2 or None, f"{passage} q{i} r{i}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = recompress.remove_repeats(docs).collect()
    assert sorted(r.n_removed for r in found) == [0] + [25] * 199
    assert [r.doc_id for r in found if not r.n_removed] == [1]


def test_odd_texts(spark, small_groups):
    long = " ".join(map(str, range(30)))
    rows = [*enumerate(ODD), (None, long), (None, long), (900, long), (900, long), (901, "x " + long + "\n\n y")]
    docs = spark.createDataFrame([(i, t, "z", 1) for i, t in rows], "doc_id long, text string, kept string, grp int")
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    found = recompress.remove_repeats(docs).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in found), key=repr) == sorted(
        ((i, *b) for (i, _), b in zip(order, brute(order))), key=repr)
    assert recompress.remove_repeats(docs.limit(0)).count() == 0


def test_query_on_whole_table(spark, data):
    from litscreen.llm.queries import op4_substring_recompression

    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").collect())
    truth = {i: (n, gone, hashlib.sha256(kept.encode()).hexdigest()) for (i, _), (n, gone, kept) in zip(rows, brute(rows))}
    found = op4_substring_recompression(spark, data).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in found} == truth and len(found) == len(rows)
