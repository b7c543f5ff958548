import numpy as np
import public_tokenizers
from test_vantage import brute_components, brute_fingerprint
from tokenizers import Tokenizer

import corpus_pipeline
from litscreen.llm import mixing, rules, secrets
from litscreen.llm.queries import WEIGHTS


def test_stages_against_brute_force(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == list(stages) and len(stages) == 5
    now, found = docs, []
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, now, data)
        assert after.columns[:5] == docs.columns
        found.append({name: after})
        if name != corpus_pipeline.STAGES[-1][0]:
            now = spark.createDataFrame(after.collect(), docs.schema)
    judged = rules.judge(docs, rules.fit(docs, spark.read.parquet(f"{data}/labels.parquet")))
    good = {r.doc_id for r in judged.where("kept").collect()}
    kept = [r for r in docs.collect() if r.doc_id in good]
    assert sorted(r.doc_id for r in found[0]["quality rules"].collect()) == sorted(good) and 0 < len(good) < docs.count()
    heads = set(brute_components([(r.doc_id, brute_fingerprint(r.text)) for r in kept]))
    assert sorted(r.doc_id for r in found[1]["SimHash near-dedup"].collect()) == sorted(heads) and len(heads) < len(kept)
    clean = {r.doc_id: r for r in found[2]["secret scans"].collect()}
    assert set(clean) == heads
    for r in kept:
        if r.doc_id in heads:
            spans = secrets.spans(r.text)
            assert clean[r.doc_id].text == (secrets.without(r.text, spans) if spans else r.text)
    mixed = [r.doc_id for r in found[3]["mixing sources to target weights"].collect()]
    means, rest = mixing.rates(spark.createDataFrame(list(clean.values()), docs.schema), WEIGHTS)
    assert set(mixed) <= heads and abs(len(mixed) - len(heads)) < 6 * np.sqrt(len(heads)) and rest > 0 and means
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = found[4]["BPE encoding and decoding"].collect()
    assert sorted(r.doc_id for r in rows) == sorted(mixed)
    assert all(list(r.ids) == library.encode(r.text, add_special_tokens=False).ids and r.n_tokens == len(r.ids) for r in rows[:60])


def test_whole_run(spark, data):
    rows = corpus_pipeline.run(spark, data)
    assert rows.columns == ["doc_id", "text", "lang", "source", "n_chars", "n_tokens", "ids"] and rows.count() > 50


def _folder(spark, tmp_path, docs, labels):
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long, made string, copy int").write.parquet(
        str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int, kept int").write.parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path)


def test_empty_tables(spark, tmp_path):
    assert corpus_pipeline.run(spark, _folder(spark, tmp_path, [], [])).count() == 0


def test_odd_documents_as_a_whole(spark, tmp_path):
    """Null and repeated IDs, null, empty and long texts, equal rows, columns of clashing names, contradicting labels."""
    prose = " ".join(f"word{i}" for i in range(40))
    docs = [(None, None, None, None, None, None, None), (None, "", "en", "src0", 0, "m", 1), (1, prose, "en", "src1", 9, "m", 1),
            (1, prose, "en", "src1", 9, "m", 1), (1, prose.upper() + " else entirely", "en", None, 9, "m", 2),
            (None, prose[::-1], "de", "src0", 9, None, 3), (2, "x" * 200_000 + " " + prose, "en", "src2", 9, "m", 4),
            (3, " ".join(f"other{i}" for i in range(50)) + " token = abcdef0123456789", None, "src3", 9, "m", 5)]
    folder = _folder(spark, tmp_path, docs, [(1, 0, 0, 1), (1, 1, 0, 1), (None, 0, 0, 0), (3, None, None, None)])
    rows = corpus_pipeline.run(spark, folder).collect()
    texts = {r.text for r in rows}
    assert rows and texts <= {prose, prose[::-1], prose.upper() + " else entirely", docs[6][1],
                              docs[7][1].replace("token = abcdef0123456789", "[SECRET]")}
    assert all(r.n_tokens == len(r.ids) for r in rows)
