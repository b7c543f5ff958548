"""One query for each operator, over its whole table, with the parameters meant for use."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from litscreen.llm import (
    automaton, counts, density, divergence, interaction, mixing, pivots, recompress, rules, secrets, toxicity, vantage, warc,
)
from litscreen.llm.texts import uint64_hex
from litscreen.session import materialise, shared_folder, spread


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as it is stored; one of a few splits is dealt out to the cores first."""
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return rules.judge(docs, rules.fit(docs, _table(spark, sf_dir, "labels")))


def op2_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "warc")
    index = materialise(warc.write(warc.planned(_table(spark, sf_dir, "pages")), folder), "warc-index")
    records = warc.read(index, folder, payloads=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op4_substring_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = recompress.remove_repeats(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op5_html_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return density.extract(_table(spark, sf_dir, "pages"))


def op6_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = pivots.scaled(_table(spark, sf_dir, "embeddings"))
    return pivots.top_k(vectors, F.col("vec_id") % 50 == 0)


#: Target weights of the mixture; sources that are not named share the rest.
WEIGHTS = {"src0": 0.1, "src1": 0.12, "src2": 0.08, "src3": 0.06, "src4": 0.04, "src5": 0.02}


def op7_poisson_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.replicate(_table(spark, sf_dir, "documents"), WEIGHTS)
    return mixed.select("doc_id", "source", "lang", "n_chars", "text", F.col("copy").cast("long").alias("copy"))


def op8_simhash_vantage(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = vantage.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", uint64_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(_table(spark, sf_dir, "documents")).drop("secrets")


def digests(encoded: DataFrame) -> DataFrame:
    """Hashes of the ids and of the decoded text."""
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return encoded.select("doc_id", "n_tokens", F.sha2(ids, 256).alias("ids_sha256"),
                          F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


def op10_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return digests(automaton.round_trip(docs, public_tokenizers.path("word_bpe_49k.json")))


def op11_ftrl_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))


def op12_filter_interaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interaction.audit(_table(spark, sf_dir, "documents"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents"))


ALL = [op1_quality_rules, op2_warc_index, op3_token_counts, op4_substring_recompression, op5_html_density, op6_exact_topk, op7_poisson_mixing, op8_simhash_vantage, op9_secret_scans, op10_bpe_automaton, op11_ftrl_toxicity, op12_filter_interaction, op13_source_divergence]
SQL = {
    "op2_warc_index": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS payload_digest,
             max(page_id) OVER (PARTITION BY html) AS keeper FROM p)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> keeper THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> keeper THEN keeper END AS refers_to, true AS intact FROM d""",
    "op6_exact_topk": """
WITH good AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
              WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
           FROM good q JOIN good c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM scored QUALIFY rank <= 5""",
    "op12_filter_interaction": interaction.SQL,
    "op13_source_divergence": divergence.SQL,
    "op7_poisson_mixing": mixing.sql(WEIGHTS, ["doc_id", "source", "lang", "n_chars", "text"]),
}
