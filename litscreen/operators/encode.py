"""Vocabulary and token ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from litscreen import settings
from litscreen.functions import text
from litscreen.operators.joins import salted_join

_FIRST_WORD_ID = settings.END_ID + 1
MOST_TERMS = 1_000_000  # of a vocabulary that is sent along with the rows
TRACKED = 65_536  # terms that a summary of one task holds
SUMMARY_ERROR = 3.5  # fixed value: a summary of m places is off by at most this share of all tokens over m


def heavy_terms(tokens: DataFrame, size: int, tracked: int = TRACKED) -> DataFrame | None:
    """A few terms with their counts, among which are the ``size`` most frequent ones; None if that is not certain.

    Each task sums up its tokens in a summary of bounded size; only summaries move. What a summary misses is rarer than
    its bound of error. The terms that it holds are counted, and if the last one wanted is more frequent than the
    bound, then no other term can be.
    """
    if size > tracked // 2:
        return None
    summary = F.expr(f"approx_top_k(term, {min(100_000, tracked * 3 // 4)}, {tracked})")
    found, total = tokens.agg(summary, F.count("*")).first()
    spark = tokens.sparkSession
    held = spark.createDataFrame([(entry[0],) for entry in found if entry[0] is not None], "term string")
    counts = tokens.join(F.broadcast(held), "term", "left_semi").groupBy("term").agg(F.count("*").alias("n"))
    last = counts.orderBy(F.col("n").desc()).limit(size).agg(F.min("n"), F.count("*")).first()
    certain = last[1] == size and last[0] > total * SUMMARY_ERROR / tracked
    return counts if certain else None


def vocabulary(documents: DataFrame, text_col: str, size: int, prune: bool = False) -> DataFrame:
    """The ``size`` most frequent tokens with their count and id; ids follow the special ones.

    Counts are added up before the shuffle. Only the chosen rows are ranked in one task. With ``prune``, summaries of
    the tasks first leave out the long tail of rare terms, so that it is not shuffled; the result is the same. That
    reads the texts more often, and pays where most terms are rare.
    """
    tokens = documents.select(F.explode(text.tokens(F.col(text_col))).alias("term"))
    counts = heavy_terms(tokens, size) if prune else None
    if counts is None:
        counts = tokens.groupBy("term").agg(F.count("*").alias("n"))
    order = [F.col("n").desc(), F.col("term")]
    top = counts.orderBy(*order).limit(size)
    rank = F.row_number().over(Window.orderBy(*order))
    return top.withColumn("token_id", (rank + (_FIRST_WORD_ID - 1)).cast("int"))


def _lookup_table(vocab: DataFrame, slots: int) -> Column:
    """The vocabulary in one value: an array of small maps, found by the hash of the term.

    The value goes to every executor; :func:`encode` sees to it that it is small. Spark computes it once for a query.
    """
    slot = F.pmod(F.xxhash64("term"), F.lit(slots)).cast("int")
    entries = vocab.select(slot.alias("slot"), F.struct("term", "token_id").alias("entry"))
    # One row without an entry for each slot, so that no slot is missing.
    gaps = vocab.sparkSession.range(slots).select(F.col("id").cast("int").alias("slot"))
    filled = (
        entries.unionByName(gaps, allowMissingColumns=True)
        .groupBy("slot")
        .agg(F.sort_array(F.collect_list("entry")).alias("entries"))
    )
    table = filled.agg(F.sort_array(F.collect_list(F.struct("slot", "entries"))).alias("rows"))
    return table.select(
        F.transform("rows", lambda row: F.map_from_entries(row["entries"])).alias("table")
    ).scalar()


def _cut(documents: DataFrame, text_col: str, max_tokens: int) -> Column:
    return F.slice(text.tokens(F.col(text_col)), 1, max_tokens - 2)


def _framed(ids: Column) -> Column:
    return F.concat(F.array(F.lit(settings.START_ID)), ids, F.array(F.lit(settings.END_ID)))


def _encode_in_place(documents: DataFrame, vocab: DataFrame, id_col: str, text_col: str, max_tokens: int, slots: int) -> DataFrame:
    def id_of(token: Column) -> Column:
        entries = F.get("_vocab", F.pmod(F.xxhash64(token), F.lit(slots)).cast("int"))
        return F.coalesce(F.try_element_at(entries, token), F.lit(settings.UNKNOWN_ID))

    # Lambdas may use columns but not subqueries, hence the step between.
    cut = documents.select(id_col, _cut(documents, text_col, max_tokens).alias("_tokens"), _lookup_table(vocab, slots).alias("_vocab"))
    return cut.select(id_col, _framed(F.transform("_tokens", id_of)).alias("input_ids"))


def _encode_by_join(documents: DataFrame, vocab: DataFrame, id_col: str, text_col: str, max_tokens: int) -> DataFrame:
    """Positions meet a vocabulary of any size by their term, frequent terms spread by salts, and go back to their row."""
    rows = documents.select(
        F.monotonically_increasing_id().alias("_row"), F.col(id_col), _cut(documents, text_col, max_tokens).alias("_tokens"))
    # An entry without a term keeps texts without tokens; a missing text has none at all.
    entries = F.concat(F.array(F.lit(None).cast("string")), "_tokens")
    placed = rows.select("_row", id_col, F.posexplode_outer(entries).alias("_at", "term"))
    met = salted_join(placed, vocab.select("term", "token_id"), "term", "_row", "left")
    entry = F.struct("_at", F.coalesce("token_id", F.lit(settings.UNKNOWN_ID)).alias("token_id"))
    back = met.groupBy("_row", id_col).agg(F.array_sort(F.collect_list(entry)).alias("_ids"), F.max("_at").alias("_last"))
    ids = F.transform(F.slice("_ids", 2, F.greatest(F.col("_last"), F.lit(0))), lambda e: e["token_id"])
    return back.select(id_col, F.when(F.col("_last").isNotNull(), _framed(ids)).alias("input_ids"))


def encode(
    documents: DataFrame,
    vocab: DataFrame,
    id_col: str,
    text_col: str,
    max_tokens: int = settings.MAX_TOKENS,
    slots: int = 4096,
    terms: int | None = None,
    most_terms: int = MOST_TERMS,
) -> DataFrame:
    """ID and token ids of each text, not padded: the form to store.

    A text gives the start id, the ids of its tokens and the end id, and is cut to ``max_tokens`` with these two
    included. ``terms`` is the number of terms of the vocabulary at most, which is counted if it is not given. With up
    to ``most_terms`` the vocabulary is sent along and texts are encoded in place; a larger one is met by a join.
    """
    if (vocab.count() if terms is None else terms) <= most_terms:
        return _encode_in_place(documents, vocab, id_col, text_col, max_tokens, slots)
    return _encode_by_join(documents, vocab, id_col, text_col, max_tokens)


def longest_row(documents: DataFrame, text_col: str, max_tokens: int = settings.MAX_TOKENS) -> Column:
    """The length of the longest row that :func:`encode` makes of these texts, from counts of tokens alone."""
    tokens = F.least(F.size(text.tokens(F.col(text_col))), F.lit(max_tokens - 2))
    return documents.agg((F.max(tokens) + 2).alias("longest")).scalar()


def pad(encoded: DataFrame, longest: Column | int | None = None) -> DataFrame:
    """Pad with zeros and mark the real tokens by a mask.

    The default pads to the longest row of the data set, which encodes it a second time;
    :func:`longest_row` finds the same number cheaper.
    """
    if longest is None:
        longest = encoded.agg(F.max(F.size("input_ids")).alias("longest")).scalar()
    length = F.size("input_ids")
    missing = F.lit(longest) - length if isinstance(longest, int) else longest - length
    zeros = F.array_repeat(F.lit(settings.PAD_ID), missing)
    mask = F.concat(F.array_repeat(F.lit(1), length), F.array_repeat(F.lit(0), missing))
    return encoded.withColumns(
        {"input_ids": F.concat("input_ids", zeros), "attention_mask": mask}
    )
