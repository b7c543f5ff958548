"""Standing boolean queries over a corpus.

A query is a set of clauses, all of which have to hold; a clause is a set of terms, any of
which is enough. A term is one word or a phrase. Case and punctuation do not matter, words
match whole, and the words of a phrase stand next to each other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from litscreen import settings
from litscreen.functions import text
from litscreen.operators.dedup import first_per_key
from litscreen.operators.joins import attach, measure, salted_join
from litscreen.sources.tables import create_once, read_small


def _anchor(phrase: Column) -> Column:
    """The longest word of a phrase: more or less the one that the fewest texts hold."""
    parts = F.split(F.trim(phrase), " ")
    return F.array_max(F.transform(parts, lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))))["w"]


def prepare_terms(query_terms: DataFrame, fields: list[str]) -> DataFrame:
    """The clauses of each query, and the terms of one of them as what the query is looked up by.

    One row for each term of the clause that triggers, the one that may hold in the fewest texts. ``earlier`` are the
    terms of that clause before this one, frequent ones first, ``others`` the clauses that have to hold as well, rare
    ones first. A term is its phrase and the place of its field. Terms without a word can match nothing and are left out, and so are
    clauses that have none left.
    """
    place = F.array_position(F.lit(fields), F.col("field")).cast("int")
    terms = (
        query_terms.select("query_id", "clause", place.alias("place"), text.words(F.col("term")).alias("phrase"))
        .filter((F.trim("phrase") != "") & (F.col("place") > 0)).distinct()
    )
    # Shorter words are taken to be twice as frequent by letter: that orders clauses by how often they may hold.
    frequency = F.pow(F.lit(2.0), -F.least(F.length(_anchor(F.col("phrase"))), F.lit(60)))
    clauses = terms.withColumn("rare", -frequency).groupBy("query_id", "clause").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rare", "place", "phrase"))),
                    lambda t: F.struct(t["place"].alias("place"), t["phrase"].alias("phrase"))).alias("terms"),
        (-F.sum("rare")).alias("frequency"))
    queries = clauses.groupBy("query_id").agg(
        F.array_sort(F.collect_list(F.struct("frequency", "clause", "terms"))).alias("all"))
    trigger = queries.select(
        "query_id", F.transform(F.slice("all", 2, F.size("all")), lambda c: c["terms"]).alias("others"),
        F.posexplode(F.col("all")[0]["terms"]).alias("number", "term"), F.col("all")[0]["terms"].alias("same"))
    return trigger.select(
        "query_id", F.col("term.place").alias("place"), F.col("term.phrase").alias("phrase"),
        _anchor(F.col("term.phrase")).alias("anchor"),
        F.expr("slice(same, 1, number)").alias("earlier"), "others")


def _folded(articles: DataFrame, keys: list[str], fields: dict[str, str]) -> DataFrame:
    """The texts of each article as words, by the place of the field."""
    return articles.select(*keys, F.array(*[F.coalesce(text.words(F.col(c)), F.lit("")) for c in fields.values()]).alias("_texts"))


def _words(folded: DataFrame, keys: list[str], *columns: str) -> DataFrame:
    """The distinct words of each text, with the place of its field."""
    split = F.transform("_texts", lambda t: F.array_distinct(F.split(F.trim(t), " ")))
    return folded.select(*keys, *columns, F.posexplode(split).alias("_at", "_found")).select(
        *keys, *columns, (F.col("_at") + 1).alias("place"), F.explode("_found").alias("anchor"))


def _held(term: Column) -> Column:
    return F.contains(F.get("_texts", term["place"] - 1), term["phrase"])


def _query_holds() -> Column:
    """Whether this is the first term of its clause that the text holds, and whether all other clauses hold.

    So each query is found once in a text: nothing has to be counted afterwards.
    """
    single = F.length("phrase") == F.length("anchor") + 2
    this = single | F.contains(F.get("_texts", F.col("place") - 1), F.col("phrase"))
    others = F.forall("others", lambda clause: F.exists(clause, _held))
    return this & ~F.exists("earlier", _held) & others


def _matches_broadcast(folded: DataFrame, terms: DataFrame, keys: list[str]) -> DataFrame:
    # Explode, join and test run in one pass over a text, which is never copied or moved.
    found = _words(folded, keys, "_texts").join(F.broadcast(terms), ["place", "anchor"])
    return found.filter(_query_holds()).select(*keys, "query_id")


def _matches_shuffled(folded: DataFrame, words: DataFrame, terms: DataFrame, keys: list[str]) -> DataFrame:
    # IDs and words meet the terms; a text moves only if a query is open for it, and then once, to all of them.
    met = salted_join(words.select(keys[0], "place", "anchor"), terms, "anchor", keys[0], also=["place"])
    opened = met.groupBy(keys[0]).agg(F.collect_list(F.struct("query_id", "place", "phrase", "anchor", "earlier", "others")).alias("_open"))
    texts = folded.join(opened.select(keys[0]), keys[0], "left_semi").join(opened, keys[0])
    return texts.select(*keys, "_texts", F.inline("_open")).filter(_query_holds()).select(*keys, "query_id")


def build_index(articles: DataFrame, id_col: str, fields: dict[str, str], path: str, buckets: int = settings.INDEX_BUCKETS) -> None:
    """Write the words of a corpus with the IDs of the texts that hold them, split by the hash of the word.

    For standing queries that come again: :func:`matches` with ``index`` reads the buckets of its terms instead of the
    words of all texts.
    """
    words = _words(_folded(articles, [id_col], fields), [id_col]).filter(F.col("anchor") != "")
    by_word = words.withColumn("bucket", _word_bucket(F.col("anchor"), buckets))
    by_word.hint("rebalance", "bucket").sortWithinPartitions("bucket", "anchor").write.partitionBy("bucket").parquet(path)
    create_once(articles.sparkSession, f"{path}/_buckets", str(buckets))


def _word_bucket(word: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(buckets)).cast("int")


def _indexed_words(spark: SparkSession, index: str, terms: DataFrame) -> DataFrame:
    """The rows of an index in the buckets that the terms need; their list is as long as there are buckets at most."""
    buckets = int(read_small(spark, f"{index}/_buckets"))
    needed = [r[0] for r in terms.select(_word_bucket(F.col("anchor"), buckets)).distinct().collect()]
    return spark.read.parquet(index).filter(F.col("bucket").isin(needed)).drop("bucket")


def matches(
    articles: DataFrame,
    query_terms: DataFrame,
    id_col: str,
    fields: dict[str, str],
    carry: tuple[str, ...] = (),
    broadcast_rows: int = 100_000,
    index: str | None = None,
) -> DataFrame:
    """Pairs of article id and query id where all clauses of the query hold.

    ``fields`` names the text column that stands for each field of the terms, ``carry`` more columns of the article to
    keep. An article is one row. The terms are broadcast if they are measured to be few: then no row moves at all.
    Otherwise, or with an ``index`` of the corpus, IDs and words meet them first, and of the texts only those that a
    query is open for are looked at.
    """
    keys = [id_col, *carry]
    terms = prepare_terms(query_terms, list(fields))
    folded = _folded(articles, keys, fields)
    if index:
        return _matches_shuffled(folded, _indexed_words(articles.sparkSession, index, terms), terms, keys)
    if measure(terms, broadcast_rows)[0]:
        return _matches_broadcast(folded, terms, keys)
    return _matches_shuffled(folded, _words(folded, keys), terms, keys)


def newest(
    found: DataFrame, id_col: str, day: str, count: int = settings.ARTICLES_PER_QUERY
) -> DataFrame:
    """The newest articles of each query, at most ``count`` of them."""
    return first_per_key(found, ["query_id"], [F.col(day).desc(), F.col(id_col)], count)


def search_planned(
    articles: DataFrame,
    query_terms: DataFrame,
    plan: DataFrame,
    id_col: str,
    day: str,
    fields: dict[str, str],
    count: int | None = settings.ARTICLES_PER_QUERY,
) -> DataFrame:
    """Run the planned queries: match, keep what lies in their dates, take the newest.

    Incremental queries only scan from the oldest to the newest of their dates; queries that
    are new scan everything, apart from them.
    """
    active = plan.filter(F.col("mode") != "SKIP").select("query_id", "mode", "since", "until")
    oldest, newest_day, full = active.agg(
        F.min("since"), F.max("until"), F.count_if(F.col("mode") == "FULL")
    ).first()

    def searched(rows: DataFrame, wanted: Column) -> DataFrame:
        terms = query_terms.join(active.filter(wanted).select("query_id"), "query_id", "left_semi")
        return matches(rows, terms, id_col, fields, carry=(day,))

    pairs = searched(articles, F.col("mode") == "FULL") if full or oldest is None else None
    if oldest is not None:
        recent = articles.filter(F.col(day).between(F.lit(oldest), F.lit(newest_day)))
        new = searched(recent, F.col("mode") == "INCREMENTAL")
        pairs = new if pairs is None else pairs.unionByName(new)
    ranged = attach(pairs, active, "query_id", id_col).filter(
        (F.col("mode") == "FULL") | F.col(day).between(F.col("since"), F.col("until"))
    )
    chosen = ranged.select("query_id", id_col, day)
    return newest(chosen, id_col, day, count) if count else chosen
