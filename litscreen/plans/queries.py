"""The contract queries: each operator over the whole of the given tables."""

from __future__ import annotations

import datetime
from functools import reduce
from operator import and_

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litscreen import schemas, settings
from litscreen.functions import markup, scores, text
from litscreen.operators import (
    dedup, encode, ensemble, evaluate, extract, heads, incremental, joins, order, search,
)
from litscreen.plans import jobs
from litscreen.session import shared_folder, spread
from litscreen.sinks import tables as sinks
from litscreen.sources import files, tables
from litscreen.streaming import ingest

STATE_UNTIL = datetime.date(2024, 1, 20)
CURRENT = datetime.date(2024, 1, 30)
VOCABULARY = 500

# Standing queries in the shape of real ones: clauses joined by AND, each a list of words
# and phrases joined by OR.
STANDING_QUERIES = {
    "q1": [["thand", "estion", "onthe of", "ithe"], ["eren", "tion the", "reed"]],
    "q2": [["éles", "que de", "l'eau", "la des"], ["mentre", "eaux", "queque"]],
    "q3": [["Ción", "de la", "y que"], ["Rrco", "ías", "boras"], ["el", "los"]],
    "q4": [["über", "für sch", "und die"], ["ung", "chein", "lich"]],
    "q5": [["the of and", "of the and", "and the of"]],
}

_read = tables.read_table


# ---------------------------------------------------------------- scoring and evaluation

def rule_heads(spark: SparkSession, width: int = 64) -> DataFrame:
    """Four members with two heads each, whose weights follow a rule."""
    member, head = F.expr("cast(id % 4 as int)"), F.expr("cast(id div 4 as int)")
    weights = F.transform(
        F.sequence(F.lit(0), F.lit(width - 1)),
        lambda i: ((i * (2 * F.col("member") + 3) + 5 * F.col("head") + F.col("member")) % 17 - 8) / 32.0,
    )
    return (
        spark.range(8).select(member.alias("member"), head.alias("head"))
        .select(
            "member",
            F.when(F.col("head") == 0, settings.SCORE_COLUMNS[0]).otherwise(settings.SCORE_COLUMNS[1]).alias("target"),
            F.lit(0.6).alias("bias"),
            weights.alias("weights"),
        )
    )


def _predictions(spark, d):
    vectors = _read(spark, d, "embeddings").select(F.col("vec_id").alias("ID"), "embedding")
    return heads.score(vectors, rule_heads(spark), "embedding", digits=6).drop("embedding")


def score_all(spark, d):
    return _predictions(spark, d)


def score_filter(spark, d):
    return heads.keep_relevant(_predictions(spark, d))


def _evaluated(spark, d):
    vectors = _read(spark, d, "embeddings").select(
        F.col("vec_id").alias("ID"), "embedding", (F.col("label") / 9.0).alias("truth")
    )
    outputs = heads.member_outputs(vectors, rule_heads(spark), "embedding")
    return ensemble.averaged(outputs, settings.EVALUATED_COLUMNS, "sigmoid")


def ensemble_eval(spark, d):
    first, second = settings.EVALUATED_COLUMNS
    return _evaluated(spark, d).select(
        "ID", F.round(first, 6).alias(first), F.round(second, 6).alias(second),
        F.round("truth", 6).alias("truth"),
    )


def ensemble_mse(spark, d):
    first, second = settings.EVALUATED_COLUMNS
    measured = evaluate.mse(_evaluated(spark, d), {"mse_AwT": (first, "truth"), "mse_SoE": (second, "truth")})
    return measured.select(*[F.round(c, 9).alias(c) for c in measured.columns])


def ensemble_long(spark, d):
    """Outputs as rows of ID, member, target and value, averaged by aggregation."""
    vectors = _read(spark, d, "embeddings").select(F.col("vec_id").alias("ID"), "embedding")
    outputs = heads.member_outputs(vectors, rule_heads(spark), "embedding")
    long = outputs.select("ID", F.explode(F.create_map(*[
        part for t in settings.SCORE_COLUMNS for part in (F.lit(t), F.col(f"{t}_members"))
    ])).alias("target", "members")).select("ID", "target", F.posexplode("members").alias("member", "value"))
    means = heads.mean_by_row(long, "ID", settings.SCORE_COLUMNS)
    return means.select("ID", *[F.round(t, 6).alias(t) for t in settings.SCORE_COLUMNS])


def batch_predict(spark, d):
    """Members written in Python score Arrow batches; their outputs are averaged and clipped."""
    def members():
        import numpy as np

        def member(m):
            i = np.arange(64)
            weights = np.stack([((i * (2 * m + 3) + 5 * h + m) % 17 - 8) / 32.0 for h in range(2)], axis=1)
            return lambda vectors: vectors.astype("float64") @ weights + 0.6

        return [member(m) for m in range(4)]

    vectors = _read(spark, d, "embeddings").select(F.col("vec_id").alias("ID"), "embedding")
    outputs = vectors.select("ID", ensemble.predict_batches("embedding", members, 64).alias("outputs"))
    pick = [F.transform(F.sequence(F.lit(h), F.lit(6 + h), F.lit(2)), lambda i: F.get("outputs", i)) for h in range(2)]
    return outputs.select("ID", *[
        F.round(scores.clip(heads.ensemble_mean(p)), 6).alias(name)
        for p, name in zip(pick, settings.PREDICTED_COLUMNS)
    ])


# ---------------------------------------------------------------- names, dates, texts

def query_key(spark, d):
    query = F.col("text")
    return _read(spark, d, "benchmark").select(
        "item_id", text.folder_name(query).alias("folder_name"),
        text.short_hash(query).alias("short_hash"), text.query_key(query).alias("query_key"),
    )


def query_long_name(spark, d):
    return _read(spark, d, "benchmark").select("item_id", text.long_folder_name(F.col("text")).alias("long_name"))


def date_reformat(spark, d):
    day = F.date_format("ts", "yyyy-MM-dd")
    return _read(spark, d, "events").select("event_id", text.reformat_date(day).alias("day"))


def normalise_lines(spark, d):
    """Each ninth text is turned into blanks and has to go."""
    blanks = F.when(F.col("doc_id") % 9 == 0, F.regexp_replace("text", r"\S", " ")).otherwise(F.col("text"))
    line = text.one_line(blanks)
    return extract.keep_present(_articles(spark, d), line, "Abstract", empty=False).drop("text")


# ---------------------------------------------------------------- elements of pages

def _pages(spark, d):
    return spread(_read(spark, d, "pages").select("page_id", F.col("html").alias("page")))


def extract_body(spark, d):
    return extract.with_element(_pages(spark, d), "body", "body_html").drop("page")


def _pages_some_without(spark, d):
    """Each third page holds its text in another element."""
    other = F.regexp_replace("page", "<(/?)article>", "<$1section>")
    return _pages(spark, d).withColumn("page", F.when(F.col("page_id") % 3 == 0, other).otherwise(F.col("page")))


def extract_paragraphs(spark, d):
    found = extract.with_element(_pages_some_without(spark, d), "article")
    plain = text.without_quotes(markup.paragraph_text(F.col("element")))
    return found.select("page_id", plain.alias("abstract_text"))


def missing_element(spark, d):
    return extract.without_element(_pages_some_without(spark, d), "article").drop("page")


_ADDRESS = r"//[^/]+/([a-z]+)/([0-9]+)"


def _raw_articles(spark, d):
    """The pages as landed articles: folder and id are parts of the address."""
    return spread(_read(spark, d, "pages")).select(
        F.regexp_extract("url", _ADDRESS, 1).alias("query_folder"),
        F.regexp_extract("url", _ADDRESS, 2).alias("id"),
        F.encode("html", "UTF-8").alias("content"),
        F.timestamp_seconds("page_id").alias("fetched_at"),
    )


def landing_upsert(spark, d):
    """Land the pages twice, the second time half an hour later, in a table by folder."""
    target = shared_folder(spark, "landing")
    articles = _raw_articles(spark, d)
    sinks.upsert_articles(articles, target)
    later = articles.withColumn("fetched_at", F.col("fetched_at") + F.expr("INTERVAL 30 MINUTES"))
    sinks.upsert_articles(later, target)
    landed = spark.read.schema(schemas.ARTICLES_RAW).parquet(target)
    return landed.select(
        "query_folder", "id", F.unix_seconds("fetched_at").alias("fetched_at"),
        F.md5("content").alias("content_md5"),
    )


def abstract_dataset(spark, d):
    """Extract, clean, deduplicate and append: the job, with ``article`` as the element."""
    target = shared_folder(spark, "abstracts")
    jobs.build_abstract_dataset(_raw_articles(spark, d), target, element="article")
    return spark.read.parquet(target).select("ID", "Abstract")


def _two_batches(spark, d):
    """The same articles as they come in two batches, with both in the same folders."""
    articles = _raw_articles(spark, d)
    later = F.unix_seconds("fetched_at") % 2 == 0
    return articles.filter(~later), articles.filter(later)


def abstract_table(spark, d):
    """Text and markup of each element as a table by query folder."""
    target = shared_folder(spark, "abstract-table")
    for batch in _two_batches(spark, d):
        jobs.extract_abstracts(batch, target, "article")
    return tables.read_abstracts_table(spark, target).drop("fetched_at")


def _landed_records(spark, d):
    """The newest page of each address as a record of one line, in files sized by bytes."""
    target = shared_folder(spark, "records")
    latest = dedup.latest_per_key(_raw_articles(spark, d), ["query_folder", "id"], [F.col("fetched_at").desc()])
    line = F.concat(F.regexp_replace(F.col("content").cast("string"), r"\n", " "), F.lit("\n"))
    sinks.land_records(latest.withColumn("content", line.cast("binary")), target)
    return target


def landed_files(spark, d):
    """Articles that lie as records in files, read as bytes, landed as texts and read again."""
    articles = files.read_records(spark, _landed_records(spark, d))
    target = shared_folder(spark, "texts")
    sinks.land_records(files.decode(articles).withColumnRenamed("page", "abstract_text"), target)
    texts = files.read_records(spark, target, schemas.EXTRACTED).select("query_folder", "id", F.md5("abstract_text").alias("text_md5"))
    return articles.select("query_folder", "id", F.md5("content").alias("content_md5")).join(texts, ["query_folder", "id"])


def decode_rejects(spark, d):
    """Texts that arrive in another encoding: those with accented letters are no UTF-8."""
    articles = _articles(spark, d).select("doc_id", F.encode("text", "ISO-8859-1").alias("content"))
    return files.rejects(files.decode(articles))


def body_table(spark, d):
    """The bodies as a table by query folder."""
    target = shared_folder(spark, "bodies")
    for batch in _two_batches(spark, d):
        jobs.extract_bodies(batch, target)
    return tables.read_bodies(spark, target).drop("fetched_at")


def csv_round_trip(spark, d):
    """Export as CSV and read it back: quotes and line breaks survive."""
    target = shared_folder(spark, "csv")
    rows = _read(spark, d, "documents").select(F.col("text").alias("Abstract"), F.col("doc_id").cast("string").alias("ID"))
    sinks.export_csv(rows, target)
    return files.read_abstracts_csv(spark, target)


def query_list(spark, d):
    """The lines of the passages as a list of queries, one per line of a text file."""
    target = shared_folder(spark, "query-list")
    _read(spark, d, "benchmark").select("text").write.text(target)
    return files.read_queries(spark, target)


def union_batches(spark, d):
    """Two sources appended as one data set, without looking at their IDs."""
    documents = _read(spark, d, "documents").select(F.col("text").alias("Abstract"), F.col("doc_id").cast("string").alias("ID"))
    turns = _read(spark, d, "conversations").select(
        F.concat_ws("-", "conv_id", "turn").alias("ID"), F.col("text").alias("Abstract")
    )
    return documents.unionByName(turns)


# ---------------------------------------------------------------- one row per key

def _old_and_new(spark, d):
    """The labelled documents as the table so far, all documents as the new batch."""
    documents = _read(spark, d, "documents").select("doc_id", "source", F.md5("text").alias("text_md5"))
    old = documents.join(_read(spark, d, "labels").select("doc_id"), "doc_id", "left_semi")
    return old, documents


def dedup_first(spark, d):
    old, new = _old_and_new(spark, d)
    old = dedup.first_per_key(old, ["text_md5"], [F.col("doc_id")])
    return dedup.union_first(old, new, "text_md5", [F.col("doc_id")])


def append_new(spark, d):
    """Only the rows that the append adds."""
    old, new = _old_and_new(spark, d)
    return dedup.unseen(old, new, "text_md5", [F.col("doc_id")])


def upsert_latest(spark, d):
    events = _read(spark, d, "events").select("user_id", "event_type", "event_id", "ts", "value")
    newest = [F.col("ts").desc(), F.col("event_id").desc()]
    return dedup.latest_per_key(events, ["user_id", "event_type"], newest).drop("ts")


# ---------------------------------------------------------------- search and run planning

def _standing_terms(spark):
    rows = [
        (name, clause, term, "Abstract")
        for name, clauses in STANDING_QUERIES.items()
        for clause, terms in enumerate(clauses)
        for term in terms
    ]
    return spark.createDataFrame(rows, schemas.QUERY_TERMS)


def _articles(spark, d):
    return spread(_read(spark, d, "documents").select("doc_id", "text"))


def _dated(spark, d, pairs):
    """Each document arrives with the event of the same number."""
    days = _read(spark, d, "events").select(F.col("event_id").alias("doc_id"), F.to_date("ts").alias("pub_date"))
    return pairs.join(days, "doc_id")


def boolean_search_top50(spark, d):
    pairs = search.matches(_articles(spark, d), _standing_terms(spark), "doc_id", {"Abstract": "text"})
    top = search.newest(_dated(spark, d, pairs), "doc_id", "pub_date")
    return top.select("query_id", "doc_id", F.date_format("pub_date", "yyyy-MM-dd").alias("pub_date"))


def _sentence_terms(spark, d):
    """Each passage as a query: its sentences are the clauses, their words the terms."""
    sentences = _read(spark, d, "benchmark").select(
        F.col("item_id").cast("string").alias("query_id"),
        F.posexplode(F.split("text", r"\.")).alias("clause", "sentence"),
    )
    word = F.explode(F.split(F.trim(text.words(F.col("sentence"))), " ")).alias("term")
    return sentences.select("query_id", "clause", word, F.lit("Abstract").alias("field"))


def search_many(spark, d):
    return search.matches(_articles(spark, d), _sentence_terms(spark, d), "doc_id", {"Abstract": "text"})


def phrase_search(spark, d):
    """Each passage as one phrase: the documents that hold it as a whole."""
    terms = _read(spark, d, "benchmark").select(
        F.col("item_id").cast("string").alias("query_id"), F.lit(0).alias("clause"),
        F.col("text").alias("term"), F.lit("Abstract").alias("field"),
    )
    return search.matches(_articles(spark, d), terms, "doc_id", {"Abstract": "text"})


def newest_articles(spark, d):
    """The 50 newest of all."""
    dated = _dated(spark, d, _read(spark, d, "documents").select("doc_id", "source"))
    top = dated.orderBy(F.col("pub_date").desc(), "doc_id").limit(settings.ARTICLES_PER_QUERY)
    return top.select("doc_id", "source", F.date_format("pub_date", "yyyy-MM-dd").alias("pub_date"))


def date_range(spark, d):
    """Whole days from the first to the last one, both inside; bounds of time are pushed down to the scan."""
    since, after = (F.lit(day).cast("timestamp_ntz") for day in (STATE_UNTIL, CURRENT + datetime.timedelta(days=1)))
    near = _read(spark, d, "events").filter((F.col("ts") >= since) & (F.col("ts") < after))
    inside = incremental.in_range(F.to_date("ts"), F.lit(STATE_UNTIL), F.lit(CURRENT))
    return near.filter(inside).select("event_id", "user_id")


def run_gate(spark, d):
    """Each user comes back some days after the last event, some for the first time, some without state."""
    last = _read(spark, d, "events").groupBy("user_id").agg(F.to_date(F.max("ts")).alias("day"))
    user = F.col("user_id")
    known = F.when(user % 5 != 0, F.col("day"))
    today = F.date_add("day", (user % 12).cast("int"))
    gate = F.when(user % 11 == 0, incremental.run_gate(known, today, first_run=True)).otherwise(incremental.run_gate(known, today))
    return last.select("user_id", gate.alias("gate"))


def _state_before(spark, d, key):
    """The last day of each user before the state was taken; each seventh user has none."""
    seen = _read(spark, d, "events").filter((F.col("ts") < F.lit(STATE_UNTIL)) & (F.col("user_id") % 7 != 3))
    return seen.groupBy(F.col("user_id").alias(key)).agg(F.to_date(F.max("ts")).alias("last_fetch"))


def query_plan(spark, d):
    """Each passage as a standing query; its state is that of the user of the same number."""
    state = _state_before(spark, d, "query_id")
    queries = _read(spark, d, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query_text"))
    planned = incremental.plan_queries(queries, state, CURRENT)
    return planned.select("query_id", "mode", "search_text")


def incremental_select(spark, d):
    events = _read(spark, d, "events").select("event_id", "user_id", F.to_date("ts").alias("day"))
    # The state is a stored table: written by the last run, read by this one.
    path = shared_folder(spark, "state")
    sinks.commit_run_state(_state_before(spark, d, "query_id").withColumn("query_id", F.col("query_id").cast("string")), path)
    state = tables.read_run_state(spark, path).select(F.col("query_id").cast("long").alias("user_id"), "last_fetch")
    chosen = incremental.select_new(events, state, CURRENT, "user_id", "day", "event_id")
    return chosen.select("event_id", "user_id", F.date_format("day", "yyyy-MM-dd").alias("day"), "mode")


def run_state_advance(spark, d):
    state = _state_before(spark, d, "query_id")
    queries = _read(spark, d, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query_text"))
    planned = incremental.plan_queries(queries, state, CURRENT)
    after = incremental.advance(state, planned, CURRENT)
    return after.select("query_id", F.date_format("last_fetch", "yyyy-MM-dd").alias("last_fetch"))


def _selection(spark, d, state, **options):
    """Run the selection job over the documents; gives the landed articles."""
    documents = _dated(spark, d, _articles(spark, d)).select(
        F.col("doc_id").cast("string").alias("id"), F.col("text").alias("abstract"),
        F.col("text").alias("content"), "pub_date",
    )
    queries = spark.createDataFrame(
        [(name, str(clauses), name) for name, clauses in STANDING_QUERIES.items()], schemas.QUERIES
    )
    landing = shared_folder(spark, "landing")
    jobs.select_articles(spark, documents, queries, _standing_terms(spark), landing, state, CURRENT, **options)
    landed = spark.read.schema(schemas.ARTICLES_RAW).parquet(landing)
    return landed.select("query_folder", "id", F.md5("content").alias("content_md5"))


def select_articles(spark, d):
    """The whole selection job: plan, search, newest 50, landing and run state."""
    return _selection(spark, d, shared_folder(spark, "state"), first_run=True)


# What a run finds: two queries seen some days ago, one today, one by a clock that was ahead; q3 is new.
SEEN = {"q1": datetime.date(2024, 1, 20), "q2": datetime.date(2024, 1, 10), "q4": CURRENT, "q5": datetime.date(2024, 2, 10)}


def select_incremental(spark, d):
    """The selection job with a stored state: full, incremental and skipped queries; what it lands, and the state after it."""
    state = shared_folder(spark, "state")
    sinks.commit_run_state(spark.createDataFrame(list(SEEN.items()), schemas.RUN_STATE), state)
    landed = _selection(spark, d, state).select(F.lit("landed").alias("kind"), "query_folder", "id", F.col("content_md5").alias("value"))
    after = tables.read_run_state(spark, state).select(
        F.lit("state").alias("kind"), F.col("query_id").alias("query_folder"), F.lit("").alias("id"),
        F.date_format("last_fetch", "yyyy-MM-dd").alias("value"))
    return landed.unionByName(after)


# ---------------------------------------------------------------- training data

def _labels(spark, d):
    return _read(spark, d, "labels").select(
        "doc_id", F.col("quality").cast("double").alias("AwT_score"), F.col("toxic").cast("double").alias("SoE_score")
    )


def noise_scores(spark, d):
    noised = evaluate.add_noise(_labels(spark, d), "doc_id")
    return noised.select(
        "doc_id", *settings.SCORE_COLUMNS,
        *[F.round(c, 9).alias(c) for c in settings.RANDOMIZED_COLUMNS],
    )


def split_test(spark, d):
    return order.split(_read(spark, d, "labels"), "doc_id")[1].select("doc_id")


def split_train(spark, d):
    return order.split(_read(spark, d, "labels"), "doc_id")[0].select("doc_id")


def rest_after_split(spark, d):
    labels = _read(spark, d, "labels").select("doc_id", "quality")
    return joins.rest_of(labels, order.split(labels, "doc_id")[1], "doc_id")


def training_order(spark, d):
    return order.number_rows(_read(spark, d, "labels").select("doc_id"), "doc_id", settings.SPLIT_SEED)


def bootstrap_weights(spark, d):
    return ensemble.with_bootstrap(_read(spark, d, "labels").select("doc_id"), "doc_id")


def _compared(spark, d):
    """Noised labels with predictions that follow a rule, joined by ID."""
    truth = evaluate.add_noise(_labels(spark, d), "doc_id").select("doc_id", *settings.RANDOMIZED_COLUMNS)
    predicted = _read(spark, d, "documents").select(
        "doc_id",
        F.round((F.col("n_chars") % 101) / 100.0, 4).alias(settings.EVALUATED_COLUMNS[0]),
        F.round((F.col("n_chars") % 37) / 36.0, 4).alias(settings.EVALUATED_COLUMNS[1]),
    )
    return evaluate.join_by_key(predicted, truth, "doc_id")


def compare_table(spark, d):
    compared = _compared(spark, d)
    return compared.select("doc_id", *[F.round(c, 6).alias(c) for c in compared.columns if c != "doc_id"])


_PAIRS = list(zip(settings.EVALUATED_COLUMNS, settings.RANDOMIZED_COLUMNS))


def mse_by_target(spark, d):
    measured = evaluate.mse(_compared(spark, d), dict(zip(("mse_AwT", "mse_SoE"), _PAIRS)))
    return measured.select(*[F.round(c, 9).alias(c) for c in measured.columns])


def batch_loss(spark, d):
    dealt = order.batches(_compared(spark, d), "doc_id")
    loss = evaluate.epoch_loss(evaluate.batch_losses(dealt, "batch", _PAIRS))
    return loss.select(F.round("loss", 9).alias("loss"), "batches")


def missing_counts(spark, d):
    labels = _read(spark, d, "labels")
    return evaluate.missing_counts(_read(spark, d, "documents").join(labels, "doc_id", "left"))


def train_join(spark, d):
    labels = _read(spark, d, "labels")
    joined = evaluate.join_by_key(_read(spark, d, "documents").select("doc_id", "text"), labels, "doc_id")
    return joined.select(
        "doc_id", "text", F.col("quality").cast("double").alias("AwT_score"),
        F.col("toxic").cast("double").alias("SoE_score"),
    )


def articles_per_query(spark, d):
    return evaluate.counts_by(_read(spark, d, "documents"), "source")


# ---------------------------------------------------------------- tokens

def vocab_topk(spark, d):
    vocab = encode.vocabulary(_articles(spark, d), "text", VOCABULARY, prune=True)
    return vocab.select("term", "n", F.col("token_id").cast("long").alias("token_id"))


def _encoded(spark, d):
    articles = _articles(spark, d)
    return encode.encode(articles, encode.vocabulary(articles, "text", VOCABULARY), "doc_id", "text", terms=VOCABULARY)


def encode_tokens(spark, d):
    return _encoded(spark, d).select("doc_id", F.array_join("input_ids", " ").alias("input_ids"))


def encode_padded(spark, d):
    padded = encode.pad(_encoded(spark, d), encode.longest_row(_articles(spark, d), "text"))
    return padded.select(
        "doc_id", F.array_join("input_ids", " ").alias("input_ids"),
        F.array_join("attention_mask", "").alias("attention_mask"),
    )


# ---------------------------------------------------------------- ensembles on texts

def _training_set(spark, d):
    joined = evaluate.join_by_key(_articles(spark, d), _labels(spark, d), "doc_id")
    return joined.select("text", *settings.SCORE_COLUMNS, F.col("doc_id").alias("ID"))


def text_embedding(spark, d):
    """The weighted counts of each text over the vocabulary, as rows of what is not zero."""
    articles = _articles(spark, d)
    vocab = encode.vocabulary(articles, "text", VOCABULARY)
    vectors = ensemble.vocabulary_features(articles, vocab, "text").transform(articles)
    entries = vectors.select("doc_id", F.posexplode(ensemble.as_embedding("features", "float64")).alias("place", "weight"))
    return entries.filter("weight > 0").select("doc_id", "place", F.round("weight", 6).alias("weight"))


def linear_fit(spark, d):
    """A fit of one feature without regularisation: the labels on the length of the texts."""
    rows = _read(spark, d, "documents").join(_read(spark, d, "labels"), "doc_id")
    slope, intercept = ensemble.line(rows.select(F.col("n_chars").alias("x"), F.col("quality").alias("y")), "x", "y")
    return spark.range(1).select(F.round(F.lit(slope * 1e6), 6).alias("slope_per_million"), F.round(F.lit(intercept), 6).alias("intercept"))


def training_epochs(spark, d):
    """Mini-batch training of one feature, the labels on the length of the texts: loss and model of each epoch."""
    rows = _read(spark, d, "documents").join(_read(spark, d, "labels"), "doc_id")
    assembled = VectorAssembler(inputCols=["x"], outputCol="v").transform(
        rows.select("doc_id", (F.col("n_chars") / 10000.0).alias("x"), F.col("quality").cast("double").alias("y")))
    models = sinks.write_version(ensemble.train_epochs(assembled, "v", "y", "doc_id"), shared_folder(spark, "epochs"))
    return spark.read.schema(schemas.EPOCHS).parquet(models).select(
        "epoch", F.round("loss", 9).alias("loss"), F.round("bias", 9).alias("bias"), F.round(F.get("weights", F.lit(0)), 9).alias("weight"))


def ml_ensemble(spark, d):
    """Train on the labelled documents, save, and compare on the test part.

    The learned scores have no counterpart in SQL: what is returned of them is whether they
    are in range and the mean of the sigmoids of the members.
    """
    path = shared_folder(spark, "model")
    _, compared, _ = jobs.train_ensemble(_training_set(spark, d), path)
    sigmoids = [F.aggregate(f"{t}_members", F.lit(0.0), lambda s, y: s + scores.sigmoid(y)) for t in settings.SCORE_COLUMNS]
    averaged = reduce(and_, [F.abs(s / settings.ENSEMBLE_SIZE - F.col(c)) < 1e-9 for s, c in zip(sigmoids, settings.EVALUATED_COLUMNS)])
    inside = reduce(and_, [F.col(c).between(0.0, 1.0) for c in settings.EVALUATED_COLUMNS])
    return compared.select(
        "ID", *[F.round(c, 9).alias(c) for c in settings.RANDOMIZED_COLUMNS], inside.alias("in_range"), averaged.alias("averaged"))


def ml_score(spark, d):
    """Train on the labelled documents, then score all documents and filter them.

    Of the learned scores only what SQL can state is returned: that they are in range, and
    that the filtered table holds just those that reach the thresholds.
    """
    path = shared_folder(spark, "model")
    jobs.train_ensemble(_training_set(spark, d), path)
    dataset = _articles(spark, d).select(F.col("text").alias("Abstract"), F.col("doc_id").cast("string").alias("ID"))
    predictions, filtered = shared_folder(spark, "predictions"), shared_folder(spark, "filtered")
    jobs.score_articles(spark, dataset, path, predictions, filtered)
    kept = tables.read_version(spark, filtered, schemas.FILTERED).select("ID", F.lit(True).alias("kept"))
    scored = tables.read_version(spark, predictions, schemas.PREDICTIONS).join(kept, "ID", "left")
    reached = scores.meets(dict(zip(settings.PREDICTED_COLUMNS, settings.KEEP_THRESHOLDS)))
    inside = reduce(and_, [F.col(c).between(0.0, 1.0) for c in settings.PREDICTED_COLUMNS])
    return scored.select(
        "ID", F.md5("Abstract").alias("abstract_md5"), inside.alias("in_range"),
        (F.coalesce("kept", F.lit(False)) == reached).alias("filtered"))


# ---------------------------------------------------------------- streams

def stream_ingest(spark, d):
    """The pages land as records in files and are taken in as a stream of articles: extract, clean, append."""
    target, checkpoint = shared_folder(spark, "stream"), shared_folder(spark, "stream-state")
    arriving = ingest.record_stream(spark, _landed_records(spark, d), files_per_batch=64)
    ingest.abstract_stream(arriving, target, checkpoint, element="article").awaitTermination()
    return spark.read.parquet(target).select("ID", "Abstract")


def stream_dedup(spark, d):
    """Each user and event type once, kept in the state of a stream."""
    source = (
        spark.readStream.schema(_read(spark, d, "events").schema)
        .option("pathGlobFilter", "events.parquet").parquet(d)
        .select(F.concat_ws(":", "user_id", "event_type").alias("ID"))
    )
    target, checkpoint = shared_folder(spark, "stream"), shared_folder(spark, "stream-state")
    (
        ingest.drop_seen(source, "ID").writeStream.format("parquet")
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(target)
        .awaitTermination()
    )
    return spark.read.parquet(target)


ALL = [
    score_filter, score_all, ensemble_eval, ensemble_mse, ensemble_long, batch_predict,
    query_key, query_long_name, date_reformat, normalise_lines,
    extract_body, extract_paragraphs, missing_element, landing_upsert, abstract_dataset,
    abstract_table, landed_files, decode_rejects, body_table, csv_round_trip, query_list, union_batches, dedup_first, append_new, upsert_latest,
    boolean_search_top50, search_many, phrase_search, newest_articles, date_range,
    run_gate, query_plan,
    incremental_select, run_state_advance, select_articles, select_incremental, noise_scores, split_test,
    split_train, rest_after_split, training_order, bootstrap_weights, compare_table,
    mse_by_target, batch_loss, missing_counts, train_join, articles_per_query,
    vocab_topk, encode_tokens, encode_padded, text_embedding, linear_fit, training_epochs, ml_ensemble, ml_score,
    stream_ingest, stream_dedup,
]
