"""The five jobs. Each ends in one write per output and may be run again."""

from __future__ import annotations

import datetime

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litscreen import schemas, session, settings
from litscreen.operators import ensemble, evaluate, extract, heads, incremental, order, search
from litscreen.sinks import tables as sinks
from litscreen.sources import files, tables


def select_articles(
    spark: SparkSession,
    corpus: DataFrame,
    queries: DataFrame,
    query_terms: DataFrame,
    landing: str,
    state_path: str,
    current: datetime.date,
    first_run: bool = False,
    interval: int = settings.RUN_INTERVAL_DAYS,
    fields: dict[str, str] | None = None,
) -> str:
    """Run the standing queries over a corpus and land what is new. Returns the gate.

    The corpus has ``id``, ``content``, ``pub_date`` and the columns named by ``fields``.
    """
    state = tables.read_run_state(spark, state_path)
    last_run = state.agg(F.max("last_fetch").alias("last")).first()["last"]
    decision = spark.range(1).select(
        incremental.run_gate(F.lit(last_run).cast("date"), F.lit(current), first_run, interval)
    ).first()[0]
    if decision == "ERROR_NO_STATE":
        raise ValueError("no run state found and not a first run")
    if decision not in ("FULL", "RUN"):
        return decision
    plan = incremental.plan_queries(queries, state, current, first_run)
    found = search.search_planned(
        corpus, query_terms, plan, "id", "pub_date", fields or {"Abstract": "abstract"}
    )
    with session.Staging() as staging:
        chosen = staging.materialise(found, "chosen")
        # A fixed number of narrow rows per query: Spark broadcasts them if they really are few,
        # and the contents, the large side, then stay where they are.
        named = chosen.join(plan.select("query_id", F.col("folder").alias("query_folder")), "query_id")
        first, last, undated = chosen.agg(
            F.min("pub_date"), F.max("pub_date"), F.count_if(F.col("pub_date").isNull())
        ).first()
        dated = F.col("pub_date").between(F.lit(first), F.lit(last))
        contents = corpus.filter(dated | F.col("pub_date").isNull() if undated else dated)
        landed = contents.select("id", "content").join(named.select("id", "query_folder"), "id")
        fetched_at = datetime.datetime.combine(current, datetime.time())
        stamped = landed.select(
            "query_folder",
            F.col("id").cast("string").alias("id"),
            F.col("content").cast("binary").alias("content"),
            F.lit(fetched_at).cast("timestamp").alias("fetched_at"),
        )
        sinks.upsert_articles(stamped, landing)
    sinks.update_run_state(spark, state_path, lambda now: incremental.advance(now, plan, current))
    return decision


def _report_missing(decoded: DataFrame, element: str, missing: str | None) -> None:
    """Write which readable articles lack the element."""
    if missing:
        lacking = extract.without_element(decoded, element).select("query_folder", "id")
        lacking.write.mode("overwrite").parquet(missing)


def extract_abstracts(
    articles: DataFrame, target: str, element: str = "abstract", missing: str | None = None
) -> None:
    """Add text and markup of the abstract of each article to a table by query folder."""
    decoded = files.decode(articles)
    sinks.upsert_by_folder(extract.abstracts(decoded, element), target, schemas.ABSTRACTS)
    _report_missing(decoded, element, missing)


def append_abstracts(extracted: DataFrame, dataset: str) -> None:
    """Clean extracted abstracts, from articles, a table or text files, and add the new IDs."""
    order_in_batch = [F.col("query_folder"), F.col("fetched_at")]
    sinks.append_unseen(extract.dataset_rows(extracted), dataset, "ID", order_in_batch)


def build_abstract_dataset(
    articles: DataFrame,
    dataset: str,
    rejected: str | None = None,
    element: str = "abstract",
    missing: str | None = None,
) -> None:
    """Extract and clean the abstracts of raw articles and add the new IDs to the data set."""
    decoded = files.decode(articles)
    append_abstracts(extract.abstracts(decoded, element), dataset)
    if rejected:
        files.rejects(decoded).write.mode("overwrite").parquet(rejected)
    _report_missing(decoded, element, missing)


def extract_bodies(
    articles: DataFrame, target: str, strict: bool = False, missing: str | None = None
) -> None:
    """Add the body of each article to a table by query folder."""
    decoded = files.decode(articles, strict)
    sinks.upsert_by_folder(extract.bodies(decoded), target, schemas.BODIES)
    _report_missing(decoded, "body", missing)


def training_losses(model: PipelineModel, fitting: DataFrame, seed: int = settings.SPLIT_SEED) -> DataFrame:
    """The loss of each shuffled batch of the training part; ``evaluate.epoch_loss`` sums it up."""
    names = [f"_fitted_{target}" for target in settings.SCORE_COLUMNS]
    fitted = ensemble.averaged(ensemble.outputs(model, fitting), names, "sigmoid")
    dealt = order.batches(fitted, settings.ID_COLUMN, seed=seed)
    return evaluate.batch_losses(dealt, "batch", list(zip(names, settings.SCORE_COLUMNS)))


def train_ensemble(
    training: DataFrame,
    model_path: str,
    seed: int = settings.SPLIT_SEED,
    original_truth: bool = False,
    losses: str | None = None,
    **options,
) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """Train on noised scores, save the ensemble, and return it with comparison and MSE.

    As a rule the noised scores are the truth of the comparison as well. ``losses`` is where
    the batch losses of the fitted ensemble go, if anywhere.
    """
    evaluate.require_complete(training)
    noised = evaluate.add_noise(training, settings.ID_COLUMN, seed=seed)
    train_part, test_part = order.split(noised, settings.ID_COLUMN, seed=seed)
    fitting = train_part.drop(*settings.SCORE_COLUMNS).withColumnsRenamed(
        dict(zip(settings.RANDOMIZED_COLUMNS, settings.SCORE_COLUMNS))
    )
    model = ensemble.train(fitting, seed=seed, **options)
    ensemble.save(model, model_path)
    if losses:
        training_losses(model, fitting, seed).write.mode("overwrite").parquet(losses)
    scored = ensemble.averaged(
        ensemble.outputs(model, test_part), settings.EVALUATED_COLUMNS, "sigmoid"
    )
    truth = settings.SCORE_COLUMNS if original_truth else settings.RANDOMIZED_COLUMNS
    pairs = {
        target: (predicted, true)
        for target, predicted, true in zip(settings.SCORE_COLUMNS, settings.EVALUATED_COLUMNS, truth)
    }
    return model, scored, evaluate.mse(scored, pairs)


def score_articles(
    spark: SparkSession, dataset: DataFrame, model_path: str, predictions: str, filtered: str
) -> None:
    """Score the abstracts, write all predictions, and those above both thresholds."""
    scored = ensemble.scored(ensemble.load(model_path), dataset.select(*settings.ABSTRACT_COLUMNS), source_col="Abstract")
    written = sinks.write_version(
        scored.select(*settings.ABSTRACT_COLUMNS, *settings.PREDICTED_COLUMNS), predictions
    )
    # The filter reads the three columns back, so that nothing is scored twice.
    sinks.write_version(heads.keep_relevant(spark.read.parquet(written)), filtered)
