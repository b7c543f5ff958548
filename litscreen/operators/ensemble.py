"""Regression ensembles on texts: training, scoring and evaluation with Spark ML."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.common import _py2java
from pyspark.ml.feature import (
    IDF, CountVectorizerModel, HashingTF, RegexTokenizer, SQLTransformer, VectorAssembler,
)
from pyspark.ml.functions import predict_batch_udf, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from litscreen import schemas, settings
from litscreen.functions import let, scores, text
from litscreen.operators import gram, order
from litscreen.operators.heads import ensemble_mean


# The tokens of a text as an expression, for a stage that is saved with its model.
_TOKENS = "regexp_extract_all(lower(coalesce({column}, '')), r'" + text.TOKEN + "', 0)"
REGULARISATION = 0.01
_SAVED = "output string, bias double, weights array<double>"
SCORED_AT_ONCE = 4096  # rows of one call of a member in Python; results do not depend on it
DRAW_STEP = 2.0**-32  # resolution of a draw


def poisson_steps(mean: float = 1.0) -> list[float]:
    """Probabilities of at most 0, 1, 2 .. draws, as far as a draw can tell them from one."""
    steps, probability = [], math.exp(-mean)
    below = probability
    while below < 1 - DRAW_STEP:
        steps.append(below)
        probability *= mean / len(steps)
        below += probability
    return steps


def bootstrap_weight(id_col: str, member: int, seed: int = settings.SPLIT_SEED) -> Column:
    """How often a row is in the sample of a member when rows are drawn with replacement.

    The count follows the Poisson law of mean 1 and is read off the hash of the ID, so it
    does not depend on the partitions and no row is copied.
    """
    def count(draw: Column) -> Column:
        weight, steps = F, poisson_steps()
        for times, below in enumerate(steps):
            weight = weight.when(draw < below, float(times))
        return weight.otherwise(float(len(steps)))

    return let(scores.uniform(F.col(id_col), f"member{member}:{seed}"), count)


def with_bootstrap(
    df: DataFrame,
    id_col: str,
    members: int = settings.ENSEMBLE_SIZE,
    seed: int = settings.SPLIT_SEED,
) -> DataFrame:
    """Add the weight of each row for each member as ``weight_<member>``."""
    return df.withColumns({f"weight_{m}": bootstrap_weight(id_col, m, seed) for m in range(members)})


def _output(member: int, target: str) -> str:
    return f"{target}_{member}"


def text_features(texts: DataFrame, text_col: str, width: int) -> PipelineModel:
    """Words, hashed into ``width`` counts, weighted by how few texts hold them."""
    return Pipeline(stages=[
        RegexTokenizer(inputCol=text_col, outputCol="_tokens", pattern=text.NOT_WORD),
        HashingTF(inputCol="_tokens", outputCol="_counts", numFeatures=width),
        IDF(inputCol="_counts", outputCol="features"),
    ]).fit(texts)


def vocabulary_features(texts: DataFrame, vocab: DataFrame, text_col: str) -> PipelineModel:
    """Counts of the terms of a vocabulary, in the order of its ids, weighted by how few texts hold them.

    The vocabulary comes to the driver: it is bounded by the size it was made with.
    """
    terms = [row.term for row in vocab.orderBy("token_id").select("term").collect()]
    counts = CountVectorizerModel.from_vocabulary(terms, inputCol="_tokens", outputCol="_counts")
    tokens = SQLTransformer(statement="SELECT *, " + _TOKENS.replace("{column}", text_col) + " AS _tokens FROM __THIS__")
    return Pipeline(stages=[tokens, counts, IDF(inputCol="_counts", outputCol="features")]).fit(texts)


def line(rows: DataFrame, x: str, y: str) -> tuple[float, float]:
    """Slope and intercept of ``y`` on one feature, without regularisation."""
    assembled = VectorAssembler(inputCols=[x], outputCol="_x").transform(rows)
    fitted = LinearRegression(featuresCol="_x", labelCol=y, solver="normal").fit(assembled)
    return float(fitted.coefficients[0]), float(fitted.intercept)


def as_embedding(vector: str, kind: str = "float32") -> Column:
    return vector_to_array(F.col(vector), kind)


def linear_stage(spark: SparkSession, weights: np.ndarray, bias: float, output: str) -> LinearRegressionModel:
    """A linear model as a stage of a pipeline."""
    kind = spark._jvm.org.apache.spark.ml.regression.LinearRegressionModel
    vector = _py2java(spark.sparkContext, Vectors.dense(weights))
    stage = LinearRegressionModel(kind(f"linear_{output}", vector, float(bias)))
    return stage.setFeaturesCol("features").setPredictionCol(output)


def train(
    training: DataFrame,
    id_col: str = settings.ID_COLUMN,
    text_col: str = settings.TEXT_COLUMN,
    targets: tuple[str, ...] = settings.SCORE_COLUMNS,
    members: int = settings.ENSEMBLE_SIZE,
    width: int = 1024,
    seed: int = settings.SPLIT_SEED,
) -> PipelineModel:
    """Fit all members and return them with their text features as one pipeline.

    One pass over the texts counts the words, another one adds up what all members and targets need. The sums of a
    member are a square matrix of ``width`` rows, on which its targets are solved.
    """
    features = text_features(training, text_col, width)
    rows = features.transform(training)
    weightings = [bootstrap_weight(id_col, m, seed) for m in range(members)]
    sums = gram.weighted_sums(rows, "features", [F.col(t) for t in targets], weightings)
    if not sums:
        raise ValueError("no rows to learn from")
    fitted = [
        linear_stage(training.sparkSession, *sums[m].ridge(k, REGULARISATION), _output(m, target))
        for m in range(members) for k, target in enumerate(targets)
    ]
    return PipelineModel(features.stages + fitted)


def train_epochs(
    rows: DataFrame,
    vector: str,
    target: str,
    id_col: str = settings.ID_COLUMN,
    epochs: int = settings.EPOCHS,
    steps: int = settings.STEPS_PER_EPOCH,
    rate: float = settings.LEARNING_RATE,
    seed: int = settings.SPLIT_SEED,
) -> DataFrame:
    """Train by mini-batches: one row for each epoch with its loss and the model after it.

    Rows are shuffled by the hash of their ID and dealt to ``steps`` batches, the same ones in each epoch. The sums of
    all batches come from one pass, whatever the number of epochs.
    """
    numbered = order.number_rows(rows, id_col, seed, "_row")
    dealt = [F.when(F.pmod(F.col("_row"), F.lit(steps)) == k, 1.0).otherwise(0.0) for k in range(steps)]
    batches = [s for s in gram.weighted_sums(numbered, vector, [F.col(target)], dealt) if s.weight]
    found = gram.descend(batches, 0, epochs, rate) if batches else []
    return rows.sparkSession.createDataFrame(
        [(epoch, loss, target, bias, weights.tolist()) for epoch, (loss, weights, bias) in enumerate(found, 1)], schemas.EPOCHS)


def mean_model(
    model: PipelineModel,
    spark: SparkSession,
    targets: tuple[str, ...] = settings.SCORE_COLUMNS,
    members: int = settings.ENSEMBLE_SIZE,
) -> PipelineModel:
    """The same features with one linear model for each target, whose output is the mean of the members' outputs.

    The mean of linear models is a linear model: scoring costs one product for each target.
    """
    fitted = {s.getPredictionCol(): s for s in model.stages if _is_linear(s)}
    of = lambda t: [fitted[_output(m, t)] for m in range(members)]
    means = [linear_stage(spark, np.mean([s.coefficients.toArray() for s in of(t)], axis=0),
                          float(np.mean([s.intercept for s in of(t)])), _mean_output(t)) for t in targets]
    return PipelineModel([s for s in model.stages if not _is_linear(s)] + means)


def _mean_output(target: str) -> str:
    return f"{target}_mean"


def scored(
    model: PipelineModel,
    rows: DataFrame,
    names: tuple[str, ...] = settings.PREDICTED_COLUMNS,
    targets: tuple[str, ...] = settings.SCORE_COLUMNS,
    members: int = settings.ENSEMBLE_SIZE,
    text_col: str = settings.TEXT_COLUMN,
    source_col: str | None = None,
) -> DataFrame:
    """Add the ensemble scores for inference: means of the members, clipped."""
    given = rows.withColumn(text_col, F.col(source_col)) if source_col else rows
    made = mean_model(model, rows.sparkSession, targets, members).transform(given)
    return made.select(*rows.columns, *[scores.clip(F.col(_mean_output(t))).alias(n) for t, n in zip(targets, names)])


def _is_linear(stage) -> bool:
    return isinstance(stage, LinearRegressionModel)


def save(model: PipelineModel, path: str) -> None:
    """Text features as a pipeline, and the linear models of all members as one table of a few rows."""
    spark = SparkSession.active()
    PipelineModel([s for s in model.stages if not _is_linear(s)]).write().overwrite().save(f"{path}/features")
    rows = [(s.getPredictionCol(), float(s.intercept), s.coefficients.toArray().tolist()) for s in model.stages if _is_linear(s)]
    spark.createDataFrame(rows, _SAVED).coalesce(1).write.mode("overwrite").parquet(f"{path}/heads")


def load(path: str) -> PipelineModel:
    spark = SparkSession.active()
    features = PipelineModel.load(f"{path}/features")
    rows = spark.read.schema(_SAVED).parquet(f"{path}/heads").collect()
    return PipelineModel(features.stages + [linear_stage(spark, np.array(r.weights), r.bias, r.output) for r in rows])


def heads_table(
    spark: SparkSession,
    model: PipelineModel,
    members: int = settings.ENSEMBLE_SIZE,
    targets: tuple[str, ...] = settings.SCORE_COLUMNS,
) -> DataFrame:
    """The linear heads of a trained ensemble as a table of a few rows."""
    fitted = {stage.getPredictionCol(): stage for stage in model.stages if hasattr(stage, "coefficients")}
    return spark.createDataFrame(
        [
            (m, t, float(fitted[_output(m, t)].intercept), [float(w) for w in fitted[_output(m, t)].coefficients])
            for m in range(members) for t in targets
        ],
        schemas.HEADS,
    )


def outputs(
    model: PipelineModel,
    rows: DataFrame,
    targets: tuple[str, ...] = settings.SCORE_COLUMNS,
    members: int = settings.ENSEMBLE_SIZE,
    text_col: str = settings.TEXT_COLUMN,
    source_col: str | None = None,
    embeddings: bool = False,
) -> DataFrame:
    """Add the raw outputs of all members as ``<target>_members``, row by row in place."""
    source = source_col or text_col
    given = rows if source == text_col else rows.withColumn(text_col, F.col(source))
    scored = model.transform(given)
    added = [
        F.array(*[F.col(_output(m, t)) for m in range(members)]).alias(f"{t}_members") for t in targets
    ]
    if embeddings:
        added.append(as_embedding("features").alias("embedding"))
    return scored.select(*rows.columns, *added)


def averaged(
    rows: DataFrame,
    names: tuple[str, ...],
    link: str,
    targets: tuple[str, ...] = settings.SCORE_COLUMNS,
) -> DataFrame:
    """Add the ensemble scores: clipped means for scoring, means of sigmoids for evaluation."""
    added = {}
    for target, name in zip(targets, names):
        mean = ensemble_mean(F.col(f"{target}_members"), link)
        added[name] = scores.clip(mean) if link == "identity" else mean
    return rows.withColumns(added)


def predict_batches(
    vector: str, make_members: Callable[[], list[Callable]], width: int, batch_size: int = SCORED_AT_ONCE
) -> Column:
    """Score with members written in Python: all outputs of all members as one array.

    ``make_members`` runs once per Python worker and gives functions from a matrix of
    vectors to a matrix of two scores each. Rows travel in Arrow batches.
    """
    def make_predict():
        members = make_members()

        def predict(vectors):
            import numpy as np

            return np.concatenate([member(vectors) for member in members], axis=1)

        return predict

    udf = predict_batch_udf(
        make_predict, return_type=T.ArrayType(T.DoubleType()), batch_size=batch_size,
        input_tensor_shapes=[[width]],
    )
    return udf(F.col(vector))
