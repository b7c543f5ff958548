"""Ensembles of linear heads on a vector, and the mean of their members."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litscreen import settings
from litscreen.functions import scores


def _wanted(heads: DataFrame, targets: tuple[str, ...], members: int | None = None) -> DataFrame:
    """The heads of the named targets and the first members: bounded by the arguments."""
    named = heads.filter(F.col("target").isin(list(targets)))
    return named if members is None else named.filter(F.col("member").between(0, members - 1))


def _as_map(heads: DataFrame) -> Column:
    """All heads in one value, ``target:member`` to bias and weights."""
    name = F.concat_ws(":", "target", "member")
    entry = F.struct(name, F.struct("bias", "weights"))
    return heads.agg(F.map_from_entries(F.collect_list(entry)).alias("heads")).scalar()


def _output(vector: str, target: str, member: int) -> Column:
    head = F.col("_heads")[f"{target}:{member}"]
    return scores.linear_head(F.col(vector), head["weights"], head["bias"])


def member_outputs(
    rows: DataFrame,
    heads: DataFrame,
    vector: str,
    members: int = settings.ENSEMBLE_SIZE,
    targets: tuple[str, ...] = settings.SCORE_COLUMNS,
) -> DataFrame:
    """Add one array column per target, ``<target>_members``, with the raw output of each member."""
    # Lambdas may use columns but not subqueries, hence the step between.
    return rows.withColumn("_heads", _as_map(_wanted(heads, targets, members))).withColumns({
        f"{target}_members": F.array(*[_output(vector, target, m) for m in range(members)])
        for target in targets
    }).drop("_heads")


def ensemble_mean(outputs: Column, link: str = "identity") -> Column:
    """The mean over the members: of the raw outputs for scoring, of sigmoids for evaluation."""
    if link == "sigmoid":
        outputs = F.transform(outputs, scores.sigmoid)
    elif link != "identity":
        raise ValueError(f"unknown link: {link}")
    return F.aggregate(outputs, F.lit(0.0), lambda total, x: total + x) / F.size(outputs)


def mean_by_row(
    outputs: DataFrame, id_col: str, targets: tuple[str, ...], link: str = "identity"
) -> DataFrame:
    """The same mean where outputs are rows of ID, member, target and value."""
    value = scores.sigmoid(F.col("value")) if link == "sigmoid" else F.col("value")
    return (
        outputs.groupBy(id_col)
        .pivot("target", list(targets))
        .agg(F.avg(value))
    )


def mean_head(heads: DataFrame) -> DataFrame:
    """One head per target that gives the mean of the raw outputs of all members.

    The mean of linear heads is a linear head, so scoring with it costs one product per
    target and not one per member.
    """
    members = F.sort_array(F.collect_list(F.struct("member", "weights")))  # one per member
    zeros = F.transform(F.col("members")[0]["weights"], lambda _: F.lit(0.0))
    total = F.aggregate(
        "members", zeros, lambda sums, m: F.zip_with(sums, m["weights"], lambda x, w: x + w)
    )
    return (
        heads.groupBy("target")
        .agg(F.avg("bias").alias("bias"), members.alias("members"))
        .select(
            F.lit(0).alias("member"),
            "target",
            "bias",
            F.transform(total, lambda x: x / F.size("members")).alias("weights"),
        )
    )


def score(
    rows: DataFrame,
    heads: DataFrame,
    vector: str,
    targets: tuple[str, ...] = settings.SCORE_COLUMNS,
    names: tuple[str, ...] = settings.PREDICTED_COLUMNS,
    digits: int | None = None,
) -> DataFrame:
    """Add the ensemble scores: mean of the members, then clipped to 0..1."""
    added = {}
    for target, name in zip(targets, names):
        value = scores.clip(_output(vector, target, 0))
        added[name] = F.round(value, digits) if digits is not None else value
    return rows.withColumn("_heads", _as_map(mean_head(_wanted(heads, targets)))).withColumns(added).drop("_heads")


def keep_relevant(
    predictions: DataFrame,
    thresholds: dict[str, float] | None = None,
    id_col: str = settings.ID_COLUMN,
) -> DataFrame:
    """ID and scores of the rows that reach all thresholds."""
    limits = thresholds or dict(zip(settings.PREDICTED_COLUMNS, settings.KEEP_THRESHOLDS))
    return predictions.filter(scores.meets(limits)).select(id_col, *limits)
