"""Classification metrics as tables, from (label, prediction, probability_0 .. probability_n)."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

EDGES = 256


def confusion(predictions: DataFrame) -> DataFrame:
    """(label, prediction, rows). Everything but AUROC derives from this small table."""
    return predictions.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("rows"))


def label_metrics(predictions: DataFrame) -> DataFrame:
    """(label, rows, precision, recall, f_score) for every label that occurs or is predicted; a ratio
    without a denominator is 0."""
    sides = confusion(predictions).select(
        F.explode(
            F.array(
                F.struct(F.col("label").alias("label"), F.col("rows").alias("actual"), F.lit(0).cast("bigint").alias("predicted"),
                         F.when(F.col("label") == F.col("prediction"), F.col("rows")).otherwise(0).alias("hits")),
                F.struct(F.col("prediction").alias("label"), F.lit(0).cast("bigint").alias("actual"), F.col("rows").alias("predicted"),
                         F.lit(0).cast("bigint").alias("hits")),
            )
        ).alias("side")
    ).select("side.*")
    totals = sides.groupBy("label").agg(*[F.sum(name).alias(name) for name in ("actual", "predicted", "hits")])
    ratio = lambda top, bottom: F.coalesce(F.col(top) / F.nullif(F.col(bottom), F.lit(0)), F.lit(0.0))
    both = F.col("precision") + F.col("recall")
    return (
        totals.withColumn("precision", ratio("hits", "predicted"))
        .withColumn("recall", ratio("hits", "actual"))
        .withColumn("f_score", F.when(both > 0, 2 * F.col("precision") * F.col("recall") / both).otherwise(0.0))
        .select("label", F.col("actual").alias("rows"), "precision", "recall", "f_score")
    )


def overall_metrics(predictions: DataFrame) -> DataFrame:
    """One row: rows, accuracy and the means of precision, recall and f-score weighted by label count. The
    weighted recall is the accuracy."""
    weighted = lambda name: (F.sum(F.col(name) * F.col("rows")) / F.sum("rows")).alias(name)
    return label_metrics(predictions).agg(
        F.sum("rows").alias("rows"),
        weighted("recall").alias("accuracy"),
        weighted("precision"),
        weighted("recall"),
        weighted("f_score"),
    )


def auroc(predictions: DataFrame, score: str = "probability_1", positive: float = 1.0) -> DataFrame:
    """The exact area under the ROC curve, ties counted half; NULL if a class is missing.

    Rows are first summed up by distinct score. The running count of negatives below a score is built
    in two levels, so that no task sees all scores: within slices between quantiles of the distinct scores,
    and over the at most 257 slice totals."""
    is_positive = F.col("label") == positive
    scores = (
        predictions.filter(F.col("label").isNotNull() & F.col(score).isNotNull())
        .groupBy(F.col(score).cast("double").alias("score"))
        .agg(F.count_if(is_positive).alias("positives"), F.count_if(~is_positive).alias("negatives"))
    )
    points = [i / EDGES for i in range(1, EDGES)]
    # naming both counts keeps the plan of `scores` as it is, so Spark reads its shuffle again for the edges
    distinct = F.when(F.col("positives") + F.col("negatives") > 0, F.col("score"))
    edges = scores.agg(F.percentile_approx(distinct, points, 10 * EDGES)).scalar()
    # the place of a score among the sorted edges: one more than the number of edges below it
    sliced = scores.withColumn(
        "slice", F.array_position(F.sort_array(F.array_append(edges, F.col("score"))), F.col("score"))
    )
    totals = sliced.groupBy("slice").agg(F.sum("negatives").alias("slice_negatives"))
    upto = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("slice", F.coalesce(F.sum("slice_negatives").over(upto), F.lit(0)).alias("before"))
    lower = Window.partitionBy("slice").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    ranked = sliced.withColumn("below", F.coalesce(F.sum("negatives").over(lower), F.lit(0))).join(
        F.broadcast(offsets), "slice"
    )
    wins = F.sum(F.col("positives") * (F.col("before") + F.col("below") + F.col("negatives") / 2.0))
    pairs = F.sum("positives").cast("double") * F.sum("negatives").cast("double")
    return ranked.agg((wins / F.nullif(pairs, F.lit(0.0))).alias("auroc"))


def class_columns(predictions: DataFrame) -> list[int]:
    """The classes that have a probability column."""
    found = (re.fullmatch(r"probability_(\d+)", name) for name in predictions.columns)
    return sorted(int(match[1]) for match in found if match)


def metrics_report(predictions: DataFrame) -> DataFrame:
    """All metrics in long form: (metric, label, value); label is NULL for the overall figures. AUROC of a
    label scores that label's own probability against that label."""
    per_label = label_metrics(predictions).select(
        F.explode(
            F.array(*[
                F.struct(F.lit(name).alias("metric"), F.col("label").cast("double").alias("label"), F.col(name).alias("value"))
                for name in ("precision", "recall", "f_score")
            ])
        ).alias("row")
    ).select("row.*")
    overall = overall_metrics(predictions).select(
        F.explode(
            F.array(*[
                F.struct(F.lit(name).alias("metric"), F.lit(None).cast("double").alias("label"), F.col(name).alias("value"))
                for name in ("accuracy", "precision", "recall", "f_score")
            ])
        ).alias("row")
    ).select("row.*")
    cells = confusion(predictions).select(
        F.format_string("confusion_predicted_%.0f", F.col("prediction").cast("double")).alias("metric"),
        F.col("label").cast("double").alias("label"),
        F.col("rows").cast("double").alias("value"),
    )
    areas = [
        auroc(predictions, f"probability_{i}", float(i)).select(
            F.lit("auroc").alias("metric"), F.lit(float(i)).alias("label"), F.col("auroc").alias("value")
        )
        for i in class_columns(predictions)
    ]
    return reduce(DataFrame.unionByName, [cells, overall, per_label, *areas])


def ensemble_vote(predictions: DataFrame) -> DataFrame:
    """One prediction per (subject, admission, label) from those of several models: the rounded mean of
    the votes (a tie goes up) and the mean probabilities."""
    return predictions.groupBy("subject_id", "hadm_id", "label").agg(
        F.round(F.avg("prediction")).alias("prediction"),
        *[F.avg(f"probability_{i}").alias(f"probability_{i}") for i in class_columns(predictions)],
    )
