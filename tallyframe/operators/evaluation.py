"""Confusion matrices, ROC points and areas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tallyframe.operators.distribute import running_totals
from tallyframe.operators.quantiles import long_form


def confusion_matrix(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Counts per pair, and the share of each actual class predicted wrongly; a missing prediction is wrong."""
    counts = df.groupBy(actual, predicted).agg(F.count(F.lit(1)).alias("n"))
    # Classes × classes rows reach this window.
    by_class = W.partitionBy(actual)
    wrong = F.sum(F.when(F.col(actual).eqNullSafe(F.col(predicted)), 0).otherwise(F.col("n"))).over(by_class)
    return counts.withColumn("class_error", wrong / F.sum("n").over(by_class))


def roc_points(df: DataFrame, actual: str, score: str, keys: Sequence[str] = ()) -> DataFrame:
    """True and false positive rate with the cutoff at each distinct score, highest first.

    ``actual`` is 1 or 0. Ties share one point. Columns: ``keys``, ``cutoff``,
    ``tpr``, ``fpr``.
    """
    rows = df.filter(F.col(score).isNotNull() & ~F.isnan(score) & F.col(actual).isNotNull())
    hit = F.col(actual).cast("bigint")
    ranked = running_totals(rows, score, {"pos": hit, "neg": 1 - hit}, keys, descending=True)
    rate = lambda c: F.try_divide(F.col(f"{c}_run").cast("double"), F.col(f"{c}_all").cast("double"))
    return ranked.select(*keys, F.col(score).alias("cutoff"), rate("pos").alias("tpr"), rate("neg").alias("fpr"))


def roc_compare(df: DataFrame, actual: str, scores: Sequence[str]) -> DataFrame:
    """ROC points of several score columns, long form, labelled by ``model``."""
    long = long_form(df, scores, [actual]).withColumnsRenamed({"variable": "model", "value": "score"})
    return roc_points(long, actual, "score", ["model"])


def auc(df: DataFrame, actual: str, scores: Sequence[str]) -> DataFrame:
    """Area under each score's ROC curve by trapezoids, straight from the running counts.

    Between two neighbouring cutoffs the curve rises by the positives there and
    moves right by the negatives there, so no neighbour has to be looked up.
    """
    long = long_form(df, scores, [actual]).filter(F.col("value").isNotNull() & ~F.isnan("value") & F.col(actual).isNotNull())
    hit = F.col(actual).cast("bigint")
    ranked = running_totals(
        long.withColumnRenamed("variable", "model"), "value", {"pos": hit, "neg": 1 - hit}, ["model"], descending=True
    )
    strip = F.col("neg") * (F.col("pos_run") - F.col("pos") / 2)
    return ranked.groupBy("model").agg(
        F.try_divide(F.sum(strip), F.max("pos_all").cast("double") * F.max("neg_all")).alias("auc")
    )


def roc_cutoff(points: DataFrame, max_fpr: float = 0.1, keys: Sequence[str] = ()) -> DataFrame:
    """Lowest cutoff whose false positive rate is still below ``max_fpr``."""
    below = points.filter(F.col("fpr") < max_fpr)
    return below.groupBy(*keys).agg(F.min("cutoff").alias("cutoff"), F.max("tpr").alias("tpr"), F.max("fpr").alias("fpr"))
