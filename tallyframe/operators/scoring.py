"""Scoring: stored coefficients, thresholds, several models in one plan."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def align_levels(c: str, levels: Sequence[str]) -> Column:
    """The value if it is a declared level, else missing."""
    return F.when(F.col(c).isin(list(levels)), F.col(c))


def level_index(c: str, levels: Sequence[str]) -> Column:
    """Position (from 1) in the declared level order; unknown text is missing."""
    at = F.array_position(F.array(*[F.lit(v) for v in levels]), F.col(c))
    return F.when(at > 0, at.cast("bigint"))


def score_threshold(score: Column | str, limit: float = 0.60) -> Column:
    """"Yes" above the limit, else "No"; a missing score stays missing."""
    c = F.col(score) if isinstance(score, str) else score
    return F.when(c > limit, "Yes").when(c <= limit, "No")


def score_with_coefficients(
    df: DataFrame, coefficients: DataFrame, terms: Sequence[str], out: str = "score", intercept: str = "(Intercept)"
) -> DataFrame:
    """Linear score from a table of ``term`` and ``estimate``.

    The estimates of the terms asked for are packed into one map value, and the score
    is a sum within each row: the rows are neither lengthened nor shuffled.
    """
    wanted = coefficients.filter(F.col("term").isin([*terms, intercept]))
    packed = wanted.agg(F.map_from_entries(F.collect_list(F.struct("term", "estimate")))).scalar()
    products = [F.col(t).cast("double") * F.coalesce(F.try_element_at("_b", F.lit(t)), F.lit(0.0)) for t in terms]
    start = F.coalesce(F.try_element_at("_b", F.lit(intercept)), F.lit(0.0))
    return df.withColumn("_b", packed).withColumn(out, reduce(lambda a, b: a + b, products, start)).drop("_b")


def score_keep(fit, df: DataFrame, keep: Sequence[str], scores: Sequence[Column]) -> DataFrame:
    """Score and keep chosen input columns beside chosen score columns."""
    return fit.transform(df).select(*keep, *scores)


def score_chain(df: DataFrame, fits: dict, keep: Sequence[str]) -> DataFrame:
    """Add each model's prediction under its name; one plan, no row matching by position."""
    out = df
    for name, fit in fits.items():
        base = out.columns
        out = fit.transform(out).select(*base, F.col("prediction").alias(name))
    return out.select(*keep, *fits)
