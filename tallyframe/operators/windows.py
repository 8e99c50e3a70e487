"""Group-ordered features: lag and median columns, ranks, cumulative shares."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tallyframe.functions.nulls import order_by
from tallyframe.operators.distribute import running_totals
from tallyframe.operators.joins import left_on
from tallyframe.operators.quantiles import group_medians


def top_k_per_group(df: DataFrame, keys: Sequence[str], k: int, *cols: str) -> DataFrame:
    """First ``k`` rows of each group; Spark keeps only ``k`` per group and task before the shuffle."""
    w = W.partitionBy(*keys).orderBy(*order_by(*cols))
    return df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= k).drop("_rank")


def with_group_medians(
    df: DataFrame, keys: Sequence[str], cols: dict[str, str], strict: bool = True
) -> DataFrame:
    """Attach each column's group median to every row of the group."""
    return left_on(df, group_medians(df, keys, cols, strict), list(keys))


def fill_from(df: DataFrame, fills: dict[str, str]) -> DataFrame:
    """Replace missing values of each column by the value of another column."""
    return df.withColumns({c: F.coalesce(F.col(c), F.col(d)) for c, d in fills.items()})


def cumulative_share(df: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """Empirical distribution: share of the group's values at or below each distinct value."""
    present = df.filter(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    ranked = running_totals(present, value, {"n": F.lit(1)}, keys)
    return ranked.select(*keys, value, (F.col("n_run") / F.col("n_all")).alias("share"))


def ratio_to_previous(value: str, previous: str) -> Column:
    return F.try_divide(F.col(value).cast("double"), F.col(previous).cast("double"))
