"""Join forms used by the analyses. Strategy is the optimizer's choice unless a bound is known."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def left_on(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join in which a missing key matches a missing key; the left side's keys stay."""
    theirs = other.withColumnsRenamed({k: f"_key_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys]
    return df.join(theirs, same, "left").drop(*[f"_key_{k}" for k in keys])


def left_dim(df: DataFrame, dim: DataFrame, key: str, *attrs: str) -> DataFrame:
    """Attach only the named columns of a dimension."""
    return left_on(df, dim.select(key, *attrs), [key])


def left_override(df: DataFrame, other: DataFrame, key: str, col: str) -> DataFrame:
    """Left join in which the other table's value wins where it has one."""
    theirs = other.select(key, F.col(col).alias("_theirs"))
    return (
        left_on(df, theirs, [key])
        .withColumn(col, F.coalesce("_theirs", col))
        .drop("_theirs")
        .select(*df.columns)
    )


def group_stats(df: DataFrame, keys: Sequence[str], **stats: Column) -> DataFrame:
    """Attach per-group statistics to every row.

    The statistics are combined map-side and joined back; a window would pull
    each whole group into one task.
    """
    per_group = df.groupBy(*keys).agg(*[c.alias(n) for n, c in stats.items()])
    return left_on(df, per_group, list(keys))


def semi_on(df: DataFrame, members: DataFrame, member: str, *cols: str) -> DataFrame:
    """Keep rows whose every listed column is found in ``members[member]``."""
    for c in cols:
        df = df.join(members.select(F.col(member).alias(c)), c, "left_semi")
    return df


def anti_on(df: DataFrame, other: DataFrame, *keys: str) -> DataFrame:
    """Rows whose key is not in the other table."""
    return df.join(other.select(*keys), list(keys), "left_anti")


def day_grid(entities: DataFrame, last_day: Column, days: int, out: str = "DATE") -> DataFrame:
    """Every row once for each of the ``days`` days after ``last_day``.

    The days are generated per row, so no join is needed.
    """
    ahead = F.explode(F.sequence(F.date_add(last_day, 1), F.date_add(last_day, days)))
    return entities.withColumn(out, ahead)
