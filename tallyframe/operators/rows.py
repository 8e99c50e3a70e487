"""Row-level verbs: positions, samples, stacking, replication."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.keys import key_order
from tallyframe.functions.nulls import order_by


def arrange(df: DataFrame, *cols: str, ties: Sequence[str] = ()) -> DataFrame:
    """Sort with missing values last; ``-name`` sorts descending.

    ``ties`` should make rows unique: a sort key shared by many rows otherwise
    sends all of them to one task.
    """
    return df.orderBy(*order_by(*cols, *ties))


def top_n(df: DataFrame, n: int, *cols: str) -> DataFrame:
    """First ``n`` rows of a sort, kept as a bounded heap per task."""
    return df.orderBy(*order_by(*cols)).limit(n)


def slice_rows(df: DataFrame, first: int, last: int, *cols: str) -> DataFrame:
    """Rows ``first`` to ``last`` (from 1) of a sort by ``cols``, which must be unique."""
    return df.orderBy(*order_by(*cols)).offset(first - 1).limit(last - first + 1)


def tail_window(df: DataFrame, date: str, days: int) -> DataFrame:
    """Rows dated within ``days`` before the latest date, that day included."""
    latest = df.agg(F.max(date)).scalar()
    return df.filter(F.col(date) >= F.date_sub(latest, days))


def sample_n(df: DataFrame, n: int, key: str, seed: int = 0) -> DataFrame:
    """Exactly ``n`` rows (all, if fewer), repeatable: those with the smallest hashes of a unique key."""
    order = key_order(F.col(key), seed)
    return df.withColumn("_order", order).orderBy("_order").limit(n).drop("_order")


def stack(*parts: DataFrame, pad: bool = False) -> DataFrame:
    """Stack tables by column name; ``pad`` fills columns a part lacks with missing values."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=pad), parts)


def replicate(df: DataFrame, times: int, out: str | None = None) -> DataFrame:
    """Every row ``times`` over, made row by row without a join."""
    copies = df.withColumn(out or "_copy", F.explode(F.sequence(F.lit(1), F.lit(times))))
    return copies if out else copies.drop("_copy")
