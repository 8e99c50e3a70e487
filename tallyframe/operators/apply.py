"""User functions over groups and parameter grids."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.session import shuffle_partitions


def group_apply(df: DataFrame, keys: Sequence[str], f: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Any function of a pandas table, once per whole group.

    Each group becomes one pandas table in one task. For groups too large for that use
    :func:`group_combine`, or write the function as aggregates or windows.
    """
    return df.groupBy(*keys).applyInPandas(f, schema)


def group_combine(
    df: DataFrame,
    keys: Sequence[str],
    f: Callable[[pd.DataFrame], pd.DataFrame],
    combine: Callable[[pd.DataFrame], pd.DataFrame],
    schema: str,
) -> DataFrame:
    """A mergeable function per group, for groups of any size.

    ``f`` runs on each Arrow batch's part of a group where the rows lie, so only
    partial results are shuffled; these are merged in two steps, first per
    sending slot, so that a group present everywhere does not meet in one task.
    """
    keys = list(keys)

    def partial(batches):
        for batch in batches:
            parts = [f(part) for _, part in batch.groupby(keys, dropna=False, sort=False)]
            if parts:
                yield pd.concat(parts, ignore_index=True)

    slots = shuffle_partitions(df.sparkSession)
    merge = lambda pdf: combine(pdf.drop(columns="_slot"))
    return (
        df.mapInPandas(partial, schema)
        .withColumn("_slot", F.spark_partition_id() % slots)
        .groupBy(*keys, "_slot")
        .applyInPandas(merge, schema)
        .groupBy(*keys)
        .applyInPandas(combine, schema)
    )


def param_grid_apply(
    grid: DataFrame, f: Callable[[pd.DataFrame], pd.DataFrame], schema: str, tasks: int | None = None
) -> DataFrame:
    """Call a vectorized function over a table of parameters, spread over tasks.

    Values shared by all calls travel with the function. ``tasks`` spreads a
    small grid of costly calls; a large one is spread by its own partitions.
    """

    def run(batches):
        for batch in batches:
            yield f(batch)

    return (grid.repartition(tasks) if tasks else grid).mapInPandas(run, schema)
