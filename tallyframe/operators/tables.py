"""Cross-tabulations, cubes over declared levels, correlations."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.stat import ChiSquareTest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.operators.distribute import row_positions
from tallyframe.operators.joins import left_on
from tallyframe.session import materialize

def levels_of(df: DataFrame, col: str) -> list[str]:
    """The sorted distinct values of a level column: as many as a model has coefficients, or a wide table columns."""
    found = df.select(F.col(col).cast("string").alias("v")).filter("v IS NOT NULL").distinct()
    return sorted(r["v"] for r in found.collect())


def table_oneway(df: DataFrame, col: str) -> DataFrame:
    """Count per level and share of all rows."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    return counts.withColumn("share", F.col("count") / counts.agg(F.sum("count")).scalar())


def table_twoway(df: DataFrame, row: str, col: str, levels: Sequence | None = None) -> DataFrame:
    """Counts with one column per level of ``col``, zero where a pair never occurs; for many levels see :func:`table_long`."""
    levels = list(levels) if levels is not None else levels_of(df, col)
    return df.groupBy(row).pivot(col, levels).agg(F.count(F.lit(1))).na.fill(0, [str(v) for v in levels])


def table_long(df: DataFrame, row: str, col: str) -> DataFrame:
    """Counts of the pairs that occur, one row each, whatever the number of levels, with the shares of their row."""
    pairs = df.groupBy(row, col).agg(F.count(F.lit(1)).alias("count"))
    totals = pairs.groupBy(row).agg(F.sum("count").alias("_total"))
    return left_on(pairs, totals, [row]).select(row, col, "count", (F.col("count") / F.col("_total")).alias("row_share"))


def tile_matrix(df: DataFrame, row: str, col: str, levels: Sequence, measure: str) -> DataFrame:
    """Group means laid out as row level × column level."""
    return df.groupBy(row).pivot(col, list(levels)).agg(F.avg(measure))


def every_pair(rows: DataFrame, cols: DataFrame, col: str) -> DataFrame:
    """Each row of ``rows`` beside each row of ``cols``, whose key ``col`` is distinct.

    The columns' rows are numbered; every row counts up to their number where it lies and finds them by it.
    """
    numbered = materialize(row_positions(cols, [F.col(col).asc_nulls_first()], "_number"), "numbered")
    count = numbered.agg(F.count(F.lit(1))).scalar()
    wide = rows.withColumn("_count", count).filter("_count > 0")
    return wide.withColumn("_number", F.explode(F.sequence(F.lit(1).cast("bigint"), "_count"))).join(numbered, "_number").drop("_number", "_count")


def crosstab_chisq(df: DataFrame, row: str, col: str, absent: bool = True) -> DataFrame:
    """Per pair of levels: count, row share, expected count, chi-square contribution;
    and on every row the table's statistic and degrees of freedom.

    The statistic needs the pairs that occur and the totals only: what the others add is their expected
    count. Pairs that never occur are laid out for the output, unless ``absent`` is False.
    """
    pairs = materialize(df.groupBy(row, col).agg(F.count(F.lit(1)).alias("n")), "pairs")
    rows = pairs.groupBy(row).agg(F.sum("n").alias("row_total"))
    cols = pairs.groupBy(col).agg(F.sum("n").alias("col_total"))
    total = pairs.agg(F.sum("n")).scalar()
    expected = F.try_divide(F.col("row_total") * F.col("col_total"), total)
    contribution = F.try_divide(F.pow(F.col("n") - F.col("expected"), F.lit(2)), F.col("expected"))
    present = left_on(left_on(pairs, rows, [row]), cols, [col]).withColumn("expected", expected).withColumn("contribution", contribution)
    size = lambda table: table.agg(F.count(F.lit(1))).scalar()
    sums = present.agg(F.sum("contribution").alias("seen"), F.sum("expected").alias("covered"), F.count(F.lit(1)).alias("cells"))
    # With every cell present nothing is expected elsewhere.
    whole = sums.select(
        F.when(F.col("cells") == size(rows) * size(cols), F.col("seen")).otherwise(F.col("seen") + total - F.col("covered")).alias("chisq"),
        ((size(rows) - 1) * (size(cols) - 1)).cast("bigint").alias("df"))
    cells = present
    if absent:
        cells = left_on(every_pair(rows, cols, col), pairs, [row, col]).withColumn("n", F.coalesce("n", F.lit(0).cast("bigint")))
        cells = cells.withColumn("expected", expected).withColumn("contribution", contribution)
    return cells.select(
        row, col, "n", F.try_divide("n", "row_total").alias("row_share"), "expected", "contribution",
        whole.select("chisq").scalar().alias("chisq"), whole.select("df").scalar().alias("df"),
    )


def chisq_test(df: DataFrame, row: str, col: str) -> DataFrame:
    """Statistic, degrees of freedom and p-value of independence."""
    levels = df.select(F.col(row).cast("string").alias("r"), F.col(col).cast("string").alias("c"))
    indexed = StringIndexer(inputCols=["r", "c"], outputCols=["ri", "ci"]).fit(levels).transform(levels)
    features = VectorAssembler(inputCols=["ri"], outputCol="features").transform(indexed)
    return ChiSquareTest.test(features, "features", "ci", flatten=True).select(
        F.col("statistic"), F.col("degreesOfFreedom").cast("bigint").alias("df"), F.col("pValue").alias("p_value")
    )


def cube_means(
    df: DataFrame, measure: str, level: str, levels: DataFrame | None = None, means: bool = True, keep_empty: bool = True
) -> DataFrame:
    """Mean (or sum) and count per level, levels without rows included."""
    agg = F.avg(measure) if means else F.sum(measure)
    out = df.filter(F.col(measure).isNotNull()).groupBy(level).agg(agg.alias(measure), F.count(F.lit(1)).alias("Counts"))
    if levels is None or not keep_empty:
        return out
    every = levels.select(F.col(levels.columns[0]).alias(level)).distinct()
    return every.join(out, level, "left").withColumn("Counts", F.coalesce("Counts", F.lit(0).cast("bigint")))


def cube_binned(df: DataFrame, measure: str, x: str, y: str, empty_bins: bool = False) -> DataFrame:
    """Mean and count of ``measure`` over every pair of an integer bin of ``x`` and one of ``y``.

    With ``empty_bins`` the bins run from the least to the greatest that hold rows, as the levels of a cut variable do.
    Without, bins that no row falls into are no levels, so the table grows with the levels met, not with their range.
    """
    complete = df.filter(F.col(measure).isNotNull() & F.col(x).isNotNull() & F.col(y).isNotNull())
    binned = complete.select(
        F.floor(x).cast("bigint").alias(x), F.floor(y).cast("bigint").alias(y), F.col(measure).alias("_m")
    )
    cells = materialize(binned.groupBy(x, y).agg(F.avg("_m").alias(measure), F.count(F.lit(1)).alias("Counts")), "cells")
    if empty_bins:
        ends = cells.agg(F.min(x), F.max(x) + 1, F.min(y), F.max(y) + 1).first()
        x0, x1, y0, y1 = [end or 0 for end in ends]
        grid = df.sparkSession.range(x0, x1).toDF(x).crossJoin(df.sparkSession.range(y0, y1).toDF(y))
    else:
        grid = every_pair(cells.select(x).distinct(), cells.select(y).distinct(), y)
    return grid.join(cells, [x, y], "left").withColumn("Counts", F.coalesce("Counts", F.lit(0).cast("bigint")))


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlations over rows complete in all columns, long form, one pass; missing for a constant column."""
    complete = df.dropna(subset=list(cols))
    pairs = list(combinations_with_replacement(cols, 2))
    varies = lambda c: F.stddev_pop(c) > 0
    row = complete.agg(*[F.when(varies(a) & varies(b), F.lit(1.0) if a == b else F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    cells = []
    for i, (a, b) in enumerate(pairs):
        for left, right in {(a, b), (b, a)}:
            cells.append(F.struct(F.lit(left).alias("x"), F.lit(right).alias("y"), F.col(f"r{i}").alias("r")))
    return row.select(F.inline(F.array(*cells)))
