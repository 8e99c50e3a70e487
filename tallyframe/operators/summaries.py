"""Summary statistics, variable profiles, histograms and box statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from tallyframe.functions.nulls import order_by
from tallyframe.functions.normal import inverse_normal
from tallyframe.operators.distribute import running_totals
from tallyframe.operators.joins import left_on
from tallyframe.operators.quantiles import long_form, quantiles

# Fixed values.
MAD_SCALE = 1.4826
BIN_LABELS = ["Low", "Low-Med", "Med-Hi", "Hi"]
WHISKER = 1.5


def _stats(c: Column) -> dict[str, Column]:
    return {
        "Mean": F.avg(c),
        "StdDev": F.stddev_samp(c),
        "Min": F.min(c),
        "Max": F.max(c),
        "ValidObs": F.count(c),
        "MissingObs": F.count(F.lit(1)) - F.count(c),
    }


def summary_numeric(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Mean, StdDev, Min, Max, ValidObs, MissingObs per column (and group).

    One pass computes every column's statistics side by side; only the few
    result rows are then laid out long.
    """
    rows = []
    for c in cols:
        value = F.col(c).cast("double")
        stats = [s.alias(n) for n, s in _stats(value).items()]
        rows.append(F.struct(F.lit(c).alias("variable"), *stats))
    return df.groupBy(*keys).agg(F.array(*rows).alias("_all")).select(*keys, F.inline("_all"))


def summary_by_group(
    df: DataFrame, col: str, keys: Sequence[str], which: Sequence[str] | None = None
) -> DataFrame:
    """Chosen statistics of one column per group."""
    stats = _stats(F.col(col))
    return df.groupBy(*keys).agg(*[stats[n].alias(n) for n in which or stats])


def table_info(df: DataFrame, first: int = 0, order: Sequence[str] = ()) -> DataFrame:
    """One row per column: type, lowest and highest value (as text; atomic types only), rows, missing, levels of text columns.

    With ``first`` the values of so many rows at the head of the table (of ``order``, if given) are listed too, as ``first_rows``.
    Levels are exact; they come from counting distinct (column, value) pairs of
    the text columns, combined map-side before the shuffle.
    """
    fields, ends, none = df.schema.fields, [], F.lit(None).cast("string")
    for f in fields:
        c, atomic = F.col(f"`{f.name}`"), isinstance(f.dataType, T.AtomicType)
        ends.append(
            F.struct(
                F.lit(f.name).alias("column"),
                F.lit(f.dataType.simpleString()).alias("type"),
                (F.min(c).cast("string") if atomic else none).alias("low"),
                (F.max(c).cast("string") if atomic else none).alias("high"),
                F.count(F.lit(1)).alias("n"),
                (F.count(F.lit(1)) - F.count(c)).alias("missing"),
            )
        )
    info = df.agg(F.array(*ends).alias("_all")).select(F.inline("_all"))
    if first:
        info = info.join(_first_rows(df, first, order), "column")
    text = [f.name for f in fields if isinstance(f.dataType, T.StringType)]
    if not text:
        return info.withColumn("levels", F.lit(None).cast("bigint"))
    pairs = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("v")) for c in text]
    levels = (
        df.select(F.inline(F.array(*pairs)))
        .filter(F.col("v").isNotNull())
        .distinct()
        .groupBy("column")
        .agg(F.count(F.lit(1)).alias("levels"))
    )
    # A text column without values has no level.
    none = F.when(F.col("column").isin(text), F.lit(0).cast("bigint"))
    return info.join(levels, "column", "left").withColumn("levels", F.coalesce("levels", none))


def _first_rows(df: DataFrame, first: int, order: Sequence[str]) -> DataFrame:
    """column and first_rows: its values in the first rows as text, with a bar between them and nothing for a missing one."""
    head = (df.orderBy(*order_by(*order)) if order else df).limit(first).withColumn("_at", F.monotonically_increasing_id())
    cells = [F.struct(F.lit(c).alias("column"), F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias("v")) for c in df.columns]
    rows = head.select("_at", F.inline(F.array(*cells))).groupBy("column").agg(F.sort_array(F.collect_list(F.struct("_at", "v"))).alias("_v"))
    return rows.select("column", F.array_join(F.col("_v.v"), " | ").alias("first_rows"))


def summary_frame(df: DataFrame, numeric: Sequence[str], levels: Sequence[str]) -> DataFrame:
    """Whole-table summary in long form: six numbers per numeric column, counts per level."""
    q = quantiles(df, numeric, [0.0, 0.25, 0.5, 0.75, 1.0])
    means = long_form(df, numeric).groupBy("variable").agg(F.avg("value").alias("mean"))
    names = ["Min", "1st Qu.", "Median", "3rd Qu.", "Max"]
    entries = [F.struct(F.lit(n).alias("statistic"), F.col(f"q{i}").alias("value")) for i, n in enumerate(names)]
    entries.append(F.struct(F.lit("Mean").alias("statistic"), F.col("mean").alias("value")))
    numbers = q.join(means, "variable").select("variable", F.inline(F.array(*entries)))
    text = F.array(
        *[F.struct(F.lit(c).alias("variable"), F.col(c).cast("string").alias("statistic")) for c in levels]
    )
    counts = (
        df.select(F.inline(text))
        .groupBy("variable", "statistic")
        .agg(F.count(F.lit(1)).cast("double").alias("value"))
    )
    return numbers.unionByName(counts)


def coefficient_of_variation(c: Column) -> Column:
    """Standard deviation as a percentage of the mean."""
    return 100 * F.try_divide(F.stddev_samp(c), F.avg(c))


def variable_profile(df: DataFrame, col: str, decimals: int = 2) -> DataFrame:
    """Nineteen statistics of one variable, one row per statistic.

    Skewness and kurtosis divide by the sample standard deviation; the standard
    error divides by the number of rows, missing ones included; the coefficient
    of dispersion is missing when the variable has missing values.
    """
    values = df.select(F.col(col).cast("double").alias("value"))
    q = quantiles(values, ["value"], [0.05, 0.25, 0.5, 0.75, 0.95]).select(
        F.col("q0").alias("Lo05"), F.col("q1").alias("Lo25"), F.col("q2").alias("Median"),
        F.col("q3").alias("Hi75"), F.col("q4").alias("Hi95"),
    )
    v = F.col("value")
    base = values.agg(
        F.count(F.lit(1)).alias("N"), F.count(v).alias("valid"), F.sum(v).alias("Sum"), F.avg(v).alias("Mean"),
        F.var_samp(v).alias("Variance"), F.min(v).alias("Low"), F.max(v).alias("High"),
        F.var_pop(v).alias("m2"), F.skewness(v).alias("skew"), F.kurtosis(v).alias("kurtosis"),
    )
    # Both tables have exactly one row, so their values travel as literals.
    b, m = base.first(), q.first()
    median = F.lit(m["Median"] if m else None).cast("double")
    apart = values.select(F.abs(v - median).alias("a"))
    mean_abs = apart.agg(F.avg("a")).first()[0]
    mad = quantiles(apart, ["a"], [0.5]).first()
    n, valid, sd = b["N"], b["valid"], (b["Variance"] or 0.0) ** 0.5
    per = lambda num, den: None if num is None or not den else num / den
    stats = [
        ("N", float(n)),
        ("NAs", float(n - valid)),
        ("Sum", b["Sum"]),
        ("Median", m and m["Median"]),
        ("Variance", b["Variance"]),
        ("Std.Dev", b["Variance"] and sd),
        ("Mean.Abs.Dev", mad and MAD_SCALE * mad["q0"]),
        ("Std.Err", per(sd, n**0.5)),
        ("Range.Low", b["Low"]),
        ("Lo.05", m and m["Lo05"]),
        ("Lo.25", m and m["Lo25"]),
        ("Mean", b["Mean"]),
        ("Hi.75", m and m["Hi75"]),
        ("Hi.95", m and m["Hi95"]),
        ("Range.High", b["High"]),
        # Merged central moments, divided by powers of the sample deviation.
        ("Skew", None if not sd else b["skew"] * b["m2"] ** 1.5 / sd**3),
        ("Kurtosis", None if not sd else (b["kurtosis"] + 3) * b["m2"] ** 2 / sd**4 - 3),
        ("CoD", None if valid < n or not m else per(100 * mean_abs, m["Median"])),
        ("CoV", per(100 * sd, b["Mean"])),
    ]
    out = df.sparkSession.createDataFrame(
        [(name, None if x is None else float(x)) for name, x in stats], "statistic string, value double"
    )
    return out.withColumn("value", F.bround("value", decimals))


def _quartiles(df: DataFrame, col: str) -> tuple[Column, ...]:
    """Lowest value, quartiles and highest value as constants, missing if the column has no values."""
    row = quantiles(df, [col], [0.0, 0.25, 0.5, 0.75, 1.0]).first()
    return tuple(F.lit(row[f"q{i}"] if row else None).cast("double") for i in range(5))


def outlier_flag(df: DataFrame, col: str, out: str = "outlier") -> DataFrame:
    """Mark values beyond 1.5 interquartile ranges from the quartiles."""
    _, q1, _, q3, _ = _quartiles(df, col)
    reach = WHISKER * (q3 - q1)
    return df.withColumn(out, (F.col(col) < q1 - reach) | (F.col(col) > q3 + reach))


def quartile_bin(df: DataFrame, col: str, out: str = "bin", of: DataFrame | None = None) -> DataFrame:
    """Four labelled bins at the quartiles (of the column in ``of``, if given); upper edges belong to the lower bin."""
    _, q1, q2, q3, _ = _quartiles(df if of is None else of, col)
    label = F.when(F.col(col) <= q1, BIN_LABELS[0])
    for edge, name in zip((q2, q3), BIN_LABELS[1:3]):
        label = label.when(F.col(col) <= edge, name)
    return df.withColumn(out, label.when(F.col(col).isNotNull(), BIN_LABELS[3]))


def histogram(df: DataFrame, col: str, bins: int = 20, keys: Sequence[str] = ()) -> DataFrame:
    """Counts and percentages over equal-width bins spanning the whole column.

    With ``keys`` the percentages are within each group. Columns: ``keys``,
    ``bin`` (from 0), ``bin_low``, ``count``, ``percent``. The highest value
    belongs to the last bin; empty bins are not listed.
    """
    x = F.col(col).cast("double")
    low, high = df.agg(F.min(x), F.max(x)).first()
    width = (high - low) / bins if low is not None and high > low else 1.0
    low = 0.0 if low is None else low
    number = F.least(F.floor((x - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).cast("bigint")
    counts = df.filter(x.isNotNull()).groupBy(*keys, number.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    # At most `bins` rows per group reach this window.
    share = F.col("count") * 100.0 / F.sum("count").over(W.partitionBy(*keys))
    return counts.select(
        *keys, "bin", (F.lit(low) + F.col("bin") * F.lit(width)).alias("bin_low"), "count", share.alias("percent")
    )


def density_overlay(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """Histogram density beside the normal density at each bin's centre.

    A constant column is one bin without densities; a column without values has no bin.
    """
    x = F.col(col).cast("double")
    low, high, mean, sd, n = df.agg(F.min(x), F.max(x), F.avg(x), F.stddev_samp(x), F.count(x)).first()
    if low == high:
        one = [(0, low, None, None)] if n else []
        return df.sparkSession.createDataFrame(one, "bin bigint, centre double, density double, normal double")
    width = (high - low) / bins
    centre = F.col("bin_low") + width / 2
    z = (centre - mean) / sd
    return histogram(df, col, bins).select(
        "bin",
        centre.alias("centre"),
        (F.col("count") / (n * width)).alias("density"),
        (F.exp(-z * z / 2) / (sd * F.sqrt(2 * F.pi()))).alias("normal"),
    )


def box_stats(df: DataFrame, col: str, keys: Sequence[str]) -> DataFrame:
    """Quartiles, whisker ends, and number of values beyond them, per group."""
    keys = list(keys)
    q = quantiles(df, [col], [0.25, 0.5, 0.75], keys, narrow=True).select(
        *keys, F.col("q0").alias("q1"), F.col("q1").alias("median"), F.col("q2").alias("q3"), "n"
    )
    x, reach = F.col(col).cast("double"), WHISKER * (F.col("q3") - F.col("q1"))
    inside = x.between(F.col("q1") - reach, F.col("q3") + reach)
    return (
        left_on(df, q, keys).filter(F.col("n").isNotNull())
        .groupBy(*keys, "q1", "median", "q3", "n")
        .agg(
            F.min(F.when(inside, x)).alias("whisker_low"),
            F.max(F.when(inside, x)).alias("whisker_high"),
            F.count(F.when(~inside, 1)).alias("outliers"),
        )
    )


def qq_points(df: DataFrame, col: str) -> DataFrame:
    """Every distinct value against the standard normal value of its place in the order.

    ``n`` rows share the value; ``p`` is the plotting position of the middle of their places, with the usual
    offset of 1/2, or 3/8 for ten values or fewer; ``bin`` is the value's quartile bin.
    """
    values = df.select(F.col(col).cast("double").alias("sample")).filter(F.col("sample").isNotNull() & ~F.isnan("sample"))
    ranked = running_totals(values, "sample", {"n": F.lit(1)})
    offset = F.when(F.col("n_all") <= 10, 3 / 8).otherwise(1 / 2)
    place = F.col("n_run") - (F.col("n") - 1) / 2
    placed = ranked.withColumn("p", (place - offset) / (F.col("n_all") + 1 - 2 * offset))
    binned = quartile_bin(placed, "sample", "bin", of=values)
    return binned.select("sample", "n", "p", inverse_normal(F.col("p")).alias("theoretical"), "bin")
