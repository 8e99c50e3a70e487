"""Linear models from sums: everything a least-squares fit needs is a handful of aggregates."""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import combinations_with_replacement

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.operators.joins import left_on
from tallyframe.session import materialize

GLANCE_SCHEMA = (
    "r_squared double, adj_r_squared double, sigma double, f_statistic double, p_value double, "
    "df bigint, aic double, bic double, n bigint"
)


def gram_matrix(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Sums of products of every pair of columns (and a constant), rows complete in all of them.

    Long form: ``keys``, ``x``, ``y``, ``value``; one pass, one row per group and pair.
    """
    names = ["1", *cols]
    column = lambda n: F.lit(1.0) if n == "1" else F.col(n).cast("double")
    pairs = list(combinations_with_replacement(names, 2))
    sums = df.dropna(subset=list(cols)).groupBy(*keys).agg(
        *[F.sum(column(a) * column(b)).alias(f"s{i}") for i, (a, b) in enumerate(pairs)]
    )
    cells = [
        F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(f"s{i}").alias("value"))
        for i, (a, b) in enumerate(pairs)
    ]
    return sums.select(*keys, F.inline(F.array(*cells)))


def lm_simple(df: DataFrame, y: str, x: str, keys: Sequence[str] = ()) -> DataFrame:
    """Slope, intercept, R² and rows of ``y ~ x``, per group if ``keys`` are given."""
    return df.groupBy(*keys).agg(
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r_squared"),
        F.regr_count(y, x).alias("n"),
    )


def lm_factor(df: DataFrame, y: str, level: str, base: str) -> DataFrame:
    """``y ~ level`` with ``base`` as the base level: estimates and standard errors.

    Least squares on one level column reduces to group means, so one aggregate
    replaces the fit.
    """
    groups = (
        df.filter(F.col(y).isNotNull() & F.col(level).isNotNull())
        .groupBy(level)
        .agg(F.count(F.lit(1)).alias("n"), F.avg(y).alias("mean"), F.var_pop(y).alias("var"))
    )
    groups = materialize(groups, "level-means")
    is_base = F.col(level) == base
    of_base = lambda c: groups.filter(is_base).agg(F.max(c)).scalar()
    whole = lambda c: groups.agg(c).scalar()
    sigma2 = whole(F.sum(F.col("n") * F.col("var"))) / (whole(F.sum("n")) - whole(F.count(F.lit(1))))
    error = F.when(is_base, 1 / F.col("n")).otherwise(1 / F.col("n") + 1 / of_base("n"))
    return groups.select(
        F.when(is_base, "(Intercept)").otherwise(F.concat(F.lit(level), F.col(level))).alias("term"),
        F.when(is_base, F.col("mean")).otherwise(F.col("mean") - of_base("mean")).alias("estimate"),
        F.sqrt(sigma2 * error).alias("std_error"),
    )


def level_sums(df: DataFrame, y: str, level: str, xs: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Per group and level: rows ``n``, means ``m`` of ``xs`` and ``y``, and centred products ``c`` of every pair of them.

    Products are taken about the level's own means, so a response far from zero costs no digits.
    """
    numeric = [*xs, y]
    complete = df.dropna(subset=[*numeric, level])
    value = [F.col(c).cast("double") for c in numeric]
    pairs = [(i, j) for i in range(len(numeric)) for j in range(i, len(numeric))]
    sums = complete.groupBy(*keys, F.col(level).cast("string").alias("_level")).agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.avg(v) for v in value]).alias("m"),
        F.array(*[F.count(F.lit(1)) * F.covar_pop(value[i], value[j]) for i, j in pairs]).alias("c"),
    )
    return sums


def _square(packed: Sequence[float], size: int) -> np.ndarray:
    """A symmetric matrix from its upper triangle."""
    out = np.zeros((size, size))
    out[np.triu_indices(size)] = packed
    return out + np.triu(out, 1).T


def _scaled_inverse(a: np.ndarray) -> np.ndarray:
    """Pseudo-inverse after scaling columns to unit length, which keeps it well conditioned; columns without spread give zeros."""
    scale = np.sqrt(np.diag(a))
    scale[scale <= 0] = 1.0
    return np.linalg.pinv(a / np.outer(scale, scale), rcond=1e-12, hermitian=True) / np.outer(scale, scale)


FIT_SCHEMA = "beta array<double>, inverse array<array<double>>, rss double, dof bigint, tss double, rows bigint, levels bigint"


def level_fits(sums: DataFrame, xs: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Per group, the fit of ``y ~ level + xs`` with the levels swept out: slopes, their unscaled covariance, residual sum.

    The dummies' block of the normal equations is diagonal, so what is left once it is eliminated is the sum
    of the centred products over the levels, a matrix as wide as ``xs``, however many levels there are.
    """
    k, keys = len(xs), list(keys)
    n, size = F.col("n"), k + 1
    width = size * (size + 1) // 2
    of_y = sums.groupBy(*keys).agg((F.sum(n * F.col("m")[k]) / F.sum(n)).alias("_mean"))
    apart = F.col("m")[k] - F.col("_mean")
    grouped = left_on(sums, of_y, keys).groupBy(*keys).agg(
        F.sum("n").alias("rows"), F.count(F.lit(1)).alias("levels"),
        F.array(*[F.sum(F.col("c")[i]) for i in range(width)]).alias("within"),
        # Spread of the level means of y: what the levels alone explain.
        F.sum(n * apart * apart).alias("between"),
    )

    @F.pandas_udf(FIT_SCHEMA)
    def solve(within: pd.Series, between: pd.Series, rows: pd.Series, levels: pd.Series) -> pd.DataFrame:
        out = []
        for packed, over, count, many in zip(within, between, rows, levels, strict=True):
            square = _square(packed, size)
            s, b, yy = square[:k, :k], square[:k, k], square[k, k]
            inverse = _scaled_inverse(s)
            beta = inverse @ b
            rss = max(yy - 2 * beta @ b + beta @ s @ beta, 0.0)
            spread = int((np.diag(s) > 0).sum())
            out.append((beta.tolist(), inverse.tolist(), rss, int(count) - int(many) - spread, yy + over, int(count), int(many)))
        return pd.DataFrame(out, columns=["beta", "inverse", "rss", "dof", "tss", "rows", "levels"])

    return grouped.select(*keys, F.inline(F.array(solve("within", "between", "rows", "levels"))))


@F.pandas_udf(T.DoubleType())
def student_p(t: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([student_t_two_sided(v, int(d)) for v, d in zip(t, dof, strict=True)])


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def quadratic_form(x: Column, matrix: Column) -> Column:
    """x' M x"""
    return _dot(x, F.transform(matrix, lambda line: _dot(line, x)))


def lm_group_tidy(df: DataFrame, y: str, level: str, xs: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Per group, the coefficient table of ``y ~ level + xs``, the first level as base.

    Slopes come from one small system per group; each level's estimate and error then follow from its own
    means by a join, so a group may have any number of levels. Columns without spread inside the levels give no row.
    """
    if not keys:
        return lm_group_tidy(df.withColumn("_group", F.lit(0)), y, level, xs, ["_group"]).drop("_group")
    keys, k = list(keys), len(xs)
    sums = materialize(level_sums(df, y, level, xs, keys), "level-sums")
    fits = materialize(level_fits(sums, xs, keys), "level-fits")
    first = sums.groupBy(*keys).agg(F.min(F.struct("_level", "n", "m")).alias("_base"))
    named = left_on(left_on(sums, fits, keys), first, keys)
    sigma2 = F.when(F.col("dof") > 0, F.col("rss") / F.col("dof"))
    x, x0 = F.slice("m", 1, k), F.slice(F.col("_base.m"), 1, k)
    is_base = F.col("_level") == F.col("_base._level")
    shift = F.zip_with(x, x0, lambda a, b: a - b)
    own = F.col("m")[k] - _dot(F.col("beta"), x)
    of_base = F.col("_base.m")[k] - _dot(F.col("beta"), x0)
    levels = named.select(
        *keys, F.when(is_base, "(Intercept)").otherwise(F.concat(F.lit(level), F.col("_level"))).alias("term"),
        F.when(is_base, own).otherwise(own - of_base).alias("estimate"),
        F.sqrt(sigma2 * F.when(is_base, 1 / F.col("n") + quadratic_form(x, F.col("inverse")))
               .otherwise(1 / F.col("n") + 1 / F.col("_base.n") + quadratic_form(shift, F.col("inverse")))).alias("std_error"),
        "dof")
    slopes = F.array(*[
        F.struct(F.lit(c).alias("term"), F.col("beta")[i].alias("estimate"), F.col("inverse")[i][i].alias("v")) for i, c in enumerate(xs)])
    numbers = fits.select(*keys, F.inline(slopes), "dof", sigma2.alias("s2")).filter("v > 0").select(
        *keys, "term", "estimate", F.sqrt(F.col("s2") * F.col("v")).alias("std_error"), "dof")
    t = F.try_divide("estimate", "std_error")
    rows = levels.unionByName(numbers).withColumn("statistic", t).withColumn("p_value", student_p(F.col("statistic"), F.col("dof")))
    return rows.select(*keys, "term", "estimate", "std_error", "statistic", "p_value")


def lm_group_glance(df: DataFrame, y: str, level: str, xs: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Per group, the fit measures of ``y ~ level + xs``."""
    if not keys:
        return lm_group_glance(df.withColumn("_group", F.lit(0)), y, level, xs, ["_group"]).drop("_group")
    keys = list(keys)
    fits = level_fits(materialize(level_sums(df, y, level, xs, keys), "level-sums"), xs, keys)

    @F.pandas_udf(GLANCE_SCHEMA)
    def measure(rss: pd.Series, tss: pd.Series, rows: pd.Series, dof: pd.Series) -> pd.DataFrame:
        out = []
        for rest, all_, n, left in zip(rss, tss, rows, dof, strict=True):
            p = n - left
            with np.errstate(divide="ignore", invalid="ignore"):
                r2 = 1 - np.float64(rest) / all_
                f = np.float64(all_ - rest) / (p - 1) / (np.float64(rest) / left)
                loglik = -n / 2 * (math.log(2 * math.pi) + np.log(np.float64(rest) / n) + 1)
                out.append((
                    r2, 1 - (1 - r2) * np.float64(n - 1) / left, math.sqrt(rest / left) if left > 0 else math.nan, f, f_upper_tail(f, p - 1, left),
                    p, -2 * loglik + 2 * (p + 1), -2 * loglik + math.log(n) * (p + 1), n))
        return pd.DataFrame(out, columns=[c.split()[0] for c in GLANCE_SCHEMA.split(", ")])

    return fits.select(*keys, F.inline(F.array(measure("rss", "tss", "rows", "dof"))))


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz method)."""
    tiny = 1e-300
    c, d = 1.0, 1 / max(1 - (a + b) * x / (a + 1), tiny)
    h = d
    for m in range(1, 500):
        for num in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1 + num * d
            d = 1 / (d if abs(d) > tiny else tiny)
            c = 1 + num / c
            c = c if abs(c) > tiny else tiny
            h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return h


def incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularized incomplete beta function, the tail of the t and F distributions."""
    if x <= 0 or x >= 1:
        return 0.0 if x <= 0 else 1.0
    log_front = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    if x < (a + 1) / (a + b + 2):
        return math.exp(log_front) * _beta_fraction(a, b, x) / a
    return 1 - math.exp(log_front) * _beta_fraction(b, a, 1 - x) / b


def student_t_two_sided(t: float, dof: int) -> float:
    if dof <= 0 or not math.isfinite(t):
        return float("nan")
    return incomplete_beta(dof / 2, 0.5, dof / (dof + t * t))


def f_upper_tail(f: float, d1: int, d2: int) -> float:
    if d1 <= 0 or d2 <= 0 or not math.isfinite(f):
        return float("nan")
    return incomplete_beta(d2 / 2, d1 / 2, d2 / (d2 + d1 * f))


def out_of_fold_means(df: DataFrame, y: str, level: str, fold: str) -> DataFrame:
    """Held-out predictions of ``y ~ level``: each row is predicted from the other folds.

    One pass: a level's mean over the other folds is its total minus the fold's
    own share. Returns one row per fold and level.
    """
    cells = df.groupBy(level, fold).agg(F.sum(y).alias("s"), F.count(y).alias("n"), F.sum(F.pow(y, F.lit(2))).alias("ss"))
    totals = cells.groupBy(level).agg(F.sum("s").alias("all_s"), F.sum("n").alias("all_n"))
    mean = F.try_divide(F.col("all_s") - F.col("s"), F.col("all_n") - F.col("n"))
    return left_on(cells, totals, [level]).select(
        level, fold, "n", mean.alias("prediction"),
        (F.col("ss") - 2 * mean * F.col("s") + F.col("n") * mean * mean).alias("squared_error"),
    )
