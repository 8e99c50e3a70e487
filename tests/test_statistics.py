"""Summaries, tables, linear models, ROC against direct computation."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tallyframe.functions import normal
from tallyframe.operators import evaluation, formula, linear, quantiles, scoring, summaries, tables
from tallyframe.operators import select as sel


def test_profile_counts_missing_values(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (None,)], "x double")
    p = {r.statistic: r.value for r in summaries.variable_profile(df, "x", 4).collect()}
    assert (p["N"], p["NAs"], p["Median"], p["Sum"]) == (4, 1, 2, 7)
    sd = np.std([1, 2, 4], ddof=1)
    # The standard error divides by all rows, missing ones included.
    assert p["Std.Err"] == round(sd / 2, 4)
    assert p["Mean.Abs.Dev"] == 1.4826
    assert p["CoD"] is None
    assert len(p) == 19


def test_profile_of_a_constant(spark):
    df = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    p = {r.statistic: r.value for r in summaries.variable_profile(df, "x").collect()}
    assert p["Variance"] == 0 and p["Skew"] is None and p["Kurtosis"] is None


def test_quartile_bins_and_outliers(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 10)] + [(100.0,), (None,)], "x double")
    bins = {r.x: r.bin for r in summaries.quartile_bin(df, "x").collect()}
    assert bins[1.0] == "Low" and bins[100.0] == "Hi" and bins[None] is None
    flags = {r.x: r.outlier for r in summaries.outlier_flag(df, "x").collect()}
    assert flags[100.0] and not flags[9.0] and flags[None] is None


def test_histogram_holds_every_value(spark):
    df = spark.createDataFrame([(float(i),) for i in range(101)] + [(None,)], "x double")
    rows = summaries.histogram(df, "x", 10).collect()
    assert sum(r["count"] for r in rows) == 101 and max(r.bin for r in rows) == 9
    assert math.isclose(sum(r.percent for r in rows), 100)


def test_declared_levels_without_rows(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", None)], "k string, x double")
    levels = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    out = {r.k: (r.x, r.Counts) for r in tables.cube_means(df, "x", "k", levels).collect()}
    assert out == {"a": (2.0, 2), "b": (None, 0), "c": (None, 0)}


def test_chi_square(spark):
    data = [("a", "x")] * 10 + [("a", "y")] * 20 + [("b", "x")] * 30 + [("b", "y")] * 15 + [("c", "x")] * 5
    df = spark.createDataFrame(data, "r string, c string")
    cells = tables.crosstab_chisq(df, "r", "c").collect()
    assert len(cells) == 6 and cells[0].df == 2
    test = tables.chisq_test(df, "r", "c").first()
    assert math.isclose(cells[0].chisq, test.statistic, rel_tol=1e-9) and test.df == 2


def test_correlation_uses_complete_rows(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.5), (3.0, 5.0), (None, 100.0)], "a double, b double")
    r = {(x.x, x.y): x.r for x in tables.correlation_matrix(df, ["a", "b"]).collect()}
    assert math.isclose(r["a", "b"], np.corrcoef([1, 2, 3], [2, 4.5, 5])[0, 1]) and r["a", "a"] == 1


def test_selectors(spark):
    df = spark.createDataFrame([], "NO2_MEAN double, O3_MEAN double, V01 int, V02 int, x_mean int")
    assert sel.contains(df, "mean") == ["NO2_MEAN", "O3_MEAN", "x_mean"]
    assert sel.contains(df, "mean", ignore_case=False) == ["x_mean"]
    assert sel.num_range(df, "V", range(1, 4), 2) == ["V01", "V02"]
    assert sel.matches(df, "^.O2_") == ["NO2_MEAN"]
    assert sel.between(df, "O3_MEAN", "V02") == ["O3_MEAN", "V01", "V02"]


def test_model_terms():
    cols = ["y", "a", "b", "yearsEmploy", "year"]
    terms = formula.model_terms(cols, "y", ["y", "a", "b"], ["year"])
    assert terms == [("a",), ("b",), ("yearsEmploy",), ("a", "b")]
    assert formula.formula_text("y", terms) == "y ~ a + b + yearsEmploy + a:b"
    assert formula.predictors(cols, "year", substring=True) == ["y", "a", "b"]
    assert formula.predictors(cols, "year") == ["y", "a", "b", "yearsEmploy"]


@pytest.fixture(scope="module")
def grouped(spark):
    rng = np.random.default_rng(3)
    rows = []
    for g in ("p", "q"):
        for i in range(120):
            level = str(rng.choice(["u", "v", "w"]))
            a, b = rng.normal(), float(rng.integers(0, 9))
            rows.append((g, level, float(a), b, float(2 + a - 0.5 * b + (level == "w") + rng.normal() / 3)))
    return spark.createDataFrame(rows, "g string, l string, a double, b double, y double").cache()


def test_group_regressions_match_least_squares(grouped):
    pdf = grouped.toPandas()
    got = linear.lm_group_tidy(grouped, "y", "l", ["a", "b"], ["g"]).toPandas()
    glance = {r.g: r for r in linear.lm_group_glance(grouped, "y", "l", ["a", "b"], ["g"]).collect()}
    for g, part in pdf.groupby("g"):
        x = np.column_stack([np.ones(len(part)), part.l == "v", part.l == "w", part.a, part.b]).astype(float)
        beta, rss, *_ = np.linalg.lstsq(x, part.y, rcond=None)
        se = np.sqrt(rss[0] / (len(part) - 5) * np.diag(np.linalg.inv(x.T @ x)))
        mine = got[got.g == g].set_index("term").loc[["(Intercept)", "lv", "lw", "a", "b"]]
        assert np.allclose(mine.estimate, beta) and np.allclose(mine.std_error, se)
        tss = ((part.y - part.y.mean()) ** 2).sum()
        assert math.isclose(glance[g].r_squared, 1 - rss[0] / tss) and glance[g].df == 5 and glance[g].n == 120


def test_tail_probabilities():
    # Textbook points: t(10) at 2.228139 and F(3, 20) at 3.098391 leave 5 %.
    assert math.isclose(linear.student_t_two_sided(2.2281388520, 10), 0.05, rel_tol=1e-8)
    assert math.isclose(linear.f_upper_tail(3.0983912121, 3, 20), 0.05, rel_tol=1e-7)
    assert math.isclose(linear.student_t_two_sided(0.0, 5), 1.0)


def test_out_of_fold_means(spark):
    df = spark.createDataFrame([("m", "A", 1.0), ("m", "B", 3.0), ("m", "B", 5.0), ("t", "A", 9.0)], "l string, f string, y double")
    out = {(r.l, r.f): r.prediction for r in linear.out_of_fold_means(df, "y", "l", "f").collect()}
    assert out == {("m", "A"): 4.0, ("m", "B"): 1.0, ("t", "A"): None}


def test_roc_with_ties(spark):
    data = [(1, 0.9), (1, 0.8), (0, 0.8), (0, 0.3), (1, 0.3), (0, 0.1)]
    df = spark.createDataFrame(data, "y int, s double")
    points = sorted(evaluation.roc_points(df, "y", "s").collect(), key=lambda r: -r.cutoff)
    assert [(round(r.tpr, 6), round(r.fpr, 6)) for r in points] == [
        (0.333333, 0.0), (0.666667, 0.333333), (1.0, 0.666667), (1.0, 1.0)
    ]
    wins = sum((a > b) + 0.5 * (a == b) for y, a in data if y for z, b in data if not z)
    assert math.isclose(evaluation.auc(df, "y", ["s"]).first().auc, wins / 9)
    assert evaluation.roc_cutoff(evaluation.roc_points(df, "y", "s"), 0.4).first().cutoff == 0.8


def test_scores(spark):
    df = spark.createDataFrame([("a", 0.7, 2.0), ("z", 0.6, 3.0), (None, None, 4.0)], "l string, p double, x double")
    got = df.select(scoring.align_levels("l", ["a", "b"]).alias("l"), scoring.score_threshold("p").alias("s")).collect()
    assert [tuple(r) for r in got] == [("a", "Yes"), (None, "No"), (None, None)]
    coef = spark.createDataFrame([("(Intercept)", 1.0), ("x", 2.0)], "term string, estimate double")
    assert [r.score for r in scoring.score_with_coefficients(df, coef, ["x"]).collect()] == [5.0, 7.0, 9.0]


def test_inverse_normal(spark):
    from statistics import NormalDist

    probs = [1e-300, 1e-100, 1e-20, 1e-9, 0.001, 0.07499, 0.075, 0.3, 0.5, 0.6, 0.925, 0.92501, 0.999, 1 - 1e-9]
    df = spark.createDataFrame([(p,) for p in [*probs, 0.0, 1.0, -1.0]], "p double")
    got = [r[0] for r in df.select(normal.inverse_normal(F.col("p"))).collect()]
    assert all(math.isclose(g, NormalDist().inv_cdf(p), rel_tol=1e-9, abs_tol=1e-12) for g, p in zip(got, probs)) and got[-3:] == [None] * 3


def test_qq_points_of_ties_and_few_values(spark):
    df = spark.createDataFrame([(v,) for v in [1.0, 2.0, 2.0, 2.0, 5.0, None, float("nan")]], "v double")
    rows = summaries.qq_points(df, "v").orderBy("sample").collect()
    assert [(r.sample, r.n) for r in rows] == [(1.0, 1), (2.0, 3), (5.0, 1)]
    assert np.allclose([r.p for r in rows], [(i - 0.375) / 5.25 for i in (1, 3, 5)])
    assert rows[1].theoretical == 0 and [r.bin for r in rows] == ["Low", "Low", "Hi"]
    assert summaries.qq_points(df.filter("v > 99"), "v").count() == 0
    assert summaries.outlier_flag(df.filter("v IS NULL"), "v").collect()[0].outlier is None
    assert summaries.quartile_bin(df.filter("v IS NULL"), "v").collect()[0].bin is None


@pytest.mark.parametrize("draw", ["normal", "ties", "few", "infinite"])
def test_narrowed_quantiles_equal_ranked_ones(spark, draw):
    rng = np.random.default_rng(3)
    x = {"normal": rng.normal(0, 1, 30_000), "ties": rng.integers(0, 7, 30_000) * 1.0, "few": rng.normal(0, 1, 7),
         "infinite": np.append(rng.normal(0, 1, 500), [np.inf, -np.inf])}[draw]
    df = spark.createDataFrame([(float(v), "ab"[i % 2]) for i, v in enumerate(x)], "x double, g string")
    probs = [0.0, 0.05, 0.25, 0.3333, 0.5, 0.95, 1.0]
    for keys in ([], ["g"]):
        fast = quantiles.quantiles(df, ["x"], probs, keys, narrow=True).orderBy("variable", *keys).collect()
        assert [tuple(r) for r in fast] == [tuple(r) for r in quantiles.quantiles(df, ["x"], probs, keys, narrow=False).orderBy("variable", *keys).collect()]
    if draw == "normal":
        got = quantiles.quantiles(df, ["x"], probs).first()
        assert np.allclose([got[f"q{i}"] for i in range(len(probs))], np.quantile(x, probs))
        kept, limits = quantiles.narrowed(quantiles.long_form(df, ["x"]), [0.25, 0.5])
        assert kept.count() < 2500 and len(limits) == 2 and kept.agg(F.sum("n")).first()[0] == len(x)


def test_levels_of_any_number_in_one_group(spark):
    """Fifty thousand levels in one group: slopes as from the deviations, level rows by hand."""
    n = 50_000
    df = spark.range(3 * n).select(
        F.lit("g").alias("g"), (F.col("id") % n).cast("string").alias("l"), F.sin(F.col("id") * 0.7).alias("a"),
        (1e6 + F.col("id") % n + 2 * F.sin(F.col("id") * 0.7) + F.cos(F.col("id") * 1.3)).alias("y"))
    rows = {r.term: r for r in linear.lm_group_tidy(df, "y", "l", ["a"], ["g"]).filter("term IN ('a', '(Intercept)', 'l17')").collect()}
    pdf = df.toPandas()
    x, y = pdf["a"], pdf["y"] - 1e6
    dx, dy = x - x.groupby(pdf["l"]).transform("mean"), y - y.groupby(pdf["l"]).transform("mean")
    slope = (dx * dy).sum() / (dx**2).sum()
    s2 = ((dy - slope * dx) ** 2).sum() / (3 * n - n - 1)
    assert math.isclose(rows["a"].estimate, slope, rel_tol=1e-8) and math.isclose(rows["a"].std_error, math.sqrt(s2 / (dx**2).sum()), rel_tol=1e-6)
    mean = lambda v, level: v[pdf["l"] == level].mean()
    effect = lambda level: mean(y, level) - slope * mean(x, level)
    assert math.isclose(rows["(Intercept)"].estimate - 1e6, effect("0"), rel_tol=1e-6)
    assert math.isclose(rows["l17"].estimate, effect("17") - effect("0"), rel_tol=1e-6)
    apart = mean(x, "17") - mean(x, "0")
    assert math.isclose(rows["l17"].std_error, math.sqrt(s2 * (2 / 3 + apart**2 / (dx**2).sum())), rel_tol=1e-6)


def test_bins_far_apart_do_not_fill_the_space_between(spark):
    df = spark.createDataFrame([(1.0, 0.5, 3.0), (1e9, 2.5, 5.0), (1.5, 2.5, 7.0)], "x double, y double, m double")
    cells = {(r.x, r.y): (r.m, r.Counts) for r in tables.cube_binned(df, "m", "x", "y").collect()}
    assert cells == {(1, 0): (3.0, 1), (1, 2): (7.0, 1), (10**9, 0): (None, 0), (10**9, 2): (5.0, 1)}


def test_empty_bins_between_others_are_levels_where_asked(spark):
    df = spark.createDataFrame([(-1.5, 0.5, 3.0), (1.2, 2.5, 5.0), (1.5, 2.5, 7.0), (9.0, 9.0, None)], "x double, y double, m double")
    cells = {(r.x, r.y): (r.m, r.Counts) for r in tables.cube_binned(df, "m", "x", "y", empty_bins=True).collect()}
    want = {(x, y): (None, 0) for x in range(-2, 2) for y in range(3)}
    assert cells == want | {(-2, 0): (3.0, 1), (1, 2): (6.0, 2)}
    assert not tables.cube_binned(df.limit(0), "m", "x", "y", empty_bins=True).collect()


def test_binned_cube_of_the_history_has_no_gaps(spark, sf):
    cells = {(r.SO2_MEAN, r.CO_MEAN) for r in entry.queries()["cube_binned"](spark, sf).collect()}
    full = lambda i: range(min(c[i] for c in cells), max(c[i] for c in cells) + 1)
    assert cells == {(s, c) for s in full(0) for c in full(1)}


def test_sparse_crosstab(spark):
    rows = [(f"r{i % 40}", f"c{(i * i) % 23}") for i in range(300)]
    df = spark.createDataFrame(rows, "r string, c string")
    full, seen = tables.crosstab_chisq(df, "r", "c").collect(), tables.crosstab_chisq(df, "r", "c", absent=False).collect()
    names = lambda i: sorted({x[i] for x in rows})
    observed = np.array([[sum(x == (a, b) for x in rows) for b in names(1)] for a in names(0)], float)
    e = observed.sum(1)[:, None] * observed.sum(0)[None] / observed.sum()
    assert len(full) == observed.size and len(seen) == (observed > 0).sum() < observed.size
    for r in (*full, *seen):
        assert math.isclose(r.chisq, ((observed - e) ** 2 / e).sum(), rel_tol=1e-9) and r.df == (observed.shape[0] - 1) * (observed.shape[1] - 1)
    assert math.isclose(sum(r.contribution for r in full), full[0].chisq, rel_tol=1e-9)
