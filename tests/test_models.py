"""Spark ML fits: invariants the results must meet."""

import math

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.sql import functions as F

from tallyframe.operators import models, scoring, tables
from tallyframe.plans.catalog.composites import LOAN_PREDICTORS, loan_parts
from tallyframe.sources.files import read_table


@pytest.fixture(scope="module")
def toy(spark):
    rows = [(float(i % 7), float(i % 5), "abc"[i % 3], 1.0 + 2 * (i % 7) - (i % 5) + 3 * ((i % 3) == 2)) for i in range(200)]
    return spark.createDataFrame(rows, "x double, z double, l string, y double")


def test_exact_linear_fit_and_unknown_levels(spark, toy):
    data = toy.withColumn("constant", F.lit(4.0)).withColumn("twice", 2 * F.col("x"))
    fit = models.estimate_model(
        data, "y", ["x", "z", "constant", "twice", "l"], models.linear_regression(), drop_singular=True
    )
    assert fit.names == ["x", "z", "lb", "lc"]
    b = {r.term: r.estimate for r in models.model_summary(fit, spark).collect()}
    for term, want in {"x": 2, "z": -1, "lb": 0, "lc": 3, "(Intercept)": 1}.items():
        assert math.isclose(b[term], want, abs_tol=1e-8)
    new = spark.createDataFrame(
        [(1.0, 1.0, "c", 4.0, 2.0), (1.0, 1.0, "q", 4.0, 2.0), (None, 1.0, "a", 4.0, 2.0)],
        "x double, z double, l string, constant double, twice double",
    )
    scored = fit.transform(new).collect()
    assert math.isclose(scored[0].prediction, 5.0, abs_tol=1e-8)
    assert [r.prediction for r in scored[1:]] == [None, None]
    assert [tuple(r) for r in models.unknown_levels(fit, new).collect()] == [("l", "q", 1)]


def test_absorbed_levels_predict_like_dummies(spark, toy, tmp_path):
    noisy = toy.withColumn("y", F.col("y") + F.sin(F.col("x") * 3 + F.col("z")))
    dummies = models.estimate_model(noisy, "y", ["x", "z", "l"], models.linear_regression())
    absorbed = models.estimate_model(noisy, "y", ["x", "z"], models.linear_regression(), absorb="l")
    a = {(r.x, r.z, r.l): r.prediction for r in dummies.transform(noisy).collect()}
    for r in absorbed.transform(noisy).collect():
        assert math.isclose(a[r.x, r.z, r.l], r.prediction, abs_tol=1e-8)
    se = lambda f: {r.term: r.std_error for r in models.model_summary(f, spark).collect()}
    full, part = se(dummies), se(absorbed)
    assert set(part) == {"x", "z", "l_a", "l_b", "l_c"}
    assert all(math.isclose(part[t], full[t], rel_tol=1e-8) for t in ("x", "z"))
    # Level rows against least squares with one dummy per level and no intercept.
    rows = noisy.collect()
    design = np.array([[r.x, r.z, *[float(r.l == v) for v in "abc"]] for r in rows])
    y = np.array([r.y for r in rows])
    beta = np.linalg.solve(design.T @ design, design.T @ y)
    sigma2 = ((y - design @ beta) ** 2).sum() / (len(y) - 5)
    want = dict(zip(("x", "z", "l_a", "l_b", "l_c"), zip(beta, np.sqrt(sigma2 * np.diag(np.linalg.inv(design.T @ design))))))
    for r in models.model_summary(absorbed, spark).collect():
        assert math.isclose(r.estimate, want[r.term][0], rel_tol=1e-8) and math.isclose(r.std_error, want[r.term][1], rel_tol=1e-7)
        assert math.isclose(r.statistic, r.estimate / r.std_error, rel_tol=1e-9) and 0 <= r.p_value <= 1
    models.model_store(absorbed, "absorbed", f"{tmp_path}/registry", spark)
    again = models.model_load(f"{tmp_path}/registry", "absorbed", spark)
    new = noisy.limit(1).withColumn("l", F.lit("unseen")).unionByName(noisy.filter("l = 'a'").limit(1))
    assert sorted(r.prediction is None for r in again.transform(new).collect()) == [False, True]


def test_predictions_equal_the_coefficient_table(spark, sf):
    parts = loan_parts(spark, sf)
    fit = models.estimate_model(parts["train"], "ccDebt", ["creditScore", "houseAge"], models.linear_regression())
    coef = models.model_summary(fit, spark).select("term", "estimate")
    both = scoring.score_with_coefficients(fit.transform(parts["validate"]), coef, ["creditScore", "houseAge"])
    worst = both.agg(F.max(F.abs(F.col("score") - F.col("prediction")))).first()[0]
    assert worst < 1e-6


def test_logistic_score_equations(spark, sf):
    """At the maximum the residuals are orthogonal to every predictor."""
    train = loan_parts(spark, sf)["train"]
    fit = models.estimate_model(train, "default", LOAN_PREDICTORS, models.generalized("binomial"))
    resid = fit.transform(train).withColumn("e", F.col("default") - F.col("prediction"))
    for c in LOAN_PREDICTORS:
        r = resid.agg(F.sum(F.col("e") * F.col(c)), F.sum(F.abs(F.col("e") * F.col(c)))).first()
        assert abs(r[0]) < 1e-5 * r[1]


def test_class_probabilities_sum_to_one(spark, toy):
    fit = models.estimate_model(
        toy, "l", ["x", "z", "y"], DecisionTreeClassifier(minInstancesPerNode=10, seed=1), response_levels=list("abc"), one_hot=False
    )
    p = fit.transform(toy).select(*models.class_probabilities(list("abc")))
    assert p.columns == ["pred_a", "pred_b", "pred_c"]
    assert p.agg(F.max(F.abs(F.col("pred_a") + F.col("pred_b") + F.col("pred_c") - 1))).first()[0] < 1e-12
    assert "y" in " ".join(r.rule for r in models.tree_rules(fit, spark).collect())


def test_tree_with_many_levels(spark):
    df = spark.range(400).select((F.col("id") % 2).cast("double").alias("y"), (F.col("id") % 50).cast("string").alias("l"))
    fit = models.estimate_model(df, "y", ["l"], DecisionTreeClassifier(seed=1), one_hot=False)
    assert fit.transform(df).filter("prediction <> y").isEmpty()


def test_stored_model_scores_alike(spark, toy, tmp_path):
    fit = models.estimate_model(toy, "y", ["x", "l"], models.linear_regression(), products=[("x", "z")])
    listing = models.model_store(fit, "toy", f"{tmp_path}/registry", spark)
    assert [r.Model_Name for r in listing.collect()] == ["toy"]
    models.model_store(fit, "second", f"{tmp_path}/registry", spark)
    listing = models.model_store(fit, "toy", f"{tmp_path}/registry", spark)
    assert sorted(r.Model_Name for r in listing.collect()) == ["second", "toy"]
    again = models.model_load(f"{tmp_path}/registry", "toy", spark)
    a = [r.prediction for r in fit.transform(toy).collect()]
    assert a == [r.prediction for r in again.transform(toy).collect()]
    with pytest.raises(KeyError):
        models.model_load(f"{tmp_path}/registry", "other", spark)


def test_cluster_cost_falls(spark, sf):
    points = read_table(spark, sf, "embeddings")
    centres = models.mean_vectors(points, "embedding", "label").select(F.col("label").alias("cluster"), "centre")
    costs = []
    for _ in range(3):
        step = models.kmeans_step(points, "embedding", centres)
        costs.append(step.agg(F.sum("within_ss")).first()[0])
        centres = step.select("cluster", "centre")
    assert costs[0] >= costs[1] >= costs[2]


def plain_lloyd(x, centres, iterations):
    for _ in range(iterations):
        near = ((x[:, None] - centres[None]) ** 2).sum(2).argmin(1)
        centres = np.array([x[near == c].mean(0) if (near == c).any() else centres[c] for c in range(len(centres))])
    return ((x[:, None] - centres[None]) ** 2).sum(2).min(1).sum()


def test_all_starts_at_once_equal_plain_starts(spark, sf):
    points = read_table(spark, sf, "embeddings").limit(200).cache()
    x = np.array([r[0] for r in points.select("embedding").collect()], float)
    best, table = models.kmeans_multistart(points, "embedding", 4, runs=2, starts=3, iterations=6, seed=5)
    vectors = points.select(F.col("embedding").cast("array<double>").alias("embedding"))
    want = [plain_lloyd(x, c, 6) for run in range(2) for c in models.start_centres(vectors, "embedding", 4, 3, 5 + run)]
    got = [r.within_ss for r in table.orderBy("run", "start").collect()]
    assert np.allclose(got, want) and len(set(np.round(got, 6))) > 1
    cost = models.kmeans_step(points, "embedding", best).agg(F.sum("within_ss")).first()[0]
    assert math.isclose(cost, min(want), rel_tol=1e-9)
    with pytest.raises(ValueError):
        models.kmeans_multistart(points.limit(3), "embedding", 4, runs=1, starts=1)


def test_a_hundred_thousand_levels(spark):
    """Fits and tables take any number of levels; a level the fit has not met keeps its row."""
    df = spark.range(200_000).select((F.col("id") % 100_000).cast("string").alias("l"), (F.col("id") % 2).cast("string").alias("s"),
                                     (F.col("id") % 100_000 + F.when(F.col("id") < 100_000, 1.0).otherwise(-1.0)).alias("y"))
    fit = models.estimate_model(df, "y", ["s"], models.linear_regression(), absorb="l")
    assert fit.effects.count() == 100_000
    tree = models.estimate_model(df.filter("l < 5000"), "y", ["s", "l"], models.linear_regression())
    assert len(tree.design.levels["l"]) > 4000
    odd = spark.createDataFrame([("7", "1"), ("new", "1"), (None, "0")], "l string, s string")
    assert [r.prediction is None for r in tree.transform(odd).collect()] == [False, True, True]
    assert tables.table_long(df, "l", "s").count() == 100_000
