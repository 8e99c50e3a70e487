"""Spark ML fits driven by column lists, with results as tables."""

from __future__ import annotations

import datetime as dt
import json
import re
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, replace
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import OneHotEncoder, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GeneralizedLinearRegression, LinearRegression
from pyspark.ml.stat import Correlation, Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.functions.nulls import is_in
from tallyframe.operators.formula import with_products
from tallyframe.operators.linear import quadratic_form, student_p, student_t_two_sided
from tallyframe.operators.tables import levels_of
from tallyframe.session import ensure_checkpoints, materialize, scratch_path
from tallyframe.sources.published import PublishedTable


@dataclass
class Design:
    """The columns a model reads: numeric ones, level columns with their levels, and products.

    Level columns are indexed by sorted level; the first level is the base. A
    row is scorable when its numeric inputs are present and its levels known;
    other rows keep their place and get a missing prediction. Levels are looked
    up in a dictionary, so a column may have as many as the model has room for.
    """

    numeric: list[str]
    levels: dict[str, list[str]]
    products: list[tuple[str, ...]]
    one_hot: bool

    @property
    def names(self) -> list[str]:
        """One name per entry of the feature vector."""
        out = list(self.numeric)
        for c, levels in self.levels.items():
            out += [f"{c}{v}" for v in levels[1:]] if self.one_hot else [c]
        return out

    def prepare(self, df: DataFrame) -> DataFrame:
        """Add the model's input columns and the ``_scorable`` flag."""
        df = with_products(df, self.products)
        ok, inputs = F.lit(True), {}
        for c in self.numeric:
            value = F.col(c).cast("double")
            inputs[f"{c}__in"] = F.coalesce(value, F.lit(0.0))
            ok = ok & value.isNotNull()
        for c, levels in self.levels.items():
            # The encoder leaves out the last index, so the base level goes there.
            order = levels[1:] + levels[:1] if self.one_hot else levels
            look_up = StringIndexerModel.from_labels(order, inputCol=f"{c}__text", outputCol=f"{c}__found", handleInvalid="keep")
            df = look_up.transform(df.withColumn(f"{c}__text", F.col(c).cast("string")))
            known = F.col(f"{c}__found") < len(levels)
            inputs[f"{c}__index"] = F.when(known, F.col(f"{c}__found")).otherwise(0.0)
            ok = ok & known
        df = df.withColumns(inputs | {"_scorable": ok}).drop(*[f"{c}__{x}" for c in self.levels for x in ("text", "found")])
        for c, levels in self.levels.items():
            df = df.withMetadata(f"{c}__index", {"ml_attr": {"type": "nominal", "num_vals": len(levels), "name": f"{c}__index"}})
        return df

    def stages(self) -> list:
        stages, inputs = [], [f"{c}__in" for c in self.numeric]
        for c in self.levels:
            inputs.append(f"{c}__index")
            if self.one_hot:
                stages.append(OneHotEncoder(inputCol=f"{c}__index", outputCol=f"{c}__dummies", dropLast=True))
                inputs[-1] = f"{c}__dummies"
        return [*stages, VectorAssembler(inputCols=inputs, outputCol="features")]


@dataclass
class Fit:
    """A fitted model and the design it reads."""

    pipeline: PipelineModel
    design: Design
    # For an absorbed level column: its name, and a table of its levels' effects.
    absorb: str | None = None
    effects: DataFrame | None = None
    # The inverse of the deviations' sums of products, for the errors of the levels' effects.
    inverse: list[list[float]] | None = None

    @property
    def model(self) -> Model:
        return self.pipeline.stages[-1]

    @property
    def names(self) -> list[str]:
        return self.design.names

    def transform(self, df: DataFrame) -> DataFrame:
        """The rows with the model's output columns; no row is dropped."""
        prepared = self.design.prepare(df)
        if self.absorb:
            effect = self.effects.select(F.col("level").alias("_level"), "effect")
            prepared = prepared.join(effect, F.col(self.absorb).cast("string") == F.col("_level"), "left")
        scored = self.pipeline.transform(prepared)
        if self.absorb:
            # A level without an effect was not seen: its prediction stays missing.
            scored = scored.withColumn("prediction", F.col("prediction") + F.col("effect"))
        outputs = [c for c in ("prediction", "probability", "rawPrediction") if c in scored.columns]
        return scored.select(
            *df.columns, *[F.when(F.col("_scorable"), F.col(c)).alias(c) for c in outputs]
        )


def boosted_chances(fit: Fit, df: DataFrame, rounds: Sequence[int], names: Sequence[str]) -> DataFrame:
    """A boosted classifier's chance of the second class after each of some numbers of rounds, from one fit.

    After n rounds the score is the weighted sum of the first n trees, and the chance its logistic at twice the score.
    """
    scored = fit.pipeline.transform(fit.design.prepare(df))
    trees, weights = fit.model.trees, fit.model.treeWeights
    for i in range(max(rounds)):
        scored = trees[i].setPredictionCol(f"_tree_{i}").transform(scored)
    score = lambda n: reduce(lambda a, b: a + b, [F.col(f"_tree_{i}") * float(weights[i]) for i in range(n)])
    chance = lambda n: F.when(F.col("_scorable"), 1 / (1 + F.exp(-2 * score(n))))
    return scored.select(*df.columns, *[chance(n).alias(name) for n, name in zip(rounds, names)])


def unknown_levels(fit: Fit, df: DataFrame) -> DataFrame:
    """Levels of the data that the model has not seen: column, level, rows."""
    text = [
        F.struct(F.lit(c).alias("column"), F.when(~is_in(F.col(c).cast("string"), v), F.col(c).cast("string")).alias("level"))
        for c, v in fit.design.levels.items()
    ]
    return (
        df.select(F.inline(F.array(*text)))
        .filter(F.col("level").isNotNull())
        .groupBy("column", "level")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def independent_columns(df: DataFrame, cols: Sequence[str]) -> list[str]:
    """Columns that vary and are no linear combination of the columns before them.

    One pass gives the k × k correlations; columns are then taken in turn while
    the smallest eigenvalue stays away from zero.
    """
    if not cols:
        return []
    spread = df.agg(*[(F.max(c) - F.min(c)).cast("double").alias(f"c{i}") for i, c in enumerate(cols)]).first()
    varying = [c for i, c in enumerate(cols) if spread[f"c{i}"]]
    if not varying:
        return []
    data = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(varying)])
    vectors = VectorAssembler(inputCols=data.columns, outputCol="v").transform(data)
    r = Correlation.corr(vectors, "v").first()[0].toArray()
    kept: list[int] = []
    for i in range(len(varying)):
        trial = [*kept, i]
        if np.linalg.eigvalsh(r[np.ix_(trial, trial)])[0] > 1e-9:
            kept.append(i)
    return [varying[i] for i in kept]


def estimate_model(
    df: DataFrame,
    response: str,
    predictors: Sequence[str],
    estimator: Estimator,
    products: Sequence[tuple[str, ...]] = (),
    levels: dict[str, Sequence[str]] | None = None,
    one_hot: bool = True,
    response_levels: Sequence[str] | None = None,
    drop_singular: bool = False,
    absorb: str | None = None,
) -> Fit:
    """Fit any Spark ML estimator of ``response`` on ``predictors`` and product terms.

    Text predictors become level columns, with the levels found in the data
    unless ``levels`` declares them. ``response_levels`` turns a text response
    into a class index. Rows with a missing value in any used column are left
    out. ``drop_singular`` first removes constant and collinear predictors,
    without which normal equations give no standard errors.

    ``absorb`` names a level column with more levels than dummies could hold
    (linear fits only). Least squares with one dummy per level equals least
    squares on the deviations from each level's means, so the levels are
    averaged, the deviations fitted without an intercept, and the levels'
    effects kept as a table that never leaves the executors.
    """
    declared = dict(levels or {})
    is_text = lambda c: c in declared or isinstance(df.schema[c].dataType, T.StringType)
    text = [c for c in predictors if is_text(c)]
    numeric = [c for c in predictors if c not in text]
    crossed = ["_x_".join(t) for t in products]
    label = F.col(response).cast("double")
    if response_levels is not None:
        place = F.array_position(F.array(*[F.lit(v) for v in response_levels]), F.col(response).cast("string"))
        label = F.when(place > 0, place - 1).cast("double")
    extra = [F.col(absorb).cast("string").alias("_level")] if absorb else []
    data = with_products(df, products).select(label.alias("label"), *numeric, *crossed, *text, *extra).dropna()
    # The fit reads these rows many times; executors keep or spill their share.
    data.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        found = {c: list(declared.get(c) or levels_of(data, c)) for c in text}
        if drop_singular:
            found = {c: v for c, v in found.items() if len(v) > 1}
            kept = independent_columns(data, [*numeric, *crossed])
        else:
            kept = [*numeric, *crossed]
        design = Design(kept, found, [t for t in products if "_x_".join(t) in kept], one_hot)
        # Products are columns of `data` already; only the inputs are prepared here.
        ready = replace(design, products=[]).prepare(data)
        encode = Pipeline(stages=design.stages()).fit(ready)
        points = encode.transform(ready.filter("_scorable")).select("label", "features", *(["_level"] if absorb else []))
        columns = {estimator.labelCol: "label", estimator.featuresCol: "features"}
        if estimator.hasParam("maxBins") and not one_hot:
            # A tree needs a bin for every level it may split on.
            most = max((len(v) for v in found.values()), default=0)
            columns[estimator.maxBins] = max(most, estimator.getOrDefault("maxBins"))
        ensure_checkpoints(df.sparkSession)
        effects = inverse = None
        if absorb:
            means = materialize(level_means(points), "level-means")
            apart = deviations(points, means)
            fitted = estimator.copy(columns | {estimator.fitIntercept: False}).fit(apart)
            effects = materialize(level_effects(means, fitted.coefficients.toArray().tolist()), "level-effects")
            inverse = np.linalg.pinv(sums_of_products(apart), rcond=1e-14, hermitian=True).tolist()
        else:
            # Other estimators keep their own form of the points between iterations; this one does not.
            rereads = isinstance(estimator, GeneralizedLinearRegression)
            if rereads:
                points.persist(StorageLevel.MEMORY_AND_DISK)
            try:
                fitted = estimator.copy(columns).fit(points)
            finally:
                if rereads:
                    points.unpersist()
    finally:
        data.unpersist()
    return Fit(PipelineModel([*encode.stages, fitted]), design, absorb, effects, inverse)


def level_means(points: DataFrame) -> DataFrame:
    """Rows, mean label and mean features per level, combined map-side."""
    return points.groupBy("_level").agg(
        F.count(F.lit(1)).alias("_n"), F.avg("label").alias("_label"), vector_to_array(Summarizer.mean(F.col("features"))).alias("_features")
    )


def deviations(points: DataFrame, means: DataFrame) -> DataFrame:
    """Label and features minus their level's means."""
    apart = F.zip_with(vector_to_array("features"), "_features", lambda x, m: x - m)
    return points.join(means, "_level").select(
        (F.col("label") - F.col("_label")).alias("label"), array_to_vector(apart).alias("features")
    )


def level_effects(means: DataFrame, coefficients: Sequence[float]) -> DataFrame:
    """What the coefficients leave of each level's mean label; its rows and mean features."""
    betas = F.array(*[F.lit(float(b)) for b in coefficients])
    explained = F.aggregate(F.zip_with("_features", betas, lambda x, b: x * b), F.lit(0.0), lambda s, x: s + x)
    return means.select(F.col("_level").alias("level"), (F.col("_label") - explained).alias("effect"), F.col("_n").alias("n"), F.col("_features").alias("means"))


def sums_of_products(deviations: DataFrame) -> np.ndarray:
    """X'X of features that average to zero, as wide as there are terms: from their correlations and deviations, one pass each."""
    spread = deviations.agg(Summarizer.metrics("std", "count").summary(F.col("features")).alias("s")).select("s.std", "s.count").first()
    sd = spread["std"].toArray()
    r = Correlation.corr(deviations, "features").first()[0].toArray()
    return np.nan_to_num(r) * np.outer(sd, sd) * (spread["count"] - 1)


def linear_regression() -> LinearRegression:
    """Least squares by normal equations: one pass up to 4096 terms, then by iteration."""
    return LinearRegression(solver="auto", regParam=0.0)


def generalized(family: str, link: str | None = None) -> GeneralizedLinearRegression:
    glm = GeneralizedLinearRegression(family=family, maxIter=50)
    return glm.setLink(link) if link else glm


def model_summary(fit: Fit, spark: SparkSession) -> DataFrame:
    """Coefficient table of a linear or generalized linear fit."""
    m, s = fit.model, fit.model.summary
    estimates = [*m.coefficients.toArray().tolist(), m.intercept]
    names = [*fit.names, "(Intercept)"]
    if fit.absorb:
        estimates, names = estimates[:-1], names[:-1]
    try:
        errors, t, p = s.coefficientStandardErrors, s.tValues, s.pValues
        if fit.absorb:
            # The absorbed levels use up degrees of freedom the fit does not know of.
            left = s.degreesOfFreedom - fit.effects.count()
            grow = (s.degreesOfFreedom / left) ** 0.5 if left > 0 else float("nan")
            errors = [e * grow for e in errors]
            t = [v / grow for v in t]
            p = [student_t_two_sided(v, left) for v in t]
    except Exception as e:
        if "No Std. Error" not in str(e):  # the summary's own refusal: this solver computes none
            raise
        errors = t = p = [None] * len(names)
    rows = [(n, float(b), *[None if v is None else float(v) for v in r]) for n, b, *r in zip(names, estimates, errors, t, p)]
    table = spark.createDataFrame(rows, "term string, estimate double, std_error double, statistic double, p_value double")
    if not fit.absorb:
        return table
    levels = fit.effects.select(F.concat(F.lit(f"{fit.absorb}_"), F.col("level")).alias("term"), F.col("effect").alias("estimate"), "n", "means")
    if fit.inverse is None or errors[0] is None:
        return table.unionByName(levels.drop("n", "means"), allowMissingColumns=True)
    # A level's effect is its mean label less the slopes times its mean features: both parts vary.
    sigma2 = s.meanSquaredError * s.numInstances / left if left > 0 else float("nan")
    matrix = F.array(*[F.array(*[F.lit(float(v)) for v in line]) for line in fit.inverse])
    levels = levels.withColumn("std_error", F.sqrt(F.lit(sigma2) * (1 / F.col("n") + quadratic_form(F.col("means"), matrix))))
    levels = levels.withColumn("statistic", F.try_divide("estimate", "std_error")).withColumn("p_value", student_p(F.col("statistic"), F.lit(left)))
    return table.unionByName(levels.drop("n", "means"))


def fit_measures(fit: Fit, spark: SparkSession) -> DataFrame:
    """Whole-fit measures of a linear or generalized linear fit, one row per measure."""
    s = fit.model.summary
    wanted = (
        ["r2", "r2adj", "rootMeanSquaredError", "degreesOfFreedom", "numInstances"]
        if hasattr(s, "r2")
        else ["aic", "deviance", "nullDeviance", "dispersion", "residualDegreeOfFreedom", "numInstances"]
    )
    return spark.createDataFrame([(m, float(getattr(s, m))) for m in wanted], "measure string, value double")


def importance(fit: Fit, spark: SparkSession) -> DataFrame:
    """Feature importances of a tree model as a table."""
    values = fit.model.featureImportances.toArray().tolist()
    return spark.createDataFrame(list(zip(fit.names, map(float, values))), "feature string, importance double")


def tree_rules(fit: Fit, spark: SparkSession) -> DataFrame:
    """The lines of a fitted tree, with feature names, in order."""
    text = re.sub(r"feature (\d+)", lambda m: fit.names[int(m[1])], fit.model.toDebugString)
    lines = [(i, line) for i, line in enumerate(text.splitlines()) if line.strip()]
    return spark.createDataFrame(lines, "line bigint, rule string")


def class_probabilities(levels: Sequence[str], prefix: str = "pred_", col: str = "probability") -> list[Column]:
    """One probability column per class level."""
    p = vector_to_array(F.col(col))
    return [p[i].alias(f"{prefix}{v}") for i, v in enumerate(levels)]


def kmeans_fit(df: DataFrame, vector: str, k: int, seed: int = 1, iterations: int = 20):
    """Clusters of an array column: the fitted model."""
    points = df.select(array_to_vector(F.col(vector).cast("array<double>")).alias("features"))
    points.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return KMeans(k=k, seed=seed, maxIter=iterations).fit(points)
    finally:
        points.unpersist()


#: Points that starts are drawn from: those with the smallest hashes, at most so many.
START_SAMPLE = 10_000


def start_centres(points: DataFrame, vector: str, k: int, count: int, seed: int, sample: int = START_SAMPLE) -> np.ndarray:
    """``count`` sets of ``k`` different points each, drawn from a bounded sample that does not depend on the partitions."""
    order = F.xxhash64(F.lit(seed), F.col(vector))
    rows = points.select(vector, order.alias("_order")).orderBy("_order", vector).limit(max(sample, 2 * k)).collect()
    pool = np.unique(np.array([r[0] for r in rows], float), axis=0)
    if len(pool) < k:
        raise ValueError(f"{len(pool)} different points for {k} clusters")
    draw = np.random.default_rng(seed)
    return np.stack([pool[draw.choice(len(pool), k, replace=False)] for _ in range(count)])


def assigned(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre and the squared distance to it, of every point for every set of centres: (sets, points) each."""
    sets, k, width = centres.shape
    cross = (points @ centres.reshape(-1, width).T).reshape(len(points), sets, k)
    squares = (points**2).sum(1)[:, None, None] - 2 * cross + (centres**2).sum(2)[None]
    nearest = squares.argmin(2)
    return nearest.T, np.maximum(np.take_along_axis(squares, nearest[:, :, None], 2)[:, :, 0], 0.0).T


def lloyd_round(points: DataFrame, vector: str, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One round of all sets of centres at once: counts (sets, k), sums (sets, k, width), within squares (sets).

    A task sums over its points; the sums of a set meet in one row per task, and only they leave the executors.
    """
    sets, k, width = centres.shape
    shared = points.sparkSession.sparkContext.broadcast(centres)  # sets x k x width numbers, all of them parameters

    def partial(batches):
        mine, state = shared.value, np.zeros((sets, k * (width + 1) + 1))
        for batch in batches:
            for at in range(0, len(batch), 1024):
                x = np.array(batch[vector].iloc[at : at + 1024].tolist(), float).reshape(-1, width)
                nearest, squares = assigned(x, mine)
                for i in range(sets):
                    member = np.zeros((k, len(x)))
                    member[nearest[i], np.arange(len(x))] = 1.0
                    state[i, :k] += member.sum(1)
                    state[i, k:-1] += (member @ x).ravel()
                    state[i, -1] += squares[i].sum()
        yield pd.DataFrame({"one": range(sets), "state": [line.tobytes() for line in state]})

    def merged(rows: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(x) for x in rows["state"]], axis=0)
        return pd.DataFrame({"one": rows["one"].iloc[:1], "state": [total.tobytes()]})

    schema = "one int, state binary"
    rows = points.select(vector).mapInPandas(partial, schema).groupBy("one").applyInPandas(merged, schema).collect()
    shared.unpersist()
    state = np.stack([np.frombuffer(r["state"]) for r in sorted(rows, key=lambda r: r["one"])])
    return state[:, :k], state[:, k:-1].reshape(sets, k, width), state[:, -1]


def kmeans_multistart(
    df: DataFrame, vector: str, k: int, runs: int = 8, starts: int = 50, iterations: int = 35, seed: int = 1, tolerance: float = 1e-9
) -> tuple[DataFrame, DataFrame]:
    """``runs`` times ``starts`` random starts of at most ``iterations`` rounds; the best by within-cluster sum of squares.

    All starts are one state and every round one pass over the points, which the executors keep meanwhile; starts
    whose centres rest take no further part. Returns the best centres (``cluster``, ``centre``) and a table of
    ``run``, ``start``, ``rounds`` and ``within_ss``. A cluster that loses all its points keeps its centre.
    """
    points = df.select(F.col(vector).cast("array<double>").alias(vector)).filter(F.col(vector).isNotNull())
    points.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        centres = np.concatenate([start_centres(points, vector, k, starts, seed + run) for run in range(runs)])
        cost, rounds, moving = np.zeros(len(centres)), np.zeros(len(centres), int), np.arange(len(centres))
        for _ in range(iterations):
            counts, sums, _ = lloyd_round(points, vector, centres[moving])
            means = np.where(counts[:, :, None] > 0, sums / np.maximum(counts, 1)[:, :, None], centres[moving])
            shift = ((means - centres[moving]) ** 2).sum((1, 2))
            centres[moving], rounds[moving] = means, rounds[moving] + 1
            moving = moving[shift > tolerance]
            if not len(moving):
                break
        cost = lloyd_round(points, vector, centres)[2]
    finally:
        points.unpersist()
    spark = df.sparkSession
    table = [(i // starts + 1, i % starts + 1, int(n), float(c)) for i, (n, c) in enumerate(zip(rounds, cost, strict=True))]
    best = [(i, c.tolist()) for i, c in enumerate(centres[int(cost.argmin())])]
    return (
        spark.createDataFrame(best, "cluster bigint, centre array<double>"),
        spark.createDataFrame(table, "run bigint, start bigint, rounds bigint, within_ss double"),
    )


def cluster_points(model, df: DataFrame, vector: str) -> DataFrame:
    """The rows with the ``cluster`` of their vector."""
    placed = model.transform(df.withColumn("features", array_to_vector(F.col(vector).cast("array<double>"))))
    return placed.withColumn("cluster", F.col("prediction").cast("bigint")).drop("features", "prediction")


def cluster_table(model, df: DataFrame, vector: str) -> DataFrame:
    """Size and within sum of squares per cluster, with its centre."""
    points = df.select(array_to_vector(F.col(vector).cast("array<double>")).alias("features"))
    centres = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    table = df.sparkSession.createDataFrame(centres, "prediction int, centre array<double>")
    distance = F.aggregate(
        F.zip_with(vector_to_array("features"), "centre", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x
    )
    # One row per cluster, as many as were asked for.
    return (
        model.transform(points)
        .join(F.broadcast(table), "prediction")
        .groupBy(F.col("prediction").cast("bigint").alias("cluster"))
        .agg(F.count(F.lit(1)).alias("size"), F.sum(distance).alias("within_ss"), F.first("centre").alias("centre"))
    )


def mean_vectors(df: DataFrame, vector: str, key: str) -> DataFrame:
    """Mean of an array column per group, combined map-side: ``key``, ``size``, ``centre``."""
    v = array_to_vector(F.col(vector).cast("array<double>"))
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("size"), vector_to_array(Summarizer.mean(v)).alias("centre")
    )


def kmeans_step(df: DataFrame, vector: str, centres: DataFrame) -> DataFrame:
    """One round from given centres (``cluster``, ``centre``): assign each point to the nearest, average.

    The centres are packed into one value that every row carries, so points meet centres without a join.
    """
    packed = centres.agg(F.sort_array(F.collect_list(F.struct("cluster", "centre"))).alias("all")).scalar()
    point = F.col(vector).cast("array<double>")
    distance = lambda c: F.aggregate(
        F.zip_with(point, c["centre"], lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x
    )
    nearest = F.array_min(F.transform("_centres", lambda c: F.struct(distance(c).alias("d"), c["cluster"].alias("cluster"))))
    assigned = df.withColumn("_centres", packed).withColumn("_near", nearest).select(
        vector, F.col("_near.cluster").alias("cluster"), F.col("_near.d").alias("d")
    )
    v = array_to_vector(F.col(vector).cast("array<double>"))
    return assigned.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("size"), F.sum("d").alias("within_ss"), vector_to_array(Summarizer.mean(v)).alias("centre")
    )


STORED = (
    "Model_Name string, created date, Model array<struct<path:string,content:binary>>, design string, absorb string, "
    "effects array<struct<level:string,effect:double,n:bigint,means:array<double>>>, inverse array<array<double>>"
)


def model_store(fit: Fit, name: str, registry: str, spark: SparkSession) -> DataFrame:
    """Keep a fitted model in one row of the registry table, and return the registry.

    The row holds the model's files, its design and the effects of absorbed levels, so it scores by itself. The
    registry is published as a whole: readers see either the old row of that name or the new one.
    """
    path = scratch_path(spark, "model")
    fit.pipeline.write().save(path)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    inside = F.concat(F.lit("/"), F.element_at(F.split("path", path.rsplit("/", 1)[1] + "/"), -1))
    packed = files.agg(F.collect_list(F.struct(inside.alias("path"), "content")).alias("Model"))
    entry = spark.createDataFrame([(name, dt.date.today(), json.dumps(asdict(fit.design)), fit.absorb, fit.inverse)],
                                  "Model_Name string, created date, design string, absorb string, inverse array<array<double>>")
    effects = fit.effects.agg(F.collect_list(F.struct("level", "effect", "n", "means"))).scalar() if fit.absorb else F.lit(None)
    fields = T.StructType.fromDDL(STORED)
    row = entry.withColumns({"Model": packed.scalar(), "effects": effects}).select(*[F.col(f.name).cast(f.dataType) for f in fields])
    table = PublishedTable(spark, registry)
    if not table.commits().isEmpty():
        row = table.read().filter(F.col("Model_Name") != name).unionByName(row)
    return table.publish(row.repartition(1), uuid.uuid4().hex)


def model_load(registry: str, name: str, spark: SparkSession) -> Fit:
    """Load the stored model of that name from its row."""
    row = PublishedTable(spark, registry).read().filter(F.col("Model_Name") == name).first()
    if row is None:
        raise KeyError(name)
    path = scratch_path(spark, "model")
    for part in row["Model"]:
        target = spark._jvm.org.apache.hadoop.fs.Path(path + part["path"])
        out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
        out.write(part["content"])
        out.close()
    d = json.loads(row["design"])
    design = Design(d["numeric"], d["levels"], [tuple(t) for t in d["products"]], d["one_hot"])
    effects = spark.createDataFrame(row["effects"], T.StructType.fromDDL(STORED)["effects"].dataType.elementType) if row["absorb"] else None
    return Fit(PipelineModel.load(path), design, row["absorb"], effects, row["inverse"])
