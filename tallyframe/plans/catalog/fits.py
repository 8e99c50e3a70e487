"""Registered queries: linear models from sums, Spark ML fits, scoring, model storage."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from tallyframe.functions.keys import RANGE, key_hash_sql
from tallyframe.operators import formula, linear, models, scoring, splits
from tallyframe.operators.tables import levels_of
from tallyframe.plans import air_quality as aq
from tallyframe.plans.bases import LONG_DAYS, MEANS, TRIP_KEY, air, loans, read_table, subs
from tallyframe.plans.catalog.aggregates import trips_with_share
from tallyframe.plans.catalog.composites import (
    FLAG_LEVELS,
    LOAN_PREDICTORS,
    STATION_USERS,
    default_probability,
    history,
    loan_parts,
)
from tallyframe.plans.catalog.selection import raw_pollution
from tallyframe.plans.catalog.shape import tidy
from tallyframe.plans.registry import query
from tallyframe.session import materialize, scratch_path
from tallyframe.sources import files, sinks

# --- least squares from sums ---------------------------------------------------------------


@query(
    "lm_simple",
    """
SELECT round(regr_slope(ave_tip, ave_dist), 9) AS slope, round(regr_intercept(ave_tip, ave_dist), 9) AS intercept,
       round(regr_r2(ave_tip, ave_dist), 9) AS r_squared, count(*) AS n
FROM (SELECT avg(tip_pct) AS ave_tip, avg(trip_distance) AS ave_dist FROM trips GROUP BY dropoff_nhood, pickup_nhood)
""",
    "trips",
)
def lm_simple(spark, sf):
    df = trips_with_share(spark, sf, "dropoff_nhood", "pickup_nhood", "trip_distance")
    means = df.groupBy("dropoff_nhood", "pickup_nhood").agg(
        F.avg("tip_pct").alias("ave_tip"), F.avg("trip_distance").alias("ave_dist")
    )
    return tidy(linear.lm_simple(means, "ave_tip", "ave_dist"), 9)


@query(
    "lm_per_group",
    """
SELECT pickup_nhood, round(regr_slope(tip_amount, trip_distance), 6) AS slope,
       round(regr_intercept(tip_amount, trip_distance), 6) AS intercept,
       round(regr_r2(tip_amount, trip_distance), 6) AS r_squared, regr_count(tip_amount, trip_distance)::BIGINT AS n
FROM trips GROUP BY pickup_nhood
""",
    "trips",
)
def lm_per_group(spark, sf):
    df = trips_with_share(spark, sf, "pickup_nhood", "trip_distance")
    return tidy(linear.lm_simple(df, "tip_amount", "trip_distance", ["pickup_nhood"]))


# The same regressions in SQL: slopes of a and b come from the sums of squares within the levels (what a
# level column leaves over), level terms from the level means. y = tip_amount, a = passenger_count, b = pickup_hour.
GROUP_FIT_SQL = """
WITH d AS (SELECT dropoff_dow AS g, pickup_nhood AS l, tip_amount AS y, CAST(passenger_count AS DOUBLE) AS a,
           CAST(pickup_hour AS DOUBLE) AS b FROM trips),
lev AS (SELECT g, l, count(*) AS n, avg(y) AS y, avg(a) AS a, avg(b) AS b FROM d GROUP BY 1, 2),
s AS (SELECT d.g, sum((d.a - v.a) * (d.a - v.a)) AS aa, sum((d.a - v.a) * (d.b - v.b)) AS ab,
      sum((d.b - v.b) * (d.b - v.b)) AS bb, sum((d.a - v.a) * (d.y - v.y)) AS ay, sum((d.b - v.b) * (d.y - v.y)) AS bys,
      sum((d.y - v.y) * (d.y - v.y)) AS yy, count(*) AS n, count(DISTINCT d.l) AS k
      FROM d JOIN lev v ON d.g = v.g AND d.l = v.l GROUP BY d.g),
f AS (SELECT *, (bb * ay - ab * bys) / (aa * bb - ab * ab) AS ba, (aa * bys - ab * ay) / (aa * bb - ab * ab) AS b2,
      aa * bb - ab * ab AS det FROM s),
r AS (SELECT *, yy - ba * ay - b2 * bys AS rss, n - k - 2 AS dof FROM f),
base AS (SELECT g, min(l) AS l0 FROM lev GROUP BY g),
b0 AS (SELECT v.* FROM lev v JOIN base ON v.g = base.g AND v.l = base.l0),
"""
QUAD = "({x} * {x} * r.bb - 2 * {x} * {z} * r.ab + {z} * {z} * r.aa) / r.det"


@query(
    "lm_group_tidy",
    GROUP_FIT_SQL
    + f"""
t AS (
 SELECT r.g, 'passenger_count' AS term, ba AS e, sqrt(rss / dof * bb / det) AS se FROM r
 UNION ALL SELECT r.g, 'pickup_hour', b2, sqrt(rss / dof * aa / det) FROM r
 UNION ALL SELECT r.g, '(Intercept)', b0.y - ba * b0.a - b2 * b0.b,
   sqrt(rss / dof * (1 / b0.n + {QUAD.format(x='b0.a', z='b0.b')})) FROM r JOIN b0 ON r.g = b0.g
 UNION ALL SELECT r.g, 'pickup_nhood' || v.l, (v.y - b0.y) - ba * (v.a - b0.a) - b2 * (v.b - b0.b),
   sqrt(rss / dof * (1 / v.n + 1 / b0.n + {QUAD.format(x='(v.a - b0.a)', z='(v.b - b0.b)')}))
   FROM r JOIN b0 ON r.g = b0.g JOIN lev v ON r.g = v.g WHERE v.l <> b0.l)
SELECT g AS dropoff_dow, term, round(e, 4) AS estimate, round(se, 4) AS std_error, round(e / se, 5) AS statistic FROM t
""",
    "trips",
)
def lm_group_tidy(spark, sf):
    df = trips_with_share(spark, sf, "dropoff_dow", "pickup_nhood", "passenger_count", "pickup_hour")
    fit = linear.lm_group_tidy(df, "tip_amount", "pickup_nhood", ["passenger_count", "pickup_hour"], ["dropoff_dow"])
    # p-values need the t distribution, which SQL lacks; see lm_group_tidy_p.
    return tidy(fit.drop("p_value"), 4, statistic=5)


@query("lm_group_tidy_p")
def lm_group_tidy_p(spark, sf):
    df = trips_with_share(spark, sf, "dropoff_dow", "pickup_nhood", "passenger_count", "pickup_hour")
    return tidy(linear.lm_group_tidy(df, "tip_amount", "pickup_nhood", ["passenger_count", "pickup_hour"], ["dropoff_dow"]))


@query(
    "lm_group_glance",
    GROUP_FIT_SQL
    + """
tot AS (SELECT g, var_pop(y) * count(*) AS tss FROM d GROUP BY g),
q AS (SELECT r.g, n, k + 2 AS p, dof, rss, tss, -n / 2 * (ln(2 * pi()) + ln(rss / n) + 1) AS ll FROM r JOIN tot ON r.g = tot.g)
SELECT g AS dropoff_dow, round(1 - rss / tss, 6) AS r_squared, round(1 - rss / tss * (n - 1) / dof, 6) AS adj_r_squared,
       round(sqrt(rss / dof), 4) AS sigma, round((tss - rss) / (p - 1) / (rss / dof), 5) AS f_statistic, p AS df,
       round(-2 * ll + 2 * (p + 1), 3) AS aic, round(-2 * ll + ln(n) * (p + 1), 3) AS bic, n FROM q
""",
    "trips",
)
def lm_group_glance(spark, sf):
    df = trips_with_share(spark, sf, "dropoff_dow", "pickup_nhood", "passenger_count", "pickup_hour")
    fit = linear.lm_group_glance(df, "tip_amount", "pickup_nhood", ["passenger_count", "pickup_hour"], ["dropoff_dow"])
    return tidy(fit.drop("p_value"), 6, sigma=4, f_statistic=5, aic=3, bic=3)


LINE_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_GRAM = ["1", *LINE_MEASURES]


@query(
    "gram_matrix",
    " UNION ALL ".join(
        f"SELECT '{a}' AS x, '{b}' AS y, round(sum({'1.0::DOUBLE' if a == '1' else a} * {'1.0::DOUBLE' if b == '1' else b}) "
        f"/ count(*), 4) AS mean_product FROM lineitem"
        for i, a in enumerate(_GRAM)
        for b in _GRAM[i:]
    ),
)
def gram_matrix(spark, sf):
    # Shown per row, because sums of this size differ between engines in their last digits.
    gram = linear.gram_matrix(read_table(spark, sf, "lineitem"), LINE_MEASURES)
    n = gram.filter("x = '1' AND y = '1'").select("value").scalar()
    return tidy(gram.select("x", "y", (F.col("value") / n).alias("mean_product")), 4)


@query(
    "lm_factor",
    """
WITH g AS (SELECT DayOfWeek AS l, count(*) AS n, avg(ArrDelay) AS m, var_pop(ArrDelay) AS v FROM air GROUP BY 1),
s AS (SELECT sum(n * v) / (sum(n) - count(*)) AS s2 FROM g), b AS (SELECT m AS bm, n AS bn FROM g WHERE l = 'Monday')
SELECT CASE WHEN l = 'Monday' THEN '(Intercept)' ELSE 'DayOfWeek' || l END AS term,
       round(CASE WHEN l = 'Monday' THEN m ELSE m - bm END, 6) AS estimate,
       round(sqrt(s2 * CASE WHEN l = 'Monday' THEN 1 / n ELSE 1 / n + 1 / bn END), 6) AS std_error FROM g, s, b
""",
    "air",
)
def lm_factor(spark, sf):
    return tidy(linear.lm_factor(air(spark, sf, "ArrDelay", "DayOfWeek"), "ArrDelay", "DayOfWeek", LONG_DAYS[0]))


@query(
    "lm_factor_fit",
    """
WITH g AS (SELECT DayOfWeek AS l, avg(ArrDelay) AS m FROM air GROUP BY 1)
SELECT CASE WHEN l = 'Monday' THEN '(Intercept)' ELSE 'DayOfWeek' || l END AS term,
       round(CASE WHEN l = 'Monday' THEN m ELSE m - (SELECT m FROM g WHERE l = 'Monday') END, 4) AS estimate FROM g
""",
    "air",
)
def lm_factor_fit(spark, sf):
    """The same regression through the general fit, with declared levels."""
    df = air(spark, sf, "ArrDelay", "DayOfWeek")
    fit = models.estimate_model(df, "ArrDelay", ["DayOfWeek"], models.linear_regression(), levels={"DayOfWeek": LONG_DAYS})
    return tidy(models.model_summary(fit, spark).select("term", "estimate"), 4)


# --- model terms ---------------------------------------------------------------------------

INTERACT = ["SO2_MEAN", "O3_MEAN", "CO_MEAN"]
_TERMS = [("O3_MEAN", "SO2_MEAN"), ("O3_MEAN", "CO_MEAN"), ("SO2_MEAN", "CO_MEAN")]


@query(
    "interaction_features",
    "SELECT SITE_NUM, DATE, "
    + ", ".join(f"round({c}, 6) AS {c}" for c in INTERACT)
    + ", "
    + ", ".join(f"round({a} * {b}, 7) AS {a}_x_{b}" for a, b in _TERMS)
    + " FROM pollution",
    "pollution",
)
def interaction_features(spark, sf):
    df = raw_pollution(spark, sf).select("SITE_NUM", "DATE", *MEANS)
    terms = formula.model_terms(df.columns, "NO2_MEAN", MEANS, ["SITE_NUM", "DATE"])
    wide = formula.with_products(df, terms)
    names = ["_x_".join(t) for t in terms]
    return tidy(wide.select("SITE_NUM", "DATE", *names), 6, **{n: 7 for n in names if "_x_" in n})


@query("lm_interactions")
def lm_interactions(spark, sf):
    past = materialize(history(spark, sf, STATION_USERS), "history")
    fit = aq.fit_pollutants(past, ["NO2_MEAN"])["NO2_MEAN"]
    return tidy(models.model_summary(fit, spark))


# --- generalized linear models -------------------------------------------------------------


@query("logit")
def logit(spark, sf):
    train = loan_parts(spark, sf)["train"]
    fit = models.estimate_model(train, "default", LOAN_PREDICTORS, models.generalized("binomial"))
    return tidy(models.model_summary(fit, spark), 9)


@query("glm_poisson")
def glm_poisson(spark, sf):
    df = subs(spark, sf, "UniqueProducts", "TotalSales", "FavCategory", "Subscription")
    scaled = df.withColumn("Thousands", F.col("TotalSales") / 1000)
    fit = models.estimate_model(
        scaled, "UniqueProducts", ["Thousands", "Subscription", "FavCategory"], models.generalized("poisson")
    )
    return tidy(models.model_summary(fit, spark), 6)


LOAN_NUMBERS = ["creditScore", "houseAge", "yearsEmploy", "ccDebt"]


@query(
    "logit_score_equations",
    " UNION ALL ".join(
        f"SELECT '{x}' AS term, round(CAST(sum({x} * \"default\") AS DOUBLE) / sum(abs({x})), 6) AS weighted_share FROM loans "
        f"WHERE {key_hash_sql('o_orderkey')} < {int(0.75 * RANGE)}"
        for x in LOAN_NUMBERS
    ),
    "loans",
)
def logit_score_equations(spark, sf):
    """A logistic fit with an intercept gives each predictor the same weighted sum over fitted chances as over outcomes."""
    train = loan_parts(spark, sf)["train"]
    fit = models.estimate_model(train, "default", LOAN_NUMBERS, models.generalized("binomial").setTol(1e-10))
    sums = fit.transform(train).agg(*[(F.sum(F.col(x) * F.col("prediction")) / F.sum(F.abs(x))).alias(x) for x in LOAN_NUMBERS])
    return tidy(sums.select(F.inline(F.array(*[F.struct(F.lit(x).alias("term"), F.col(x).alias("weighted_share")) for x in LOAN_NUMBERS]))))


@query(
    "poisson_score_equations",
    """
SELECT FavCategory, round(CAST(sum(UniqueProducts) AS DOUBLE) / count(*), 6) AS mean_fitted FROM subs GROUP BY 1
""",
    "subs",
)
def poisson_score_equations(spark, sf):
    """A Poisson fit with a level for each category gives each category its mean count."""
    df = subs(spark, sf, "UniqueProducts", "TotalSales", "FavCategory", "Subscription").withColumn("Thousands", F.col("TotalSales") / 1000)
    fit = models.estimate_model(df, "UniqueProducts", ["Thousands", "Subscription", "FavCategory"], models.generalized("poisson").setTol(1e-10))
    return tidy(fit.transform(df).groupBy("FavCategory").agg(F.avg("prediction").alias("mean_fitted")))


@query(
    "logit_factor",
    """
WITH g AS (SELECT DayOfWeek AS l, count(*) FILTER (ArrDelay > 10) AS a, count(*) FILTER (ArrDelay <= 10) AS b FROM air GROUP BY 1),
m AS (SELECT ln(a / b) AS base, 1 / a + 1 / b AS v FROM g WHERE l = 'Monday')
SELECT CASE WHEN l = 'Monday' THEN '(Intercept)' ELSE 'DayOfWeek' || l END AS term,
       round(CASE WHEN l = 'Monday' THEN base ELSE ln(a / b) - base END, 5) AS estimate,
       round(sqrt(CASE WHEN l = 'Monday' THEN v ELSE 1 / a + 1 / b + v END), 5) AS std_error FROM g, m
""",
    "air",
)
def logit_factor(spark, sf):
    """Chance of a delay beyond 10 by weekday; one level column makes the estimates differences of log odds."""
    df = air(spark, sf, "ArrDelay", "DayOfWeek").select((F.col("ArrDelay") > 10).cast("double").alias("late"), "DayOfWeek")
    fit = models.estimate_model(df, "late", ["DayOfWeek"], models.generalized("binomial"), levels={"DayOfWeek": LONG_DAYS})
    return tidy(models.model_summary(fit, spark).select("term", "estimate", "std_error"), 5)


@query(
    "glm_poisson_factor",
    """
WITH g AS (SELECT FavCategory AS l, sum(UniqueProducts) AS s, count(*) AS n FROM subs GROUP BY 1),
m AS (SELECT ln(s / n) AS base, 1 / s AS v, l AS l0 FROM g WHERE l = (SELECT min(l) FROM g))
SELECT CASE WHEN l = l0 THEN '(Intercept)' ELSE 'FavCategory' || l END AS term,
       round(CASE WHEN l = l0 THEN base ELSE ln(s / n) - base END, 5) AS estimate,
       round(sqrt(CASE WHEN l = l0 THEN v ELSE 1 / s + v END), 5) AS std_error FROM g, m
""",
    "subs",
)
def glm_poisson_factor(spark, sf):
    """Counts by level: the estimates are differences of log means."""
    fit = models.estimate_model(
        subs(spark, sf, "UniqueProducts", "FavCategory"), "UniqueProducts", ["FavCategory"], models.generalized("poisson")
    )
    return tidy(models.model_summary(fit, spark).select("term", "estimate", "std_error"), 5)


@query(
    "model_summary",
    """
WITH v AS (SELECT DayOfWeek AS l, avg(ArrDelay) AS y, avg(CRSDepTime) AS x FROM air GROUP BY 1),
s AS (SELECT sum((CRSDepTime - x) * (CRSDepTime - x)) AS xx, sum((CRSDepTime - x) * (ArrDelay - y)) AS xy,
      sum((ArrDelay - y) * (ArrDelay - y)) AS yy, var_pop(ArrDelay) * count(*) AS tss, count(*) AS n
      FROM air JOIN v ON DayOfWeek = l),
f AS (SELECT yy - xy * xy / xx AS rss, tss, n, n - 8 AS dof FROM s)
SELECT unnest(['r2', 'r2adj', 'rootMeanSquaredError', 'degreesOfFreedom', 'numInstances']) AS measure,
       round(unnest([1 - rss / tss, 1 - rss / tss * (n - 1) / dof, sqrt(rss / n), CAST(dof AS DOUBLE), CAST(n AS DOUBLE)]), 6) AS value
FROM f
""",
    "air",
)
def model_summary(spark, sf):
    """Fit measures of a linear fit."""
    df = air(spark, sf, "ArrDelay", "CRSDepTime", "DayOfWeek")
    fit = models.estimate_model(
        df, "ArrDelay", ["CRSDepTime", "DayOfWeek"], models.linear_regression(), levels={"DayOfWeek": LONG_DAYS}
    )
    return tidy(models.fit_measures(fit, spark))


@query(
    "estimate_model",
    " UNION ALL ".join(
        f"SELECT '{name}' AS name, count(*) AS n, round(avg(\"default\"), 6) AS mean_prediction FROM loans "
        f"WHERE {key_hash_sql('o_orderkey')} < {int(0.75 * RANGE)}"
        for name in ("logit", "linear", "tree")
    ),
    "loans",
)
def estimate_model(spark, sf):
    """One call with data, terms and estimator, for three estimators.

    Each of them predicts the share of defaults right on average over the rows it was fitted on.
    """
    train = loan_parts(spark, sf)["train"]
    fits = {
        "logit": models.estimate_model(train, "default", LOAN_PREDICTORS, models.generalized("binomial")),
        "linear": models.estimate_model(train, "default", LOAN_PREDICTORS, models.linear_regression()),
        "tree": models.estimate_model(
            train, "default_flag", LOAN_PREDICTORS, DecisionTreeClassifier(seed=1), response_levels=FLAG_LEVELS, one_hot=False
        ),
    }
    scored = [
        fit.transform(train).agg(
            F.lit(name).alias("name"), F.count("*").alias("n"), F.avg(default_probability(fit)).alias("mean_prediction")
        )
        for name, fit in fits.items()
    ]
    return tidy(reduce(lambda a, b: a.unionByName(b), scored))


# --- trees ---------------------------------------------------------------------------------


def _tree(train):
    return models.estimate_model(
        train, "default_flag", LOAN_PREDICTORS, DecisionTreeClassifier(minInstancesPerNode=10, seed=1),
        response_levels=FLAG_LEVELS, one_hot=False,
    )


@query("tree_classify")
def tree_classify(spark, sf):
    return models.tree_rules(_tree(loan_parts(spark, sf)["train"]), spark)


@query("tree_regress")
def tree_regress(spark, sf):
    parts = loan_parts(spark, sf)
    names = formula.predictors(parts["train"].columns, "ccDebt", ["default_flag", "trainvalidate", "o_orderkey"])
    fit = models.estimate_model(parts["train"], "ccDebt", names, DecisionTreeRegressor(seed=1), one_hot=False)
    scored = fit.transform(parts["validate"])
    return tidy(scored.select("o_orderkey", "ccDebt", "prediction"))


@query("tree_multiclass")
def tree_multiclass(spark, sf):
    df = loans(spark, sf).withColumn("year", F.col("year").cast("string"))
    years = levels_of(df, "year")
    fit = models.estimate_model(
        df, "year", ["creditScore", "houseAge", "yearsEmploy", "ccDebt"], DecisionTreeClassifier(minInstancesPerNode=10, seed=1),
        response_levels=years, one_hot=False,
    )
    return tidy(fit.transform(df).select("o_orderkey", *models.class_probabilities(years)))


@query(
    "tree_multiclass_totals",
    "SELECT CAST(year AS VARCHAR) AS year, round(CAST(count(*) AS DOUBLE), 6) AS expected_rows FROM loans GROUP BY 1",
    "loans",
)
def tree_multiclass_totals(spark, sf):
    """Over the rows of the fit, each level's probabilities add up to its number of rows."""
    df = loans(spark, sf).withColumn("year", F.col("year").cast("string"))
    years = levels_of(df, "year")
    fit = models.estimate_model(
        df, "year", ["creditScore", "houseAge", "yearsEmploy", "ccDebt"], DecisionTreeClassifier(minInstancesPerNode=10, seed=1),
        response_levels=years, one_hot=False,
    )
    sums = fit.transform(df).agg(*[F.sum(c).alias(y) for y, c in zip(years, _probabilities(years))])
    cells = [F.struct(F.lit(y).alias("year"), F.col(f"`{y}`").alias("expected_rows")) for y in years]
    return tidy(sums.select(F.inline(F.array(*cells))))


def _probabilities(levels):
    p = vector_to_array("probability")
    return [p[i] for i in range(len(levels))]


@query("forest")
def forest(spark, sf):
    parts = loan_parts(spark, sf)
    fit = models.estimate_model(
        parts["train"], "default_flag", LOAN_PREDICTORS, RandomForestClassifier(numTrees=100, seed=1),
        response_levels=FLAG_LEVELS, one_hot=False,
    )
    return tidy(models.importance(fit, spark))


@query("boosted_trees")
def boosted_trees(spark, sf):
    """Probability after all 100 rounds and after the first 10, from one fit."""
    parts = loan_parts(spark, sf)
    fit = models.estimate_model(
        parts["train"], "default_flag", LOAN_PREDICTORS, GBTClassifier(maxIter=100, maxDepth=1, stepSize=0.1, seed=1),
        response_levels=FLAG_LEVELS, one_hot=False,
    )
    df = parts["validate"].select("o_orderkey", *LOAN_PREDICTORS)
    early = models.boosted_chances(fit, df, [10], ["pred_gbm_first10"])
    out = fit.transform(early).select("o_orderkey", vector_to_array("probability")[1].alias("pred_gbm_default"), "pred_gbm_first10")
    return tidy(out)


# --- clusters ------------------------------------------------------------------------------


@query(
    "kmeans_step",
    """
WITH p AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
c AS (SELECT label AS cluster, i, avg(x) AS c FROM p GROUP BY 1, 2),
d AS (SELECT vec_id, cluster, sum((x - c) * (x - c)) AS d FROM p JOIN c ON p.i = c.i GROUP BY 1, 2),
a AS (SELECT vec_id, arg_min(cluster, d) AS cluster, min(d) AS d FROM d GROUP BY 1),
s AS (SELECT cluster, count(*) AS size, sum(d) AS within_ss FROM a GROUP BY 1)
SELECT CAST(s.cluster AS BIGINT) AS cluster, any_value(size) AS size, round(any_value(within_ss), 6) AS within_ss,
       CAST(p.i AS BIGINT) AS dim, round(avg(x), 7) AS centre
FROM a JOIN p ON a.vec_id = p.vec_id JOIN s ON a.cluster = s.cluster GROUP BY s.cluster, p.i
""",
)
def kmeans_step(spark, sf):
    """One round from the ten label means."""
    points = read_table(spark, sf, "embeddings")
    centres = models.mean_vectors(points, "embedding", "label").select(F.col("label").alias("cluster"), "centre")
    step = models.kmeans_step(points, "embedding", centres)
    long = step.select("cluster", "size", "within_ss", F.posexplode("centre").alias("dim", "centre"))
    return tidy(long.withColumn("dim", F.col("dim") + 1), 6, centre=7)


@query("kmeans")
def kmeans(spark, sf):
    points = read_table(spark, sf, "embeddings")
    model = models.kmeans_fit(points, "embedding", 10)
    return tidy(models.cluster_table(model, points, "embedding").select("cluster", "size", "within_ss"))


@query(
    "kmeans_decomposition",
    """
SELECT CAST(max(n) AS BIGINT) AS n, round(sum(ss), 6) AS total_ss FROM (
  SELECT d, count(*) AS n, var_pop(x) * count(*) AS ss FROM (
    SELECT unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS d FROM embeddings) GROUP BY d)
""",
)
def kmeans_decomposition(spark, sf):
    """Clusters leave no point out, and squares within and between them add up to all squares."""
    points = read_table(spark, sf, "embeddings")
    model = models.kmeans_fit(points, "embedding", 10)
    placed = models.cluster_points(model, points, "embedding").select("vec_id", "cluster", F.posexplode("embedding").alias("d", "x"))
    x = F.col("x").cast("double")
    cells = placed.groupBy("cluster", "d").agg(F.count(x).alias("n"), F.avg(x).alias("mean"), (F.var_pop(x) * F.count(x)).alias("within"))
    centres = placed.groupBy("d").agg(F.avg(x).alias("centre"))
    parts = cells.join(centres, "d").agg(
        F.sum(F.col("within") + F.col("n") * F.pow(F.col("mean") - F.col("centre"), 2)).alias("total_ss"),
        (F.sum("n") / F.countDistinct("d")).cast("bigint").alias("n"),
    )
    return tidy(parts.select("n", "total_ss"))


@query(
    "kmeans_multistart",
    """
SELECT r AS run, s AS start, true AS settled, true AS below_total, true AS best_reproduced
FROM range(1, 9) a(r), range(1, 51) b(s)
""",
)
def kmeans_multistart(spark, sf):
    """Eight runs of fifty starts. SQL can state how many there are, that their cost is below the total sum of squares,
    and that the best centres' cost is found again by a plain round from them."""
    points = read_table(spark, sf, "embeddings")
    best, costs = models.kmeans_multistart(points, "embedding", 10)
    again = models.kmeans_step(points, "embedding", best).agg(F.sum("within_ss")).scalar()
    x = F.col("x").cast("double")
    total = points.select(F.posexplode("embedding").alias("d", "x")).groupBy("d").agg((F.var_pop(x) * F.count(x)).alias("ss")).agg(F.sum("ss")).scalar()
    least = costs.agg(F.min("within_ss")).scalar()
    return costs.select(
        "run", "start", (F.col("rounds") <= 35).alias("settled"), (F.col("within_ss") < total).alias("below_total"),
        (F.abs(least - again) <= 1e-6 * least).alias("best_reproduced"))


# --- cross-validation ----------------------------------------------------------------------

FOLD = f"chr(CAST(65 + ({key_hash_sql('l_orderkey')}) * 10 // {RANGE} AS INTEGER))"


@query(
    "cross_validate",
    f"""
WITH f AS (SELECT *, {FOLD} AS fold FROM air), t AS (SELECT DayOfWeek, fold, sum(ArrDelay) AS s, count(*) AS n FROM f GROUP BY 1, 2)
SELECT {', '.join(TRIP_KEY)}, f.fold, ArrDelay, round((SELECT sum(s) / sum(n) FROM t
  WHERE t.DayOfWeek = f.DayOfWeek AND t.fold <> f.fold), 6) AS ArrDelay_kFold_Pred FROM f
""",
    "air",
)
def cross_validate(spark, sf):
    """Ten folds of a regression on the weekday; every row is predicted by the fit on the other folds."""
    df = air(spark, sf, *TRIP_KEY, "DayOfWeek", "ArrDelay").withColumn("fold", splits.fold_label("l_orderkey"))
    means = linear.out_of_fold_means(df, "ArrDelay", "DayOfWeek", "fold")
    # Levels × folds rows: the optimizer sees their size and broadcasts them.
    predicted = df.join(means.select("DayOfWeek", "fold", "prediction"), ["DayOfWeek", "fold"], "left")
    return tidy(predicted.withColumnRenamed("prediction", "ArrDelay_kFold_Pred").drop("DayOfWeek"))


@query(
    "cross_validate_general",
    f"""
WITH f AS (SELECT ArrDelay AS y, CRSDepTime AS x, DayOfWeek AS l, {FOLD} AS fold FROM air),
k AS (SELECT DISTINCT fold AS held FROM f),
v AS (SELECT held, l, avg(y) AS my, avg(x) AS mx FROM f, k WHERE fold <> held GROUP BY 1, 2),
b AS (SELECT f2.held, sum((x - mx) * (y - my)) / sum((x - mx) * (x - mx)) AS b
      FROM (SELECT * FROM f, k WHERE fold <> held) f2 JOIN v ON f2.held = v.held AND f2.l = v.l GROUP BY f2.held)
SELECT fold, count(*) AS n, round(sqrt(avg(pow(y - (my + b * (x - mx)), 2))), 4) AS rmse
FROM f JOIN v ON f.fold = v.held AND f.l = v.l JOIN b ON f.fold = b.held GROUP BY fold
""",
    "air",
)
def cross_validate_general(spark, sf):
    """The same loop for any estimator: fit on nine folds, score the tenth."""
    df = air(spark, sf, "l_orderkey", "ArrDelay", "CRSDepTime", "DayOfWeek").withColumn("fold", splits.fold_label("l_orderkey"))
    # One folder per fold: fitting and scoring read only the folders they need.
    path = scratch_path(spark, "folds")
    sinks.write_split(df, "fold", path)
    df = spark.read.schema(df.schema).parquet(path)
    errors = []
    for fold in "ABCDEFGHIJ":
        fit = models.estimate_model(
            df.filter(F.col("fold") != fold), "ArrDelay", ["CRSDepTime", "DayOfWeek"], models.linear_regression(),
            levels={"DayOfWeek": LONG_DAYS},
        )
        held_out = fit.transform(df.filter(F.col("fold") == fold))
        errors.append(
            held_out.groupBy("fold").agg(
                F.count("*").alias("n"), F.sqrt(F.avg(F.pow(F.col("ArrDelay") - F.col("prediction"), 2))).alias("rmse")
            )
        )
    return tidy(reduce(lambda a, b: a.unionByName(b), errors), 4)


# --- scoring -------------------------------------------------------------------------------


@query("score_keep_vars")
def score_keep_vars(spark, sf):
    """Probability and link scale under chosen names, beside the model's inputs and the key."""
    parts = loan_parts(spark, sf)
    fit = models.estimate_model(parts["train"], "default", LOAN_PREDICTORS, models.generalized("binomial"))
    p = F.col("prediction")
    return tidy(
        scoring.score_keep(
            fit, parts["validate"], ["o_orderkey", *LOAN_PREDICTORS],
            [p.alias("pred_logit_default"), (F.log(p) - F.log1p(-p)).alias("link_logit_default")],
        )
    )


@query("attach_scores")
def attach_scores(spark, sf):
    parts = loan_parts(spark, sf)
    scored = _tree(parts["train"]).transform(parts["validate"])
    return tidy(scored.select("o_orderkey", "default_flag", *models.class_probabilities(FLAG_LEVELS, "pred_tree_")))


@query(
    "score_coef_table",
    f"""
WITH c AS (SELECT regr_slope(tip_amount, trip_distance) AS b, regr_intercept(tip_amount, trip_distance) AS a FROM trips)
SELECT {', '.join(TRIP_KEY)}, round(a + b * trip_distance, 6) AS score FROM trips, c
""",
    "trips",
)
def score_coef_table(spark, sf):
    df = trips_with_share(spark, sf, *TRIP_KEY, "trip_distance")
    fit = linear.lm_simple(df, "tip_amount", "trip_distance")
    pairs = F.array(
        F.struct(F.lit("(Intercept)").alias("term"), F.col("intercept").alias("estimate")),
        F.struct(F.lit("trip_distance").alias("term"), F.col("slope").alias("estimate")),
    )
    coefficients = fit.select(F.inline(pairs))
    return tidy(scoring.score_with_coefficients(df, coefficients, ["trip_distance"]).select(*TRIP_KEY, "score"))


@query("score_chain")
def score_chain(spark, sf):
    past = materialize(history(spark, sf, STATION_USERS), "history")
    fits = aq.fit_pollutants(past)
    chained = scoring.score_chain(
        aq.as_levels(past), {m.replace("MEAN", "PRED"): f for m, f in fits.items()}, ["DIM_ADDRESS_KEY", "DIM_DATE_KEY"]
    )
    return tidy(chained)


@query("score_csv")
def score_csv(spark, sf):
    """A tree fitted on the stored table scores rows read from a CSV file."""
    parts = loan_parts(spark, sf)
    fit = models.estimate_model(parts["train"], "ccDebt", ["creditScore", "houseAge", "yearsEmploy", "year"], DecisionTreeRegressor(seed=1), one_hot=False)
    path = scratch_path(spark, "loans-csv")
    columns = ["o_orderkey", "creditScore", "houseAge", "yearsEmploy", "ccDebt", "year"]
    sinks.write_csv(parts["validate"].select(*columns), path)
    schema = "o_orderkey bigint, creditScore double, houseAge bigint, yearsEmploy bigint, ccDebt double, year bigint"
    return tidy(fit.transform(files.read_csv(spark, path, schema)).select("o_orderkey", "ccDebt", "prediction"))


# --- model storage -------------------------------------------------------------------------


def _stored(spark, sf):
    past = materialize(history(spark, sf, STATION_USERS), "history")
    registry = scratch_path(spark, "registry")
    fit = aq.fit_pollutants(past, ["CO_MEAN"])["CO_MEAN"]
    return past, fit, registry, models.model_store(fit, "CO_MODEL", registry, spark)


@query("model_store")
def model_store(spark, sf):
    listing = _stored(spark, sf)[3]
    return listing.select("Model_Name", F.size("Model").cast("bigint").alias("files"), F.length("design").cast("bigint").alias("design_length"))


@query(
    "model_load_score",
    "SELECT DIM_ADDRESS_KEY, count(*) AS n, 0.0::DOUBLE AS off, 0::BIGINT AS changed FROM projection_wide GROUP BY 1",
    "projection_wide",
)
def model_load_score(spark, sf):
    """Scores of the stored model, kept in a table; per station the rows and what differs from the scores of the model that was stored."""
    past, fit, registry, _ = _stored(spark, sf)
    future = materialize(aq.as_levels(aq.project(past)), "projection")
    score = lambda f, into: f.transform(future).select(
        F.col("DIM_ADDRESS_KEY").cast("bigint").alias("DIM_ADDRESS_KEY"), F.col("DIM_DATE_KEY").cast("bigint").alias("DIM_DATE_KEY"), F.bround("prediction", 3).alias(into))
    loaded = score(models.model_load(registry, "CO_MODEL", spark), "CO_MEAN")
    kept = sinks.recreate_table(tidy(loaded), sinks.own_name("Predictions_US_Pollution_CO"), scratch_path(spark, "predictions"))
    both = kept.join(score(fit, "fresh"), ["DIM_ADDRESS_KEY", "DIM_DATE_KEY"])
    off = F.abs(F.coalesce(F.sum("CO_MEAN"), F.lit(0.0)) - F.coalesce(F.sum("fresh"), F.lit(0.0)))
    changed = F.count(F.when(~F.col("CO_MEAN").eqNullSafe(F.col("fresh")), 1))
    return tidy(both.groupBy("DIM_ADDRESS_KEY").agg(F.count("*").alias("n"), off.alias("off"), changed.alias("changed")))


# --- what SQL can state of fits it cannot make ------------------------------------------------

_HASH = key_hash_sql("o_orderkey")
_TRAIN, _VALIDATE = f"{_HASH} < {int(0.75 * RANGE)}", f"{_HASH} >= {int(0.75 * RANGE)}"
_FLAG = "CASE WHEN \"default\" = 1 THEN 'default' ELSE 'current' END"


def _proper(*chances):
    """Whether all chances lie between 0 and 1."""
    return reduce(lambda a, b: a & b, [F.col(c).between(0.0, 1.0) for c in chances])


@query("tree_classify_totals", f"SELECT {_FLAG} AS default_flag, CAST(count(*) AS DOUBLE) AS expected_rows FROM loans WHERE {_TRAIN} GROUP BY 1", "loans")
def tree_classify_totals(spark, sf):
    """Over the rows of the fit, each class's chances add up to its number of rows."""
    train = loan_parts(spark, sf)["train"]
    sums = _tree(train).transform(train).agg(*[F.sum(c).alias(v) for v, c in zip(FLAG_LEVELS, _probabilities(FLAG_LEVELS))])
    return tidy(sums.select(F.inline(F.array(*[F.struct(F.lit(v).alias("default_flag"), F.col(v).alias("expected_rows")) for v in FLAG_LEVELS]))))


@query("tree_regress_totals", f"SELECT count(*) AS n, round(avg(ccDebt), 4) AS mean_prediction FROM loans WHERE {_TRAIN}", "loans")
def tree_regress_totals(spark, sf):
    """Over the rows of the fit, leaf means average to the response's mean."""
    train = loan_parts(spark, sf)["train"]
    fit = models.estimate_model(train, "ccDebt", ["creditScore", "houseAge", "yearsEmploy", "year"], DecisionTreeRegressor(seed=1), one_hot=False)
    return tidy(fit.transform(train).agg(F.count("prediction").alias("n"), F.avg("prediction").alias("mean_prediction")), 4)


@query("attach_scores_rows", f"SELECT o_orderkey, {_FLAG} AS default_flag, true AS proper, true AS whole FROM loans WHERE {_VALIDATE}", "loans")
def attach_scores_rows(spark, sf):
    """Every held-out row is scored once, its chances are proper and add up to one."""
    scored = attach_scores(spark, sf)
    whole = F.abs(F.col("pred_tree_current") + F.col("pred_tree_default") - 1) < 1e-5
    return scored.select("o_orderkey", "default_flag", _proper("pred_tree_current", "pred_tree_default").alias("proper"), whole.alias("whole"))


@query("forest_rows", f"SELECT o_orderkey, true AS proper FROM loans WHERE {_VALIDATE}", "loans")
def forest_rows(spark, sf):
    """Every held-out row is scored by a forest."""
    parts = loan_parts(spark, sf)
    fit = models.estimate_model(
        parts["train"], "default_flag", LOAN_PREDICTORS, RandomForestClassifier(numTrees=20, seed=1), response_levels=FLAG_LEVELS, one_hot=False)
    scored = fit.transform(parts["validate"]).select("o_orderkey", vector_to_array("probability")[1].alias("p"))
    return scored.select("o_orderkey", _proper("p").alias("proper"))


@query("boosted_trees_rows", f"SELECT o_orderkey, true AS proper FROM loans WHERE {_VALIDATE}", "loans")
def boosted_trees_rows(spark, sf):
    return boosted_trees(spark, sf).select("o_orderkey", _proper("pred_gbm_default", "pred_gbm_first10").alias("proper"))


@query(
    "score_keep_vars_rows",
    f"SELECT o_orderkey, {', '.join(f'round({c}, 6) AS {c}' if c in ('creditScore', 'ccDebt') else c for c in LOAN_PREDICTORS)}, true AS proper, true AS linked FROM loans WHERE {_VALIDATE}",
    "loans",
)
def score_keep_vars_rows(spark, sf):
    """The kept inputs are the table's, and the link is the score's logit."""
    scored = score_keep_vars(spark, sf)
    back = F.abs(1 / (1 + F.exp(-F.col("link_logit_default"))) - F.col("pred_logit_default")) < 1e-5
    return scored.select("o_orderkey", *LOAN_PREDICTORS, _proper("pred_logit_default").alias("proper"), back.alias("linked"))


@query("score_csv_rows", f"SELECT o_orderkey, round(ccDebt, 6) AS ccDebt, true AS same FROM loans WHERE {_VALIDATE}", "loans")
def score_csv_rows(spark, sf):
    """Rows read from a CSV file score as the stored ones do."""
    parts = loan_parts(spark, sf)
    fit = models.estimate_model(parts["train"], "ccDebt", ["creditScore", "houseAge", "yearsEmploy", "year"], DecisionTreeRegressor(seed=1), one_hot=False)
    stored = tidy(fit.transform(parts["validate"]).select("o_orderkey", F.col("prediction").alias("stored")))
    return score_csv(spark, sf).join(stored, "o_orderkey").select("o_orderkey", "ccDebt", (F.abs(F.col("prediction") - F.col("stored")) < 1e-3).alias("same"))


@query("score_chain_rows", "SELECT DIM_ADDRESS_KEY, count(*) AS n, true AS same FROM history_wide GROUP BY 1", "history_wide")
def score_chain_rows(spark, sf):
    """A chain of models gives each row what the models give it one by one."""
    past = materialize(aq.as_levels(history(spark, sf, STATION_USERS)), "history")
    fits = aq.fit_pollutants(past, ["NO2_MEAN", "CO_MEAN"])
    keys = ["DIM_ADDRESS_KEY", "DIM_DATE_KEY"]
    both = scoring.score_chain(past, {f"{m}_chained": f for m, f in fits.items()}, keys)
    for m, f in fits.items():
        both = both.join(f.transform(past).select(*keys, F.col("prediction").alias(f"{m}_alone")), keys)
    same = reduce(lambda a, b: a & b, [F.col(f"{m}_chained").eqNullSafe(F.col(f"{m}_alone")) for m in fits])
    return both.groupBy(F.col("DIM_ADDRESS_KEY").cast("bigint").alias("DIM_ADDRESS_KEY")).agg(F.count("*").alias("n"), F.every(same).alias("same"))


_MAINS = [*MEANS[1:], *[f"{m}_LAG_{k}" for m in MEANS for k in aq.LAG_DAYS]]


@query(
    "lm_interactions_normal_equations",
    f"""
WITH complete AS (SELECT * FROM history_wide WHERE {' AND '.join(f'{c} IS NOT NULL' for c in ['NO2_MEAN', *_MAINS])}),
x AS (UNPIVOT (SELECT NO2_MEAN AS y, {', '.join(_MAINS)}, O3_MEAN * SO2_MEAN AS O3_x_SO2, O3_MEAN * CO_MEAN AS O3_x_CO, SO2_MEAN * CO_MEAN AS SO2_x_CO FROM complete)
      ON COLUMNS(* EXCLUDE (y)) INTO NAME term VALUE v)
SELECT term, count(*) AS n, round(sum(v * y), 3) AS sum_xy, true AS solved FROM x GROUP BY term
""",
    "history_wide",
)
def lm_interactions_normal_equations(spark, sf):
    """At the fit each term is orthogonal to what is left: its sums of products with response and fitted values agree."""
    past = materialize(aq.as_levels(history(spark, sf, STATION_USERS)), "history")
    fit = aq.fit_pollutants(past, ["NO2_MEAN"])["NO2_MEAN"]
    y, fitted, crossed = F.col("NO2_MEAN"), F.col("prediction"), [("O3", "SO2"), ("O3", "CO"), ("SO2", "CO")]
    complete = fit.transform(past).dropna(subset=["NO2_MEAN", *_MAINS])
    terms = [F.struct(F.lit(c).alias("term"), F.col(c).alias("v")) for c in _MAINS]
    terms += [F.struct(F.lit(f"{a}_x_{b}").alias("term"), (F.col(f"{a}_MEAN") * F.col(f"{b}_MEAN")).alias("v")) for a, b in crossed]
    rows = complete.select(y.alias("y"), fitted.alias("fitted"), F.inline(F.array(*terms)))
    sums = rows.groupBy("term").agg(
        F.count("*").alias("n"), F.sum(F.col("v") * F.col("y")).alias("sum_xy"),
        (F.abs(F.sum(F.col("v") * (F.col("y") - F.col("fitted")))) <= 1e-6 * F.sum(F.abs(F.col("v") * F.col("y")))).alias("solved"))
    return tidy(sums, 3)
