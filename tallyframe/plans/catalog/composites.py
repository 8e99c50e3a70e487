"""Registered queries: whole analyses."""

from __future__ import annotations

import re

from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tallyframe.functions import calendar as cal
from tallyframe.functions.nulls import if_else
from tallyframe.operators import evaluation, models, scoring, splits
from tallyframe.operators.rows import stack
from tallyframe.plans import air_quality as aq
from tallyframe.plans import bases
from tallyframe.plans.bases import BASE_SQL, MEANS, loans, nations_of, subs
from tallyframe.plans.catalog.aggregates import trips_with_share
from tallyframe.plans.catalog.selection import CLEAN
from tallyframe.plans.catalog.shape import tidy
from tallyframe.plans.registry import query
from tallyframe.session import materialize, scratch_path
from tallyframe.sources import files, sinks
from tallyframe.sources.published import PublishedTable

# --- neighbourhood summary -----------------------------------------------------------------


@query(
    "hood_summary",
    """
SELECT dropoff_nhood, pickup_nhood, round(avg(tip_pct), 10) AS ave_tip, round(avg(trip_distance), 10) AS ave_dist
FROM trips WHERE pickup_nhood IN (SELECT nhood FROM nhoods) AND dropoff_nhood IN (SELECT nhood FROM nhoods)
GROUP BY 1, 2 HAVING avg(trip_distance) > 3 AND avg(tip_pct) > 0.05
""",
    "trips nhoods",
)
def hood_summary(spark, sf):
    """Mean tip share and distance between the neighbourhoods of one region."""
    home = nations_of(spark, sf)
    inside = trips_with_share(
        spark, sf, "pickup_nhood", "dropoff_nhood", "trip_distance", pickup_in=home, dropoff_in=home
    )
    out = inside.groupBy("dropoff_nhood", "pickup_nhood").agg(
        F.avg("tip_pct").alias("ave_tip"), F.avg("trip_distance").alias("ave_dist")
    )
    return tidy(out.filter((F.col("ave_dist") > 3) & (F.col("ave_tip") > 0.05)), 10)


# --- air quality ---------------------------------------------------------------------------

P = aq.POLLUTANTS
_lags = [(p, k) for p in P for k in aq.LAG_DAYS]

BASE_SQL["calendar"] = (
    [],
    """
SELECT row_number() OVER (ORDER BY d) AS DIM_DATE_KEY, CAST(d AS DATE) AS DATE
FROM (SELECT unnest(generate_series(make_date(year(min(ts)), 1, 1), make_date(year(CAST(max(ts) AS DATE) + 366), 12, 31), INTERVAL 1 DAY)) AS d FROM events)
""",
)
BASE_SQL["daily"] = (
    ["pollution"],
    f"""
SELECT {CLEAN.format(c='ADDRESS')} AS ADDRESS, DATE, {', '.join(CLEAN.format(c=c) + ' AS ' + c for c in aq.STATION[1:])},
  SITE_NUM, {', '.join(f'{p}_MEAN' for p in P)}, CAST(year(DATE) AS BIGINT) AS YEAR, CAST(month(DATE) AS BIGINT) AS MONTH,
  CAST(day(DATE) AS BIGINT) AS DAY, ADDRESS AS RAW
FROM (SELECT ADDRESS, DATE, STATE, CITY, COUNTY, SITE_NUM,
  {', '.join(f'CASE WHEN count({m}) = count(*) THEN avg({m}) END AS {m}' for m in MEANS)}
  FROM pollution GROUP BY 1, 2, 3, 4, 5, 6) WHERE SO2_MEAN <= 100
""",
)
BASE_SQL["history"] = (
    ["daily", "calendar"],
    f"""
SELECT h.* EXCLUDE (RAW, {', '.join(f'{p}_L{k}' for p, k in _lags)}),
  {', '.join(f'coalesce({p}_L{k}, {p}_MEDIAN) AS {p}_MEAN_LAG_{k}' for p, k in _lags)}, c.DIM_DATE_KEY
FROM (SELECT *, dense_rank() OVER (ORDER BY ADDRESS) AS DIM_ADDRESS_KEY,
  {', '.join(f'lag({p}_MEAN, {k}) OVER w AS {p}_L{k}' for p, k in _lags)},
  {', '.join(f'CASE WHEN count({p}_MEAN) OVER g = count(*) OVER g THEN median({p}_MEAN) OVER g END AS {p}_MEDIAN' for p in P)}
  FROM daily WINDOW w AS (PARTITION BY ADDRESS ORDER BY DATE, RAW, STATE, CITY, COUNTY, SITE_NUM), g AS (PARTITION BY ADDRESS)) h
LEFT JOIN calendar c ON h.DATE = c.DATE
""",
)
_measures = [*MEANS, *aq.MEDIANS.values(), *aq.LAGS]
BASE_SQL["expected"] = (
    ["history"],
    f"""
SELECT g.DIM_ADDRESS_KEY, g.DATE, g.DIM_DATE_KEY, CAST(month(g.DATE) AS BIGINT) AS MONTH, CAST(day(g.DATE) AS BIGINT) AS DAY,
  CAST(year(g.DATE) AS BIGINT) AS YEAR,
  {', '.join(f'coalesce(m.{p}_MEAN, d.{p}_MEDIAN) AS {p}_MEAN, d.{p}_MEDIAN' for p in P)}
FROM (SELECT DIM_ADDRESS_KEY, CAST(last + CAST(k AS INTEGER) AS DATE) AS DATE, last_key + k AS DIM_DATE_KEY
      FROM (SELECT DISTINCT DIM_ADDRESS_KEY FROM history),
           (SELECT max(DATE) AS last, max(DIM_DATE_KEY) AS last_key FROM history), range(1, 366) t(k)) g
LEFT JOIN (SELECT DIM_ADDRESS_KEY, MONTH, DAY, {', '.join(f'avg({m}) AS {m}' for m in MEANS)} FROM history GROUP BY 1, 2, 3) m
  ON g.DIM_ADDRESS_KEY = m.DIM_ADDRESS_KEY AND month(g.DATE) = m.MONTH AND day(g.DATE) = m.DAY
LEFT JOIN (SELECT DIM_ADDRESS_KEY, {', '.join(f'median({p}_MEAN) AS {p}_MEDIAN' for p in P)} FROM history GROUP BY 1) d
  ON g.DIM_ADDRESS_KEY = d.DIM_ADDRESS_KEY
""",
)
BASE_SQL["projection"] = (
    ["expected"],
    f"""
SELECT DIM_DATE_KEY, DIM_ADDRESS_KEY, DATE, MONTH, DAY, YEAR, {', '.join([*MEANS, *aq.MEDIANS.values()])},
  {', '.join(f'coalesce({c}, {m}) AS {c}' for c, m in aq.LAGS.items())}
FROM (SELECT {', '.join(aq.PROJECTED_COLUMNS)} FROM history
      WHERE DATE >= (SELECT max(DATE) FROM history) - INTERVAL 7 DAY
      UNION ALL
      SELECT DIM_DATE_KEY, DIM_ADDRESS_KEY, DATE, MONTH, DAY, YEAR, {', '.join([*MEANS, *aq.MEDIANS.values()])},
        {', '.join(f'lag({p}_MEAN, {k}) OVER w' for p, k in _lags)}
      FROM expected WINDOW w AS (PARTITION BY DIM_ADDRESS_KEY ORDER BY DATE))
""",
)


# Fifteen users share a station here, so that nearly every station has every pollutant on every day, which the fits need.
STATION_USERS = 15
_AIR = ["pollution", "daily", "history", "expected", "projection"]
_wide = lambda text: re.sub(rf"(?<![A-Za-z_])({'|'.join(_AIR)})(?![A-Za-z_])", r"\1_wide", text)
for _name in _AIR:
    _needs, _text = BASE_SQL[_name]
    if _name == "pollution":
        _text = _text.replace("FROM events", f"FROM (SELECT * REPLACE (user_id // {STATION_USERS} AS user_id) FROM events)")
    BASE_SQL[f"{_name}_wide"] = ([n if n == "calendar" else f"{n}_wide" for n in _needs], _wide(_text))


def _rounded(columns) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in columns)


def history(spark, sf, users_per_station: int = 1):
    return aq.clean_history(bases.pollution(spark, sf, users_per_station), cal.dim_date(spark, *bases.calendar_span(spark, sf)))


@query(
    "pollution_history",
    f"""
SELECT ADDRESS, DATE, STATE, CITY, COUNTY, SITE_NUM, YEAR, MONTH, DAY, DIM_ADDRESS_KEY, DIM_DATE_KEY, {_rounded(_measures)}
FROM history
""",
    "history",
)
def pollution_history(spark, sf):
    return tidy(history(spark, sf))


@query(
    "pollution_projection",
    f"SELECT DIM_DATE_KEY, DIM_ADDRESS_KEY, DATE, MONTH, DAY, YEAR, {_rounded(_measures)} FROM projection",
    "projection",
)
def pollution_projection(spark, sf):
    return tidy(aq.project(materialize(history(spark, sf), "history")))


@query("address_dim", "SELECT DISTINCT DIM_ADDRESS_KEY, SITE_NUM, ADDRESS, STATE, CITY, COUNTY FROM history", "history")
def address_dim(spark, sf):
    return tidy(aq.address_dim(aq.keyed_days(aq.daily_means(bases.pollution(spark, sf)))))


def scored_year(spark, sf):
    """History, projection, and the projection scored by the fitted models, each written once; scores are published under ``folder``."""
    past = materialize(history(spark, sf, STATION_USERS), "history")
    future = materialize(aq.project(past), "projection")
    fits = aq.fit_pollutants(past)
    store = PublishedTable(spark, scratch_path(spark, "Fact_US_Pollution_Predicted"))
    store.publish(aq.forecast(future, fits), "year ahead")
    return past, future, fits, store


@query("pollution_forecast")
def pollution_forecast(spark, sf):
    """The stored scores of the year ahead."""
    return tidy(scored_year(spark, sf)[3].read())


def _off(mine: str, theirs: str):
    """Distance of two sums of scores; missing scores count on neither side."""
    return F.abs(F.coalesce(F.sum(mine), F.lit(0.0)) - F.coalesce(F.sum(theirs), F.lit(0.0)))


@query(
    "pollution_forecast_stored",
    f"""
SELECT DIM_ADDRESS_KEY, count(*) AS n, count(DISTINCT DIM_DATE_KEY) AS days, min(DIM_DATE_KEY) AS first_day, max(DIM_DATE_KEY) AS last_day,
       {', '.join(f'0.0::DOUBLE AS {m}_off' for m in MEANS)}, true AS scored FROM projection_wide GROUP BY 1
""",
    "projection_wide",
)
def pollution_forecast_stored(spark, sf):
    """Per station the stored scores against freshly computed ones; a rerun of the publication changes nothing."""
    _, future, fits, store = scored_year(spark, sf)
    fresh = aq.forecast(future, fits)
    stored = store.publish(fresh, "year ahead")
    both = stored.join(fresh.withColumnsRenamed({m: f"{m}_fresh" for m in fits}), ["DIM_ADDRESS_KEY", "DIM_DATE_KEY"])
    report = both.groupBy("DIM_ADDRESS_KEY").agg(
        F.count("*").alias("n"), F.count_distinct("DIM_DATE_KEY").alias("days"), F.min("DIM_DATE_KEY").alias("first_day"), F.max("DIM_DATE_KEY").alias("last_day"),
        *[_off(m, f"{m}_fresh").alias(f"{m}_off") for m in fits], (F.count("NO2_MEAN") > 0).alias("scored"))
    return tidy(report)


@query(
    "pollution_all_view",
    f"""
SELECT DIM_ADDRESS_KEY, DIM_DATE_KEY, {', '.join(f'round({m}, 6) AS {m}_HIST' for m in MEANS)},
  {', '.join(f'CAST(NULL AS DOUBLE) AS {m}_PRED_off' for m in MEANS)} FROM history_wide
UNION ALL SELECT DIM_ADDRESS_KEY, DIM_DATE_KEY, {', '.join('NULL' for m in MEANS)}, {', '.join('0.0' for m in MEANS)}
FROM projection_wide
""",
    "projection_wide",
)
def pollution_all_view(spark, sf):
    """The view of history and stored predictions; each prediction is returned as its difference from a fresh score, which SQL can state."""
    past, future, fits, store = scored_year(spark, sf)
    view = sinks.define_view(aq.all_view(past, store.read()), "US_POLLUTION_ALL")
    fresh = aq.forecast(future, fits).select("DIM_ADDRESS_KEY", "DIM_DATE_KEY", *[F.col(m).alias(f"_{m}") for m in fits], F.lit(True).alias("_new"))
    # A station has each day once as history and once as prediction at most; only the latter meets a fresh score.
    told = view.withColumn("_new", F.col("_source") == "PRED").join(fresh, ["DIM_ADDRESS_KEY", "DIM_DATE_KEY", "_new"], "left")
    off = [F.when(F.col("_new"), F.coalesce(F.col(f"{m}_PRED") - F.col(f"_{m}"), F.when(F.col(f"{m}_PRED").eqNullSafe(F.col(f"_{m}")), 0.0))).alias(f"{m}_PRED_off") for m in fits]
    return tidy(told.select("DIM_ADDRESS_KEY", "DIM_DATE_KEY", *[f"{m}_HIST" for m in MEANS], *off))


_TABLES = {
    "Dim_Dates": ("calendar", "DIM_DATE_KEY", "CAST(DIM_DATE_KEY AS DOUBLE)"),
    "Dim_Pollution_Addresses": (
        "(SELECT DISTINCT DIM_ADDRESS_KEY, SITE_NUM, ADDRESS, STATE, CITY, COUNTY FROM history_wide)", "DIM_ADDRESS_KEY", "CAST(SITE_NUM AS DOUBLE)"
    ),
    "Fact_US_Pollution_Historical": ("history_wide", "DIM_ADDRESS_KEY", "SO2_MEAN"),
    "Fact_US_Pollution_Projected": ("projection_wide", "DIM_ADDRESS_KEY", "SO2_MEAN_LAG_7"),
    # What SQL can state of the scores: that the loaded ones add up to fresh ones.
    "Fact_US_Pollution_Predicted": ("projection_wide", "DIM_DATE_KEY", "0.0"),
}


@query(
    "star_load",
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS n, count(DISTINCT {key}) AS keys, "
        f"round(sum(CAST({total} AS DOUBLE)), 3) AS total FROM {source}"
        for name, (source, key, total) in _TABLES.items()
    ),
    "projection_wide calendar",
)
def star_load(spark, sf):
    """Write five CSV files, load each with declared types into its table, and report on the tables."""
    past, future, fits, store = scored_year(spark, sf)
    contents = {
        "Dim_Dates": cal.dim_date(spark, *bases.calendar_span(spark, sf)),
        "Dim_Pollution_Addresses": aq.address_dim(past),
        "Fact_US_Pollution_Historical": past,
        "Fact_US_Pollution_Projected": future,
        "Fact_US_Pollution_Predicted": store.read(),
    }
    folder = scratch_path(spark, "star")
    fresh = aq.forecast(future, fits).agg(F.sum("SO2_MEAN")).scalar()
    reports = []
    for name, (_, key, total) in _TABLES.items():
        df = contents[name]
        sinks.write_csv(df, f"{folder}/csv/{name}")
        declared = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)
        loaded = sinks.write_table(files.read_csv(spark, f"{folder}/csv/{name}", declared), sinks.own_name(name), f"{folder}/tables/{name}")
        summed = F.abs(F.sum("SO2_MEAN") - fresh) if total == "0.0" else F.sum(F.expr(total))
        reports.append(loaded.agg(F.lit(name).alias("table_name"), F.count("*").alias("n"), F.count_distinct(key).alias("keys"), F.coalesce(summed, F.lit(0.0)).alias("total")))
    return tidy(stack(*reports), 3)


# --- loan defaults -------------------------------------------------------------------------

LOAN_PREDICTORS = ["creditScore", "houseAge", "yearsEmploy", "ccDebt", "year"]
FLAG_LEVELS = ["current", "default"]


def loan_parts(spark, sf):
    """Loans with a default flag, split into train and validate."""
    df = loans(spark, sf).withColumn("default_flag", if_else(F.col("default") == 1, "default", "current"))
    return splits.split(df, "o_orderkey", 0.75)


def loan_classifiers(train):
    """The four classifiers of the comparison, fitted."""
    fit = lambda estimator: models.estimate_model(
        train, "default_flag", LOAN_PREDICTORS, estimator, response_levels=FLAG_LEVELS, one_hot=False
    )
    return {
        "pred_logit_default": models.estimate_model(train, "default", LOAN_PREDICTORS, models.generalized("binomial")),
        "pred_tree_default": fit(DecisionTreeClassifier(minInstancesPerNode=10, maxDepth=5, seed=1)),
        "pred_forest_default": fit(RandomForestClassifier(numTrees=100, maxDepth=5, seed=1)),
        "pred_gbm_default": fit(GBTClassifier(maxIter=100, maxDepth=1, stepSize=0.1, seed=1)),
    }


def default_probability(fit):
    """The score column of a fit: a class probability, or a logistic mean."""
    if hasattr(fit.model, "numClasses"):
        return vector_to_array(F.col("probability"))[1]
    return F.col("prediction")


def score_all(df, fits, keep):
    """Every fit's probability beside the kept columns, in one plan."""
    for name, fit in fits.items():
        df = fit.transform(df).select(*df.columns, default_probability(fit).alias(name))
    return df.select(*keep, *fits)


@query("default_model_comparison")
def default_model_comparison(spark, sf):
    parts = {name: materialize(part, name) for name, part in loan_parts(spark, sf).items()}
    fits = loan_classifiers(parts["train"])
    scored = materialize(score_all(parts["validate"], fits, ["o_orderkey", "default"]), "scores")
    return tidy(evaluation.auc(scored, "default", list(fits)))


# --- subscriptions -------------------------------------------------------------------------

SUBS_PREDICTORS = ["UniqueProducts", "TotalSales", "MarketingChannel", "FavCategory", "Region"]


@query("subscription_model")
def subscription_model(spark, sf):
    """Stratified split, forest of 50 trees, ROC cutoff on the holdout, threshold scores as a confusion matrix."""
    df = subs(spark, sf).withColumn("SubRenew", if_else(F.col("Subscription") == 1, "Yes", "No"))
    labelled = materialize(splits.stratified_label(df, "doc_id", "SubRenew", 0.7), "subscriptions")
    training, testing = (labelled.filter(F.col("part") == p) for p in ("train", "validate"))
    fit = models.estimate_model(
        training, "SubRenew", SUBS_PREDICTORS, RandomForestClassifier(numTrees=50, maxDepth=5, seed=1238),
        response_levels=["No", "Yes"], one_hot=False,
    )
    scored = materialize(
        fit.transform(testing).select("doc_id", "Subscription", "SubRenew", vector_to_array("probability")[1].alias("Yes")),
        "renewal-scores",
    )
    cutoff = evaluation.roc_cutoff(evaluation.roc_points(scored, "Subscription", "Yes"), 0.1).select("cutoff").scalar()
    renewed = scored.select("SubRenew", scoring.score_threshold("Yes", 0.60).alias("predicted"))
    matrix = evaluation.confusion_matrix(renewed, "SubRenew", "predicted")
    return tidy(matrix.withColumn("cutoff", cutoff))
