"""Registered queries: windows, sorts, samples, splits, ROC."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.functions.keys import RANGE, key_hash_sql
from tallyframe.operators import distribute, evaluation, rows, scoring, splits, windows
from tallyframe.operators import select as sel
from tallyframe.operators.linear import lm_simple
from tallyframe.plans.bases import MEANS, TRIP_KEY, air, loans, read_table, subs, trips
from tallyframe.plans.catalog.aggregates import trips_with_share
from tallyframe.plans.catalog.selection import raw_pollution
from tallyframe.plans.catalog.shape import tidy
from tallyframe.plans.registry import query

KEY = ", ".join(TRIP_KEY)
# Draws of the registered queries use a seed of their own.
SEED = 11
H = key_hash_sql("o_orderkey", SEED)

# --- windows -------------------------------------------------------------------------------

LAG_SQL = ", ".join(
    f"round(lag({m}, {k}) OVER w, 6) AS {m}_LAG_{k}" for m in MEANS for k in range(1, 8)
)


@query("lag_features", f"SELECT SITE_NUM, DATE, {LAG_SQL} FROM pollution WINDOW w AS (PARTITION BY SITE_NUM ORDER BY DATE)", "pollution")
def lag_features(spark, sf):
    df = raw_pollution(spark, sf).select("SITE_NUM", "DATE", *MEANS)
    return tidy(distribute.lag_columns(df, ["SITE_NUM"], ["DATE"], MEANS, range(1, 8)).drop(*MEANS))


MEDIANS = {m: m.replace("_MEAN", "_MEDIAN") for m in MEANS}


@query(
    "group_median_column",
    "SELECT SITE_NUM, DATE, "
    + ", ".join(f"round(median({m}) OVER (PARTITION BY SITE_NUM), 6) AS {n}" for m, n in MEDIANS.items())
    + " FROM pollution",
    "pollution",
)
def group_median_column(spark, sf):
    df = raw_pollution(spark, sf).select("SITE_NUM", "DATE", *MEANS)
    return tidy(windows.with_group_medians(df, ["SITE_NUM"], MEDIANS, strict=False).drop(*MEANS))


@query(
    "fill_lag_with_median",
    """
SELECT SITE_NUM, DATE, round(coalesce(lag(NO2_MEAN, 1) OVER w, m), 6) AS NO2_MEAN_LAG_1,
       round(coalesce(lag(NO2_MEAN, 7) OVER w, m), 6) AS NO2_MEAN_LAG_7
FROM (SELECT *, median(NO2_MEAN) OVER (PARTITION BY SITE_NUM) AS m FROM pollution)
WINDOW w AS (PARTITION BY SITE_NUM ORDER BY DATE)
""",
    "pollution",
)
def fill_lag_with_median(spark, sf):
    df = raw_pollution(spark, sf).select("SITE_NUM", "DATE", "NO2_MEAN")
    df = distribute.lag_columns(df, ["SITE_NUM"], ["DATE"], ["NO2_MEAN"], [1, 7])
    df = windows.with_group_medians(df, ["SITE_NUM"], {"NO2_MEAN": "NO2_MEDIAN"}, strict=False)
    lags = sel.matches(df, "NO2_MEAN_LAG")
    return tidy(windows.fill_from(df, {c: "NO2_MEDIAN" for c in lags}).select("SITE_NUM", "DATE", *lags))


@query(
    "fill_measure_with_median",
    "SELECT SITE_NUM, DATE, "
    + ", ".join(f"round(coalesce({m}, median({m}) OVER (PARTITION BY SITE_NUM)), 6) AS {m}" for m in MEANS)
    + " FROM pollution",
    "pollution",
)
def fill_measure_with_median(spark, sf):
    df = raw_pollution(spark, sf).select("SITE_NUM", "DATE", *MEANS)
    df = windows.with_group_medians(df, ["SITE_NUM"], MEDIANS, strict=False)
    return tidy(windows.fill_from(df, MEDIANS).select("SITE_NUM", "DATE", *MEANS))


@query(
    "surrogate_key_rank",
    "SELECT SITE_NUM, DATE, ADDRESS, dense_rank() OVER (ORDER BY ADDRESS) AS DIM_ADDRESS_KEY FROM pollution",
    "pollution",
)
def surrogate_key_rank(spark, sf):
    df = raw_pollution(spark, sf).select("SITE_NUM", "DATE", "ADDRESS")
    return tidy(distribute.dense_key(df, "ADDRESS", "DIM_ADDRESS_KEY"))


@query(
    "topk_per_group",
    f"""
SELECT dropoff_dow, {KEY}, round(tip_amount, 6) AS tip_amount, fare_amount, pickup_nhood, dropoff_nhood FROM (
  SELECT *, row_number() OVER (PARTITION BY dropoff_dow ORDER BY tip_pct DESC, fare_amount DESC, {KEY}) AS k
  FROM trips WHERE dropoff_nhood IS NOT NULL AND pickup_nhood IS NOT NULL) WHERE k <= 2
""".replace("tip_pct DESC", "round(tip_pct, 9) DESC"),
    "trips",
)
def topk_per_group(spark, sf):
    df = trips_with_share(spark, sf, "dropoff_dow", *TRIP_KEY, "fare_amount", "pickup_nhood", "dropoff_nhood")
    df = df.dropna(subset=["dropoff_nhood", "pickup_nhood"]).withColumn("tip_pct", F.round("tip_pct", 9))
    return tidy(windows.top_k_per_group(df, ["dropoff_dow"], 2, "-tip_pct", "-fare_amount", *TRIP_KEY).drop("tip_pct"))


@query(
    "ecdf_by_class",
    """
SELECT "default", ccDebt, round(cume_dist, 9) AS share FROM (
  SELECT DISTINCT "default", ccDebt, cume_dist() OVER (PARTITION BY "default" ORDER BY ccDebt) AS cume_dist FROM loans)
""",
    "loans",
)
def ecdf_by_class(spark, sf):
    return tidy(windows.cumulative_share(loans(spark, sf, "default", "ccDebt"), "ccDebt", ["default"]), 9)


@query(
    "lag_ratio",
    """
SELECT day, total, round(total / nullif(lag(total) OVER (ORDER BY day), 0), 6) AS ratio FROM (
  SELECT CAST(o_orderdate AS DATE) AS day, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1)
""",
)
def lag_ratio(spark, sf):
    daily = read_table(spark, sf, "orders").groupBy(F.col("o_orderdate").cast("date").alias("day")).agg(
        F.round(F.sum("o_totalprice"), 2).alias("total")
    )
    out = distribute.lag_columns(daily, [], ["day"], ["total"], [1], "previous")
    return tidy(out.select("day", "total", windows.ratio_to_previous("total", "previous").alias("ratio")))


@query(
    "row_sequence",
    "SELECT o_orderkey, row_number() OVER (ORDER BY CAST(o_orderdate AS DATE), o_orderkey) AS x FROM orders",
)
def row_sequence(spark, sf):
    df = read_table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    return tidy(distribute.row_positions(df, [F.col("day"), F.col("o_orderkey")], "x").drop("day"))


# --- sorts and samples ---------------------------------------------------------------------


@query(
    "sort_multi",
    f"SELECT SITE_NUM, DATE, round(NO2_MEAN, 6) AS NO2_MEAN FROM pollution "
    "ORDER BY NO2_MEAN DESC NULLS LAST, DATE NULLS LAST, SITE_NUM",
    "pollution",
)
def sort_multi(spark, sf):
    df = raw_pollution(spark, sf).select("SITE_NUM", "DATE", "NO2_MEAN")
    return tidy(rows.arrange(df, "-NO2_MEAN", "DATE", ties=["SITE_NUM"]))


@query("topn", f"SELECT {KEY}, fare_amount FROM trips ORDER BY fare_amount DESC, {KEY} LIMIT 10", "trips")
def topn(spark, sf):
    return tidy(rows.top_n(trips(spark, sf, *TRIP_KEY, "fare_amount"), 10, "-fare_amount", *TRIP_KEY))


@query(
    "sort_aggregate",
    """
SELECT dropoff_dow, pickup_nhood, round(avg(tip_pct), 10) AS ave_tip, count(*) AS Num FROM trips
GROUP BY 1, 2 HAVING count(*) >= 10 ORDER BY ave_tip DESC
""",
    "trips",
)
def sort_aggregate(spark, sf):
    df = trips_with_share(spark, sf, "dropoff_dow", "pickup_nhood")
    out = df.groupBy("dropoff_dow", "pickup_nhood").agg(F.avg("tip_pct").alias("ave_tip"), F.count("*").alias("Num"))
    return rows.arrange(tidy(out.filter("Num >= 10"), 10), "-ave_tip", ties=["dropoff_dow", "pickup_nhood"])


@query("sample_n", f"SELECT o_orderkey, o_totalprice FROM orders ORDER BY {H}, o_orderkey LIMIT 1000")
def sample_n(spark, sf):
    return rows.sample_n(read_table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), 1000, "o_orderkey", SEED)


# --- splits --------------------------------------------------------------------------------


@query(
    "split_train_validate",
    f"SELECT o_orderkey, CASE WHEN {H} < {int(0.75 * RANGE)} THEN 'train' ELSE 'validate' END AS trainvalidate FROM orders",
)
def split_train_validate(spark, sf):
    df = read_table(spark, sf, "orders").select("o_orderkey")
    return df.withColumn("trainvalidate", splits.train_label("o_orderkey", 0.75, SEED))


@query(
    "split_one_pass",
    f"""
SELECT CASE WHEN {H} < {int(0.7 * RANGE)} THEN 'train' ELSE 'validate' END AS part, count(*) AS n,
       round(avg(ccDebt), 4) AS mean_debt, sum("default") AS defaults FROM loans GROUP BY 1
""".replace('sum("default")', 'CAST(sum("default") AS BIGINT)'),
    "loans",
)
def split_one_pass(spark, sf):
    # The label is one more column, so both parts are described in one pass over the rows.
    df = loans(spark, sf, "o_orderkey", "ccDebt", "default").withColumn("part", splits.train_label("o_orderkey", 0.7, SEED))
    out = df.groupBy("part").agg(F.count("*").alias("n"), F.avg("ccDebt").alias("mean_debt"), F.sum("default").alias("defaults"))
    return tidy(out, 4)


@query(
    "split_stratified",
    f"""
SELECT doc_id, Subscription, CASE WHEN k <= ceil(0.7::DOUBLE * n) THEN 'train' ELSE 'validate' END AS part FROM (
  SELECT doc_id, Subscription, row_number() OVER (PARTITION BY Subscription ORDER BY {key_hash_sql('doc_id', SEED)}, doc_id) AS k,
         count(*) OVER (PARTITION BY Subscription) AS n FROM subs)
""",
    "subs",
)
def split_stratified(spark, sf):
    return splits.stratified_label(subs(spark, sf, "doc_id", "Subscription"), "doc_id", "Subscription", 0.7, SEED)


@query(
    "kfold_assign",
    f"SELECT o_orderkey, chr(CAST(65 + ({H}) * 10 // {RANGE} AS INTEGER)) AS fold FROM orders",
)
def kfold_assign(spark, sf):
    return read_table(spark, sf, "orders").select("o_orderkey", splits.fold_label("o_orderkey", 10, SEED).alias("fold"))


@query(
    "filter_fold",
    f"""
SELECT round(regr_slope(ArrDelay, CRSDepTime), 6) AS slope, round(regr_intercept(ArrDelay, CRSDepTime), 6) AS intercept,
       count(*) AS n FROM air WHERE chr(CAST(65 + ({key_hash_sql('l_orderkey', SEED)}) * 10 // {RANGE} AS INTEGER)) <> 'C'
""",
    "air",
)
def filter_fold(spark, sf):
    # The held-out fold is filtered inside the fit's own scan.
    df = air(spark, sf, "l_orderkey", "ArrDelay", "CRSDepTime").filter(splits.fold_label("l_orderkey", 10, SEED) != "C")
    return tidy(lm_simple(df, "ArrDelay", "CRSDepTime").drop("r_squared"))


# --- classification results ----------------------------------------------------------------

SCORES = ["creditScore", "ccDebt", "yearsEmploy"]


def _roc_sql(score: str) -> str:
    return f"""
SELECT '{score}' AS model, CAST(s AS DOUBLE) AS cutoff, round(sum(p) OVER o / sum(p) OVER (), 9) AS tpr,
       round(sum(q) OVER o / sum(q) OVER (), 9) AS fpr
FROM (SELECT {score} AS s, sum("default") AS p, sum(1 - "default") AS q FROM loans GROUP BY 1)
WINDOW o AS (ORDER BY s DESC)
"""


@query("roc_points", _roc_sql("ccDebt").replace("'ccDebt' AS model, ", ""), "loans")
def roc_points(spark, sf):
    return tidy(evaluation.roc_points(loans(spark, sf, "default", "ccDebt"), "default", "ccDebt"), 9)


@query("roc_compare", " UNION ALL ".join(f"({_roc_sql(s)})" for s in SCORES), "loans")
def roc_compare(spark, sf):
    return tidy(evaluation.roc_compare(loans(spark, sf, "default", *SCORES), "default", SCORES), 9)


@query(
    "roc_auc",
    "SELECT model, round(sum((tpr + before_t) / 2 * (fpr - before_f)), 6) AS auc FROM ("
    "SELECT model, tpr, fpr, coalesce(lag(tpr) OVER m, 0) AS before_t, coalesce(lag(fpr) OVER m, 0) AS before_f FROM ("
    + " UNION ALL ".join(f"({_roc_sql(s)})" for s in SCORES)
    + ") WINDOW m AS (PARTITION BY model ORDER BY cutoff DESC)) GROUP BY model",
    "loans",
)
def roc_auc(spark, sf):
    return tidy(evaluation.auc(loans(spark, sf, "default", *SCORES), "default", SCORES))


@query(
    "roc_cutoff",
    f"SELECT model, min(cutoff) AS cutoff, max(tpr) AS tpr, max(fpr) AS fpr FROM ("
    + " UNION ALL ".join(f"({_roc_sql(s)})" for s in SCORES)
    + ") WHERE fpr < 0.1 GROUP BY model",
    "loans",
)
def roc_cutoff(spark, sf):
    points = evaluation.roc_compare(loans(spark, sf, "default", *SCORES), "default", SCORES)
    return tidy(evaluation.roc_cutoff(points, 0.1, ["model"]), 9)


SUBS_SCORE = "1 / (1 + exp(-(TotalSales - 2000) / 3000))"


@query(
    "score_threshold",
    f"""
SELECT doc_id, CASE WHEN FavCategory IN ('de', 'en', 'fr') THEN FavCategory END AS FavCategory,
       CASE WHEN {SUBS_SCORE} > 0.6 THEN 'Yes' ELSE 'No' END AS renew FROM subs
""",
    "subs",
)
def score_threshold(spark, sf):
    df = subs(spark, sf, "doc_id", "FavCategory", "TotalSales")
    return df.select(
        "doc_id",
        scoring.align_levels("FavCategory", ["de", "en", "fr"]).alias("FavCategory"),
        scoring.score_threshold(F.expr(SUBS_SCORE), 0.60).alias("renew"),
    )


@query(
    "confusion_matrix",
    f"""
SELECT actual, predicted, n, round(sum(CASE WHEN actual <> predicted THEN n ELSE 0 END) OVER (PARTITION BY actual)
       / sum(n) OVER (PARTITION BY actual), 6) AS class_error
FROM (SELECT CASE WHEN Subscription = 1 THEN 'Yes' ELSE 'No' END AS actual,
      CASE WHEN {SUBS_SCORE} > 0.6 THEN 'Yes' ELSE 'No' END AS predicted, count(*) AS n FROM subs GROUP BY 1, 2)
""",
    "subs",
)
def confusion_matrix(spark, sf):
    df = subs(spark, sf, "Subscription", "TotalSales").select(
        F.when(F.col("Subscription") == 1, "Yes").otherwise("No").alias("actual"),
        scoring.score_threshold(F.expr(SUBS_SCORE), 0.60).alias("predicted"),
    )
    return tidy(evaluation.confusion_matrix(df, "actual", "predicted"))
