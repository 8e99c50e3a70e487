"""Registered queries: aggregates, summaries, histograms, tables, correlations."""

from __future__ import annotations



from pyspark.sql import functions as F

from tallyframe.functions.normal import inverse_normal_sql
from tallyframe.functions.nulls import ratio, strict_mean
from tallyframe.operators import quantiles as quant
from tallyframe.operators import select as sel
from tallyframe.operators import joins, summaries, tables
from tallyframe.plans.bases import MEANS, air, loans, nations_of, read_table, subs, trips
from tallyframe.plans.catalog.selection import raw_pollution
from tallyframe.plans.catalog.shape import tidy
from tallyframe.plans.registry import query


def trips_with_share(spark, sf, *cols, **only):
    df = trips(spark, sf, *dict.fromkeys([*cols, "tip_amount", "fare_amount"]), **only)
    return df.withColumn("tip_pct", ratio("tip_amount", "fare_amount"))


# --- grouped and global aggregates ---------------------------------------------------------


@query(
    "agg_count_mean",
    "SELECT pickup_nhood, count(*) AS Num, round(avg(tip_pct), 10) AS ave_tip FROM trips GROUP BY pickup_nhood",
    "trips",
)
def agg_count_mean(spark, sf):
    df = trips_with_share(spark, sf, "pickup_nhood")
    return tidy(df.groupBy("pickup_nhood").agg(F.count("*").alias("Num"), F.avg("tip_pct").alias("ave_tip")), 10)


@query(
    "agg_two_keys",
    "SELECT pickup_nhood, dropoff_nhood, count(*) AS Num, round(avg(tip_pct), 10) AS ave_tip FROM trips GROUP BY 1, 2",
    "trips",
)
def agg_two_keys(spark, sf):
    df = trips_with_share(spark, sf, "pickup_nhood", "dropoff_nhood")
    out = df.groupBy("pickup_nhood", "dropoff_nhood").agg(F.count("*").alias("Num"), F.avg("tip_pct").alias("ave_tip"))
    return tidy(out, 10)


@query("agg_count", 'SELECT pickup_nhood, count(*) AS "Count" FROM trips GROUP BY pickup_nhood', "trips")
def agg_count(spark, sf):
    return trips(spark, sf, "pickup_nhood").groupBy("pickup_nhood").agg(F.count("*").alias("Count"))


@query(
    "agg_global",
    "SELECT count(*) AS Num, round(avg(tip_pct), 10) AS ave_tip, round(avg(trip_distance), 10) AS ave_dist FROM trips",
    "trips",
)
def agg_global(spark, sf):
    df = trips_with_share(spark, sf, "trip_distance")
    return tidy(df.agg(F.count("*").alias("Num"), F.avg("tip_pct").alias("ave_tip"), F.avg("trip_distance").alias("ave_dist")), 10)


STRICT = ", ".join(f"round(CASE WHEN count({m}) = count(*) THEN avg({m}) END, 6) AS {m}" for m in MEANS)


@query("agg_strict_mean", f"SELECT STATE, CITY, COUNTY, DATE, {STRICT} FROM pollution GROUP BY 1, 2, 3, 4", "pollution")
def agg_strict_mean(spark, sf):
    df = raw_pollution(spark, sf)
    return tidy(df.groupBy("STATE", "CITY", "COUNTY", "DATE").agg(*[strict_mean(m).alias(m) for m in MEANS]))


@query(
    "agg_across",
    "SELECT SITE_NUM, CAST(month(DATE) AS BIGINT) AS MONTH, "
    + ", ".join(f"round(avg({m}), 9) AS {m}" for m in MEANS)
    + " FROM pollution GROUP BY 1, 2",
    "pollution",
)
def agg_across(spark, sf):
    df = raw_pollution(spark, sf).withColumn("MONTH", F.month("DATE"))
    return tidy(sel.agg_across(df, ["SITE_NUM", "MONTH"], sel.matches(df, "MEAN$"), F.avg), 9)


@query(
    "agg_group_median",
    "SELECT SITE_NUM, " + ", ".join(f"round(median({m}), 6) AS {m[:-5]}_MEDIAN" for m in MEANS)
    + " FROM pollution GROUP BY SITE_NUM",
    "pollution",
)
def agg_group_median(spark, sf):
    names = {m: m.replace("_MEAN", "_MEDIAN") for m in MEANS}
    return tidy(quant.group_medians(raw_pollution(spark, sf), ["SITE_NUM"], names))


@query(
    "agg_global_scalar",
    "SELECT o_orderkey, CAST(datediff('day', CAST(o_orderdate AS DATE), "
    "(SELECT max(CAST(o_orderdate AS DATE)) FROM orders)) AS BIGINT) AS days_before_last FROM orders",
)
def agg_global_scalar(spark, sf):
    orders = read_table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
    last = orders.agg(F.max("d")).scalar()
    return tidy(orders.select("o_orderkey", F.datediff(last, "d").alias("days_before_last")))


# --- summaries -----------------------------------------------------------------------------

LINE_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
STATS_SQL = (
    "round(avg({c}), 6) AS Mean, round(stddev_samp({c}), 6) AS StdDev, round(min({c}), 6) AS Min, "
    "round(max({c}), 6) AS Max, count({c}) AS ValidObs, count(*) - count({c}) AS MissingObs"
)


@query(
    "summary_numeric",
    " UNION ALL ".join(
        f"SELECT '{m}' AS variable, {STATS_SQL.format(c=m)} FROM pollution" for m in MEANS
    ),
    "pollution",
)
def summary_numeric(spark, sf):
    return tidy(summaries.summary_numeric(raw_pollution(spark, sf), MEANS))


@query(
    "summary_by_group",
    "SELECT DayOfWeek, round(avg(ArrDelay), 6) AS Mean, round(stddev_samp(ArrDelay), 6) AS StdDev, "
    "count(ArrDelay) AS ValidObs, count(*) - count(ArrDelay) AS MissingObs FROM air GROUP BY DayOfWeek",
    "air",
)
def summary_by_group(spark, sf):
    df = air(spark, sf, "DayOfWeek", "ArrDelay")
    return tidy(summaries.summary_by_group(df, "ArrDelay", ["DayOfWeek"], ["Mean", "StdDev", "ValidObs", "MissingObs"]))


@query(
    "summary_dplyr",
    "SELECT DayOfWeek, round(avg(ArrDelay), 6) AS Means, round(stddev_samp(ArrDelay), 6) AS StdDev, "
    "min(ArrDelay) AS Min, max(ArrDelay) AS Max, count(ArrDelay) AS ValidObs FROM air GROUP BY DayOfWeek",
    "air",
)
def summary_dplyr(spark, sf):
    delay = F.col("ArrDelay")
    out = air(spark, sf, "DayOfWeek", "ArrDelay").groupBy("DayOfWeek").agg(
        F.avg(delay).alias("Means"), F.stddev_samp(delay).alias("StdDev"),
        F.min(delay).alias("Min"), F.max(delay).alias("Max"), F.count(delay).alias("ValidObs"),
    )
    return tidy(out)


def _six_numbers(c: str) -> str:
    parts = {
        "Min": f"min({c})", "1st Qu.": f"quantile_cont({c}, 0.25)", "Median": f"median({c})",
        "3rd Qu.": f"quantile_cont({c}, 0.75)", "Max": f"max({c})", "Mean": f"avg({c})",
    }
    return " UNION ALL ".join(
        f"SELECT '{c}' AS variable, '{n}' AS statistic, round(CAST({e} AS DOUBLE), 6) AS value FROM subs"
        for n, e in parts.items()
    )


@query(
    "summary_frame",
    " UNION ALL ".join(
        [_six_numbers("TotalSales"), _six_numbers("UniqueProducts")]
        + [
            f"SELECT '{c}', CAST({c} AS VARCHAR), CAST(count(*) AS DOUBLE) FROM subs GROUP BY {c}"
            for c in ("FavCategory", "MarketingChannel", "Region")
        ]
    ),
    "subs",
)
def summary_frame(spark, sf):
    df = subs(spark, sf)
    return tidy(summaries.summary_frame(df, ["TotalSales", "UniqueProducts"], ["FavCategory", "MarketingChannel", "Region"]))


PROFILE_SQL = """
WITH m AS (SELECT median(value) AS med, avg(value) AS mean, stddev_samp(value) AS sd FROM events),
d AS (SELECT value, value - m.mean AS c, abs(value - m.med) AS a, m.sd, m.med FROM events, m),
s AS (SELECT
  CAST(count(*) AS DOUBLE) AS "N", CAST(count(*) - count(value) AS DOUBLE) AS "NAs", sum(value) AS "Sum",
  median(value) AS "Median", var_samp(value) AS "Variance", stddev_samp(value) AS "Std.Dev",
  1.4826 * median(a) AS "Mean.Abs.Dev", stddev_samp(value) / sqrt(count(*)) AS "Std.Err", min(value) AS "Range.Low",
  quantile_cont(value, 0.05) AS "Lo.05", quantile_cont(value, 0.25) AS "Lo.25", avg(value) AS "Mean",
  quantile_cont(value, 0.75) AS "Hi.75", quantile_cont(value, 0.95) AS "Hi.95", max(value) AS "Range.High",
  avg(c * c * c) / pow(any_value(sd), 3) AS "Skew", avg(c * c * c * c) / pow(any_value(sd), 4) - 3 AS "Kurtosis",
  100 * avg(a) / any_value(med) AS "CoD", 100 * stddev_samp(value) / avg(value) AS "CoV" FROM d)
SELECT statistic, round_even(value, 4) AS value FROM (UNPIVOT s ON COLUMNS(*) INTO NAME statistic VALUE value)
"""


@query("variable_profile", PROFILE_SQL)
def variable_profile(spark, sf):
    return summaries.variable_profile(read_table(spark, sf, "events"), "value", 4)


QUARTILES = "SELECT quantile_cont(value, 0.25) AS q1, median(value) AS q2, quantile_cont(value, 0.75) AS q3 FROM events"


@query(
    "outlier_flag",
    f"SELECT event_id, value, value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1) AS outlier "
    f"FROM events, ({QUARTILES})",
)
def outlier_flag(spark, sf):
    return summaries.outlier_flag(read_table(spark, sf, "events").select("event_id", "value"), "value")


@query(
    "quartile_bin",
    "SELECT event_id, value, CASE WHEN value <= q1 THEN 'Low' WHEN value <= q2 THEN 'Low-Med' "
    f"WHEN value <= q3 THEN 'Med-Hi' ELSE 'Hi' END AS bin FROM events, ({QUARTILES})",
)
def quartile_bin(spark, sf):
    return summaries.quartile_bin(read_table(spark, sf, "events").select("event_id", "value"), "value")


def _histogram_sql(table: str, col: str, bins: int, key: str | None = None) -> str:
    k, by = (f"{key}, ", f"PARTITION BY {key}") if key else ("", "")
    return f"""
WITH e AS (SELECT min({col}) AS lo, (max({col}) - min({col})) / {bins} AS w FROM {table}),
b AS (SELECT {k}CAST(least(floor(({col} - lo) / w), {bins - 1}) AS BIGINT) AS bin, any_value(lo) AS lo,
      any_value(w) AS w, count(*) AS n FROM {table}, e WHERE {col} IS NOT NULL GROUP BY ALL)
SELECT {k}bin, round(lo + bin * w, 6) AS bin_low, n AS "count",
       round(n * 100.0::DOUBLE / sum(n) OVER ({by}), 6) AS percent FROM b
"""


@query("histogram_percent", _histogram_sql("pollution", "NO2_MEAN", 20), "pollution")
def histogram_percent(spark, sf):
    return tidy(summaries.histogram(raw_pollution(spark, sf), "NO2_MEAN", 20))


@query("histogram_by_group", _histogram_sql("loans", "ccDebt", 20, '"default"'), "loans")
def histogram_by_group(spark, sf):
    return tidy(summaries.histogram(loans(spark, sf, "ccDebt", "default"), "ccDebt", 20, ["default"]))


@query(
    "histogram_count",
    _histogram_sql("subs", "TotalSales", 20),
    "subs",
)
def histogram_count(spark, sf):
    return tidy(summaries.histogram(subs(spark, sf, "TotalSales"), "TotalSales", 20))


@query(
    "density_overlay",
    """
WITH e AS (SELECT min(value) AS lo, (max(value) - min(value)) / 30 AS w, avg(value) AS mean,
           stddev_samp(value) AS sd, count(value) AS n FROM events),
b AS (SELECT CAST(least(floor((value - lo) / w), 29) AS BIGINT) AS bin, count(*) AS k FROM events, e GROUP BY 1)
SELECT bin, round(lo + bin * w + w / 2, 6) AS centre, round(k / (n * w), 9) AS density,
       round(exp(-pow((lo + bin * w + w / 2 - mean) / sd, 2) / 2) / (sd * sqrt(2 * pi())), 9) AS normal FROM b, e
""",
)
def density_overlay(spark, sf):
    out = summaries.density_overlay(read_table(spark, sf, "events"), "value", 30)
    return tidy(out, 9, centre=6)


@query(
    "box_stats",
    """
WITH q AS (SELECT FavCategory, quantile_cont(TotalSales, 0.25) AS q1, median(TotalSales) AS median,
           quantile_cont(TotalSales, 0.75) AS q3, count(TotalSales) AS n FROM subs GROUP BY 1),
x AS (SELECT s.FavCategory, TotalSales AS v, q1, median, q3, n,
      TotalSales BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
      FROM subs s JOIN q ON s.FavCategory = q.FavCategory)
SELECT FavCategory, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3, n,
       round(min(v) FILTER (inside), 6) AS whisker_low, round(max(v) FILTER (inside), 6) AS whisker_high,
       count(*) FILTER (NOT inside) AS outliers FROM x GROUP BY FavCategory, x.q1, x.median, x.q3, n
""",
    "subs",
)
def box_stats(spark, sf):
    return tidy(summaries.box_stats(subs(spark, sf, "FavCategory", "TotalSales"), "TotalSales", ["FavCategory"]))


@query(
    "qq_points",
    f"""
WITH v AS (SELECT value AS sample, row_number() OVER (ORDER BY value) AS i, count(*) OVER () AS m FROM events WHERE value IS NOT NULL),
g AS (SELECT sample, count(*) AS n, (avg(i) - any_value(CASE WHEN m <= 10 THEN 0.375 ELSE 0.5 END))
      / (any_value(m) + 1 - 2 * any_value(CASE WHEN m <= 10 THEN 0.375 ELSE 0.5 END))::DOUBLE AS p FROM v GROUP BY sample)
SELECT round(sample, 6) AS sample, n, round(p, 6) AS p, round({inverse_normal_sql("p")}, 6) AS theoretical,
       CASE WHEN sample <= q1 THEN 'Low' WHEN sample <= q2 THEN 'Low-Med' WHEN sample <= q3 THEN 'Med-Hi' ELSE 'Hi' END AS bin
FROM g, ({QUARTILES})
""",
)
def qq_points(spark, sf):
    return tidy(summaries.qq_points(read_table(spark, sf, "events"), "value"))


@query(
    "custom_aggregate",
    """
WITH m AS (SELECT event_type, median(value) AS med FROM events GROUP BY 1)
SELECT e.event_type, round(100 * avg(abs(value - med)) / any_value(med), 6) AS CoD,
       round(100 * stddev_samp(value) / avg(value), 6) AS CoV FROM events e JOIN m ON e.event_type = m.event_type
GROUP BY e.event_type
""",
)
def custom_aggregate(spark, sf):
    events = read_table(spark, sf, "events").select("event_type", "value")
    med = quant.group_medians(events, ["event_type"], {"value": "med"}, strict=True)
    cod = 100 * F.try_divide(F.avg(F.abs(F.col("value") - F.col("med"))), F.first("med"))
    out = joins.left_on(events, med, ["event_type"]).groupBy("event_type").agg(
        cod.alias("CoD"), summaries.coefficient_of_variation(F.col("value")).alias("CoV")
    )
    return tidy(out)


# --- cubes and tables ----------------------------------------------------------------------


@query(
    "cube_means",
    """
WITH t AS (SELECT pickup_nhood, avg(tip_pct) AS tip_pct, count(*) AS "Counts" FROM trips
           WHERE pickup_nhood IN (SELECT nhood FROM nhoods) GROUP BY 1)
SELECT n_name AS pickup_nhood, round(tip_pct, 10) AS tip_pct, coalesce("Counts", 0) AS "Counts"
FROM nation LEFT JOIN t ON n_name = pickup_nhood
""",
    "trips nhoods",
)
def cube_means(spark, sf):
    df = trips_with_share(spark, sf, "pickup_nhood", pickup_in=nations_of(spark, sf))
    return tidy(tables.cube_means(df, "tip_pct", "pickup_nhood", read_table(spark, sf, "nation").select("n_name")), 10)


@query(
    "cube_binned",
    """
WITH c AS (SELECT CAST(floor(SO2_MEAN) AS BIGINT) AS s, CAST(floor(CO_MEAN) AS BIGINT) AS k, avg(NO2_MEAN) AS m,
           count(*) AS n FROM pollution WHERE NO2_MEAN IS NOT NULL AND SO2_MEAN IS NOT NULL AND CO_MEAN IS NOT NULL
           GROUP BY 1, 2),
e AS (SELECT min(s) AS s0, max(s) AS s1, min(k) AS k0, max(k) AS k1 FROM c),
g AS (SELECT s, unnest(range(k0, k1 + 1)) AS k FROM (SELECT unnest(range(s0, s1 + 1)) AS s, k0, k1 FROM e))
SELECT g.s AS SO2_MEAN, g.k AS CO_MEAN, round(m, 6) AS NO2_MEAN, coalesce(n, 0) AS "Counts"
FROM g LEFT JOIN c ON g.s = c.s AND g.k = c.k
""",
    "pollution",
)
def cube_binned(spark, sf):
    return tidy(tables.cube_binned(raw_pollution(spark, sf), "NO2_MEAN", "SO2_MEAN", "CO_MEAN", empty_bins=True))


@query(
    "table_oneway",
    'SELECT Subscription, count(*) AS "count", round(count(*) / (SELECT count(*) FROM subs), 6) AS share '
    "FROM subs GROUP BY Subscription",
    "subs",
)
def table_oneway(spark, sf):
    return tidy(tables.table_oneway(subs(spark, sf, "Subscription"), "Subscription"))


@query(
    "table_twoway",
    'SELECT FavCategory, count(*) FILTER (Subscription = 0) AS "0", count(*) FILTER (Subscription = 1) AS "1" '
    "FROM subs GROUP BY FavCategory",
    "subs",
)
def table_twoway(spark, sf):
    return tables.table_twoway(subs(spark, sf, "FavCategory", "Subscription"), "FavCategory", "Subscription", [0, 1])


@query(
    "crosstab_chisq",
    """
WITH a AS (SELECT DISTINCT FavCategory FROM subs), b AS (SELECT DISTINCT Subscription FROM subs),
o AS (SELECT FavCategory, Subscription, count(*) AS n FROM subs GROUP BY 1, 2),
c AS (SELECT a.FavCategory, b.Subscription, coalesce(n, 0) AS n FROM a CROSS JOIN b
      LEFT JOIN o ON a.FavCategory = o.FavCategory AND b.Subscription = o.Subscription),
t AS (SELECT *, sum(n) OVER (PARTITION BY FavCategory) AS rt, sum(n) OVER (PARTITION BY Subscription) AS ct,
      sum(n) OVER () AS tt FROM c),
x AS (SELECT *, rt * ct / tt AS e FROM t)
SELECT FavCategory, Subscription, n, round(n / rt, 6) AS row_share, round(e, 6) AS expected,
       round(pow(n - e, 2) / e, 6) AS contribution, round(sum(pow(n - e, 2) / e) OVER (), 6) AS chisq,
       (SELECT (SELECT count(*) FROM a) - 1) * (SELECT (SELECT count(*) FROM b) - 1) AS df FROM x
""",
    "subs",
)
def crosstab_chisq(spark, sf):
    return tidy(tables.crosstab_chisq(subs(spark, sf, "FavCategory", "Subscription"), "FavCategory", "Subscription"))


@query(
    "crosstab_chisq_test",
    """
WITH o AS (SELECT c_mktsegment AS a, o_orderstatus AS b, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey
           GROUP BY 1, 2),
t AS (SELECT *, sum(n) OVER (PARTITION BY a) * sum(n) OVER (PARTITION BY b) / sum(n) OVER () AS e FROM o),
x AS (SELECT sum(pow(n - e, 2) / e) AS s, (count(DISTINCT a) - 1) * (count(DISTINCT b) - 1) AS df FROM t)
SELECT round(s, 6) AS statistic, df,
  round(exp(-s / 2) * (1 + s / 2 + pow(s / 2, 2) / 2 + pow(s / 2, 3) / 6), 6) AS p_value FROM x
""",
)
def crosstab_chisq_test(spark, sf):
    # Five segments by three states: for 8 degrees of freedom the p-value has a closed form to compare with.
    customer = read_table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    orders = read_table(spark, sf, "orders").select("o_custkey", "o_orderstatus")
    df = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return tidy(tables.chisq_test(df, "c_mktsegment", "o_orderstatus"))


_PAIRS = [(x, y) for x in LINE_MEASURES for y in LINE_MEASURES]


@query(
    "correlation_matrix",
    " UNION ALL ".join(
        f"SELECT '{x}' AS x, '{y}' AS y, "
        + ("1.0::DOUBLE" if x == y else f"round(corr({x}, {y}), 6)")
        + " AS r FROM "
        + ("(SELECT 1)" if x == y else "lineitem")
        for x, y in _PAIRS
    ),
)
def correlation_matrix(spark, sf):
    return tidy(tables.correlation_matrix(read_table(spark, sf, "lineitem"), LINE_MEASURES))


TILE_LEVELS = [f"NATION_{i}" for i in (2, 7, 12, 17, 22)]


@query(
    "tile_matrix",
    "SELECT dropoff_nhood, "
    + ", ".join(f"round(avg(tip_pct) FILTER (pickup_nhood = '{n}'), 10) AS {n}" for n in TILE_LEVELS)
    + " FROM trips WHERE pickup_nhood IN (SELECT nhood FROM nhoods) AND dropoff_nhood IN (SELECT nhood FROM nhoods) GROUP BY dropoff_nhood",
    "trips nhoods",
)
def tile_matrix(spark, sf):
    # Both lists thin out the small tables before the large ones meet.
    home = nations_of(spark, sf)
    df = trips_with_share(spark, sf, "pickup_nhood", "dropoff_nhood", pickup_in=home, dropoff_in=home)
    levels = tables.levels_of(home, "nhood")
    return tidy(tables.tile_matrix(df, "dropoff_nhood", "pickup_nhood", levels, "tip_pct"), 10)
