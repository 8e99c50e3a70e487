"""From raw station measurements to a year-ahead forecast.

    raw file -> clean_history -> project -> fit_pollutants -> forecast
                     |-> address_dim          |-> all_view, star_load

Each stage reads the one before it several times, so a stage's result is
written to the shared folder once (``materialize``) where that saves repeating
its shuffles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.nulls import strict_mean
from tallyframe.functions.strings import clean_key, trim_all
from tallyframe.operators import joins
from tallyframe.operators import select as sel
from tallyframe.operators.distribute import dense_key, lag_columns, lag_in_groups
from tallyframe.operators.formula import model_terms
from tallyframe.operators.models import Fit, estimate_model, linear_regression
from tallyframe.operators.quantiles import group_medians
from tallyframe.operators.rows import stack
from tallyframe.operators.scoring import score_chain
from tallyframe.operators.windows import fill_from
from tallyframe.plans.bases import MEANS, POLLUTANTS
from tallyframe.session import materialize, shuffle_partitions

STATION = ["ADDRESS", "STATE", "CITY", "COUNTY"]
MEDIANS = {f"{p}_MEAN": f"{p}_MEDIAN" for p in POLLUTANTS}
LAG_DAYS = range(1, 8)
LAGS = {f"{p}_MEAN_LAG_{k}": f"{p}_MEDIAN" for p in POLLUTANTS for k in LAG_DAYS}
# Ceiling on SO2, and columns no model uses.
SO2_CEILING = 100
NOT_PREDICTORS = ["DATE", "COUNTY", "STATE", "SITE_NUM", "DIM_DATE_KEY", "CITY", *MEDIANS.values(), "ADDRESS"]
HISTORY_COLUMNS = [
    "ADDRESS", "DATE", "STATE", "CITY", "COUNTY", "SITE_NUM", *MEANS, "YEAR", "MONTH", "DAY", "DIM_ADDRESS_KEY",
    *LAGS, *MEDIANS.values(), "DIM_DATE_KEY",
]
PROJECTED_COLUMNS = [
    "DIM_DATE_KEY", "DIM_ADDRESS_KEY", "DATE", "MONTH", "DAY", "YEAR", *MEANS, *MEDIANS.values(), *LAGS,
]


def daily_means(raw: DataFrame) -> DataFrame:
    """Daily means per station under cleaned names, without the days above the SO2 ceiling; a mean is missing if any input is."""
    named = sel.upper_names(raw).withColumnRenamed("DATE_LOCAL", "DATE")
    daily = named.groupBy("ADDRESS", "DATE", "STATE", "CITY", "COUNTY", "SITE_NUM").agg(
        *[strict_mean(m).alias(m) for m in MEANS]
    )
    return daily.select(
        F.col("ADDRESS").alias("_RAW_ADDRESS"),
        "DATE",
        clean_key(F.col("ADDRESS")).alias("ADDRESS"),
        *[clean_key(trim_all(F.col(c))).alias(c) for c in STATION[1:]],
        "SITE_NUM",
        *MEANS,
        F.year("DATE").alias("YEAR"),
        F.month("DATE").alias("MONTH"),
        F.dayofmonth("DATE").alias("DAY"),
    ).filter(F.col("SO2_MEAN") <= SO2_CEILING)


def keyed_days(days: DataFrame) -> DataFrame:
    """Daily means with the dense key of their address."""
    return dense_key(days, "ADDRESS", "DIM_ADDRESS_KEY")


def clean_history(raw: DataFrame, calendar: DataFrame) -> DataFrame:
    """Daily means per station with keys, 28 lags and 4 medians.

    Means and medians are missing if any input is. Lags count rows, not days,
    after the SO2 ceiling has removed some; they are ordered by date, then by
    the address before cleaning, since two raw addresses may clean to one key.
    A missing lag takes the station's median.
    """
    days = materialize(daily_means(raw), "daily-means")
    order = ["DATE", "_RAW_ADDRESS", "STATE", "CITY", "COUNTY", "SITE_NUM"]
    lagged = lag_columns(days, ["ADDRESS"], order, MEANS, LAG_DAYS)
    # One row per station: its key and its medians.
    stations = group_medians(days, ["ADDRESS"], MEDIANS, strict=True)
    with_medians = lagged.join(keyed_days(stations), "ADDRESS", "left")
    filled = fill_from(with_medians, LAGS)
    return joins.left_dim(filled, calendar, "DATE", "DIM_DATE_KEY").select(*HISTORY_COLUMNS)


def project(history: DataFrame, days: int = 365, floor: str | None = None, lags_from_history: bool = False) -> DataFrame:
    """The last 8 dates of history and ``days`` future days per station.

    A future day carries the station's mean for that month and day, else its
    median. Its lags look at future days only, so the first ones take the
    median; ``lags_from_history`` lets them reach back into history instead.
    ``floor`` drops rows dated before it.
    """
    ends = history.agg(F.max("DATE").alias("day"), F.max("DIM_DATE_KEY").alias("key")).first()
    last_day, last_key = F.lit(ends["day"]).cast("date"), F.lit(ends["key"])
    tail = history.filter(F.col("DATE") >= F.date_sub(last_day, 7))

    # One row per station, with its means by month and day (at most 366), grows to its days where it
    # lies; without a stated number of partitions stations would be merged by the size they have now.
    parts, key = shuffle_partitions(history.sparkSession), "DIM_ADDRESS_KEY"
    month_day = F.col("MONTH") * 100 + F.col("DAY")
    means = sel.agg_across(history.filter(F.col("DATE").isNotNull()), [key, "MONTH", "DAY"], MEANS, F.avg)
    means = means.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct(month_day.alias("d"), F.struct(*MEANS).alias("m")))).alias("_means"))
    medians = group_medians(history, [key], MEDIANS)
    stations = medians.join(means, key, "left").repartition(parts, key)
    grid = (
        joins.day_grid(stations, last_day, days)
        .withColumn("DIM_DATE_KEY", last_key + F.datediff("DATE", last_day))
        .withColumns({"MONTH": F.month("DATE"), "DAY": F.dayofmonth("DATE"), "YEAR": F.year("DATE")})
        .withColumn("_mean", F.try_element_at("_means", month_day))
    )
    expected = fill_from(grid.withColumns({m: F.col("_mean")[m] for m in MEANS}).drop("_mean", "_means"), MEDIANS)
    # A station has `days` rows here, so no group can grow hot.
    if lags_from_history:
        near = tail.select("DIM_ADDRESS_KEY", "DATE", *MEANS, F.lit(True).alias("_past"))
        both = stack(expected.withColumn("_past", F.lit(False)), near, pad=True)
        lagged = lag_in_groups(both, ["DIM_ADDRESS_KEY"], ["DATE"], MEANS, LAG_DAYS)
        lagged = lagged.filter(~F.col("_past")).drop("_past")
    else:
        lagged = lag_in_groups(expected, ["DIM_ADDRESS_KEY"], ["DATE"], MEANS, LAG_DAYS)
    out = fill_from(stack(tail.select(*PROJECTED_COLUMNS), lagged.select(*PROJECTED_COLUMNS)), LAGS)
    return out.filter(F.col("DATE") >= F.lit(floor).cast("date")) if floor else out


def address_dim(days: DataFrame) -> DataFrame:
    """Distinct stations with their key, from keyed days or the history."""
    return days.select("DIM_ADDRESS_KEY", "SITE_NUM", *STATION).distinct()


def as_levels(df: DataFrame) -> DataFrame:
    """Month, day and station as level columns."""
    return df.withColumns({c: F.col(c).cast("string") for c in ("MONTH", "DAY", "DIM_ADDRESS_KEY")})


def fit_pollutants(history: DataFrame, responses: list[str] = MEANS) -> dict[str, Fit]:
    """One linear model per pollutant: pairwise products of the others, lags, calendar and station levels.

    Stations are absorbed: each has a level of its own, found from its means, whatever their number.
    """
    data, absorb = as_levels(history), "DIM_ADDRESS_KEY"
    fits = {}
    for response in responses:
        terms = model_terms(data.columns, response, MEANS, NOT_PREDICTORS)
        mains = [t[0] for t in terms if len(t) == 1 and t[0] != absorb]
        products = [t for t in terms if len(t) == 2]
        fits[response] = estimate_model(
            data, response, mains, linear_regression(), products, drop_singular=True, absorb=absorb
        )
    return fits


def forecast(projection: DataFrame, fits: dict[str, Fit]) -> DataFrame:
    """Score every projected row with each pollutant's model, rounded to 3 digits, ties to even.

    Days whose level a model has not seen keep their row with a missing value.
    """
    scored = score_chain(
        as_levels(projection), {f"{m}_PRED": fit for m, fit in fits.items()}, ["DIM_ADDRESS_KEY", "DIM_DATE_KEY"]
    )
    return scored.select(
        F.col("DIM_ADDRESS_KEY").cast("bigint").alias("DIM_ADDRESS_KEY"),
        F.col("DIM_DATE_KEY").cast("bigint").alias("DIM_DATE_KEY"),
        *[F.bround(f"{m}_PRED", 3).alias(m) for m in fits],
    )


def all_view(history: DataFrame, predicted: DataFrame) -> DataFrame:
    """History and predictions stacked, each side's measures missing on the other; ``_source`` tells them apart."""
    keys = ["DIM_ADDRESS_KEY", "DIM_DATE_KEY"]
    side = lambda df, tag: df.select(*keys, *[F.col(m).alias(f"{m}_{tag}") for m in MEANS], F.lit(tag).alias("_source"))
    return stack(side(history, "HIST"), side(predicted, "PRED"), pad=True)
