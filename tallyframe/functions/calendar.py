"""Calendar expressions and the date dimension."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.functions.strings import underscore

# Holiday names, and the day they fall on.
FIXED_DAY_HOLIDAYS = [  # name, month, day
    ("Christmas Eve", 12, 24),
    ("Christmas Day", 12, 25),
    ("Valentines Day", 2, 14),
    ("New Years Eve", 12, 31),
    ("New Years Day", 1, 1),
    ("Independence Day", 7, 4),
    ("Veterans Day", 11, 11),
    ("St Patricks Day", 3, 17),
]
NTH_WEEKDAY_HOLIDAYS = [  # name, month, weekday (Sunday = 1), week of month
    ("Thanksgiving Day", 11, 5, 4),
    ("Mothers Day", 5, 1, 2),
    ("Fathers Day", 7, 1, 2),
]
NO_HOLIDAY = "Non-Holiday"
EASTER, LABOR_DAY, MEMORIAL_DAY = "Easter", "Labor Day", "Memorial day"
# First month*100+day of each season.
SEASON_STARTS = [("Spring", 321), ("Summer", 621), ("Fall", 921), ("Winter", 1221)]

# A calendar this long is still a few megabytes, safe to broadcast.


def week_of_year(d: Column) -> Column:
    """Whole weeks since 1 January, counted from 1 (not the ISO week)."""
    return (F.floor((F.dayofyear(d) - 1) / 7) + 1).cast("int")


def week_of_month(d: Column) -> Column:
    return F.ceil(F.dayofmonth(d) / 7).cast("int")


def weekend(d: Column) -> Column:
    return F.when(F.dayofweek(d).isin(1, 7), "Weekend").otherwise("Weekday")


def season(d: Column) -> Column:
    """Season by month and day alone; 29 February is winter like its neighbours."""
    md = F.month(d) * 100 + F.dayofmonth(d)
    out = F.lit("Winter")
    for name, start in SEASON_STARTS:
        out = F.when(md >= start, name).otherwise(out)
    return F.when(d.isNotNull(), out)


def fixed_holiday(d: Column, corrected: bool = False) -> Column:
    """Holiday fixed by date or by weekday of the month, else "Non-Holiday".

    Father's Day sits on the second Sunday of July, as in the data this
    calendar must match; ``corrected=True`` moves it to the third of June.
    """
    month, day = F.month(d), F.dayofmonth(d)
    out = None
    for name, m, dom in FIXED_DAY_HOLIDAYS:
        hit = (month == m) & (day == dom)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    for name, m, wd, nth in NTH_WEEKDAY_HOLIDAYS:
        if corrected and name == "Fathers Day":
            m, nth = 6, 3
        out = out.when((month == m) & (F.dayofweek(d) == wd) & (week_of_month(d) == nth), name)
    return out.otherwise(NO_HOLIDAY)


def easter(year: Column) -> Column:
    """Gregorian Easter Sunday by the anonymous computus, in integer arithmetic."""
    div = lambda x, n: F.floor(x / n)
    mod = lambda x, n: F.pmod(x, F.lit(n))
    century = div(year, 100)
    golden = mod(year, 19)
    epact = mod(19 * golden + century - div(century, 4) - div(century - div(century + 8, 25) + 1, 3) + 15, 30)
    weekday = mod(32 + 2 * mod(century, 4) + 2 * div(mod(year, 100), 4) - epact - mod(mod(year, 100), 4), 7)
    late = div(golden + 11 * epact + 22 * weekday, 451)
    n = epact + weekday - 7 * late + 114
    return F.make_date(year.cast("int"), div(n, 31).cast("int"), (mod(n, 31) + 1).cast("int"))


def movable_holiday(d: Column) -> Column:
    """Easter, first Monday of September, last Monday of May; else missing."""
    month, day, monday = F.month(d), F.dayofmonth(d), F.dayofweek(d) == 2
    return (
        F.when(d == easter(F.year(d)), EASTER)
        .when((month == 9) & monday & (day <= 7), LABOR_DAY)
        .when((month == 5) & monday & (day >= 25), MEMORIAL_DAY)
    )


def holiday(d: Column, corrected: bool = False) -> Column:
    """Movable holidays override fixed ones; hyphens and blanks become ``_``."""
    return underscore(F.coalesce(movable_holiday(d), fixed_holiday(d, corrected)))


def date_series(spark: SparkSession, first: str, last: str, name: str = "DATE") -> DataFrame:
    """One row per day from ``first`` to ``last``."""
    days = (dt.date.fromisoformat(last) - dt.date.fromisoformat(first)).days + 1
    if days <= 0:
        raise ValueError(f"{last} is before {first}")
    day = F.date_add(F.to_date(F.lit(first)), F.col("id").cast("int"))
    return spark.range(days).select((F.col("id") + 1).cast("int").alias("DIM_DATE_KEY"), day.alias(name))


def dim_date(spark: SparkSession, first: str, last: str, corrected: bool = False) -> DataFrame:
    """The 18-column calendar dimension."""
    d = F.col("DATE")
    return date_series(spark, first, last).select(
        "DIM_DATE_KEY",
        "DATE",
        F.dayofyear(d).alias("DAY_OF_YEAR"),
        F.year(d).alias("YEAR"),
        F.dayofmonth(d).alias("DAY_OF_MONTH"),
        F.month(d).alias("MONTH_NUM"),
        F.date_format(d, "MMM").alias("MONTH_DAY_ABBR"),
        F.date_format(d, "MMMM").alias("MONTH_DAY"),
        F.dayofweek(d).alias("DAY_OF_WEEK"),
        F.date_format(d, "E").alias("WEEK_DAY_ABBR"),
        F.date_format(d, "EEEE").alias("WEEK_DAY"),
        week_of_year(d).alias("WEEK_OF_YEAR"),
        week_of_month(d).alias("WEEK_OF_MONTH"),
        weekend(d).alias("WEEKEND"),
        F.quarter(d).alias("QUARTER"),
        F.concat(F.lit("Q"), F.quarter(d)).alias("QUARTER_FORM"),
        season(d).alias("SEASON"),
        holiday(d, corrected).alias("HOLIDAY"),
    )
