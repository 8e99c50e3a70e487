"""Registered queries: date parts, the calendar dimension, and its single rules over the tables' own dates."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.functions import calendar as cal
from tallyframe.plans.bases import read_table
from tallyframe.plans.catalog.selection import raw_pollution
from tallyframe.plans.catalog.shape import tidy
from tallyframe.plans.registry import query


def days_of_orders(spark, sf):
    return read_table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"))


def _rule(expr: str, name: str) -> str:
    return f"SELECT o_orderkey, {expr} AS {name} FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)"


# The calendar rules in SQL, over a date column d.
DOW = "(dayofweek({d}) + 1)"
WEEK_OF_YEAR = "CAST((dayofyear({d}) - 1) // 7 + 1 AS BIGINT)"
WEEK_OF_MONTH = "CAST((day({d}) + 6) // 7 AS BIGINT)"
WEEKEND = "CASE WHEN dayofweek({d}) IN (0, 6) THEN 'Weekend' ELSE 'Weekday' END"
SEASON = (
    "CASE WHEN month({d}) * 100 + day({d}) >= 1221 OR month({d}) * 100 + day({d}) < 321 THEN 'Winter' "
    "WHEN month({d}) * 100 + day({d}) < 621 THEN 'Spring' WHEN month({d}) * 100 + day({d}) < 921 THEN 'Summer' "
    "ELSE 'Fall' END"
)
NTH = "((day({d}) + 6) // 7)"
FIXED = (
    "CASE strftime({d}, '%m-%d') WHEN '12-24' THEN 'Christmas Eve' WHEN '12-25' THEN 'Christmas Day' "
    "WHEN '02-14' THEN 'Valentines Day' WHEN '12-31' THEN 'New Years Eve' WHEN '01-01' THEN 'New Years Day' "
    "WHEN '07-04' THEN 'Independence Day' WHEN '11-11' THEN 'Veterans Day' WHEN '03-17' THEN 'St Patricks Day' "
    f"ELSE CASE WHEN month({{d}}) = 11 AND dayofweek({{d}}) = 4 AND {NTH} = 4 THEN 'Thanksgiving Day' "
    f"WHEN month({{d}}) = 5 AND dayofweek({{d}}) = 0 AND {NTH} = 2 THEN 'Mothers Day' "
    f"WHEN month({{d}}) = 7 AND dayofweek({{d}}) = 0 AND {NTH} = 2 THEN 'Fathers Day' ELSE 'Non-Holiday' END END"
)
# Easter from the paschal full moon (Butcher's rule), one step per sub-select.
EASTER_SQL = """
SELECT y, CAST(make_date(y, (h + l - 7 * m + 114) // 31, (h + l - 7 * m + 114) % 31 + 1) AS DATE) AS easter FROM (
 SELECT *, (a + 11 * h + 22 * l) // 451 AS m FROM (
  SELECT *, (32 + 2 * (b % 4) + 2 * (c // 4) - h - c % 4) % 7 AS l FROM (
   SELECT *, (19 * a + b - b // 4 - (b - (b + 8) // 25 + 1) // 3 + 15) % 30 AS h FROM (
    SELECT y, y % 19 AS a, y // 100 AS b, y % 100 AS c FROM ({years})))))
"""
MOVABLE = (
    "CASE WHEN {d} = easter THEN 'Easter' WHEN month({d}) = 9 AND dayofweek({d}) = 1 AND day({d}) <= 7 THEN 'Labor Day' "
    "WHEN month({d}) = 5 AND dayofweek({d}) = 1 AND day({d}) >= 25 THEN 'Memorial day' END"
)


@query(
    "date_parts",
    _rule("CAST(year(d) AS BIGINT) AS YEAR, CAST(month(d) AS BIGINT) AS MONTH, CAST(day(d) AS BIGINT)", "DAY"),
)
def date_parts(spark, sf):
    df = days_of_orders(spark, sf)
    return tidy(df.select("o_orderkey", F.year("d").alias("YEAR"), F.month("d").alias("MONTH"), F.dayofmonth("d").alias("DAY")))


@query(
    "date_parse",
    """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, TRY_CAST(o_orderpriority AS DATE) AS bad FROM orders
""",
)
def date_parse(spark, sf):
    text = read_table(spark, sf, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy/MM/dd").alias("text"), "o_orderpriority"
    )
    return text.select(
        "o_orderkey",
        F.try_to_date("text", "yyyy/MM/dd").alias("d"),
        F.try_to_date("o_orderpriority", "yyyy-MM-dd").alias("bad"),
    )


@query(
    "date_series",
    "SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS DATE FROM "
    "(SELECT min(DATE) AS lo, max(DATE) AS hi FROM pollution)",
    "pollution",
)
def date_series(spark, sf):
    # From the first to the last day of the measurements.
    first, last = raw_pollution(spark, sf).agg(F.min("DATE"), F.max("DATE")).first()
    return cal.date_series(spark, first.isoformat(), last.isoformat()).select("DATE")


CALENDAR_SQL = f"""
WITH days AS (SELECT row_number() OVER (ORDER BY d) AS k, d FROM (
  SELECT CAST(unnest(generate_series({{first}}, {{last}}, INTERVAL 1 DAY)) AS DATE) AS d {{source}})),
e AS ({EASTER_SQL.format(years='SELECT DISTINCT year(d) AS y FROM days')})
SELECT k AS DIM_DATE_KEY, d AS DATE, CAST(dayofyear(d) AS BIGINT) AS DAY_OF_YEAR, CAST(year(d) AS BIGINT) AS YEAR,
  CAST(day(d) AS BIGINT) AS DAY_OF_MONTH, CAST(month(d) AS BIGINT) AS MONTH_NUM, strftime(d, '%b') AS MONTH_DAY_ABBR,
  strftime(d, '%B') AS MONTH_DAY, CAST(dayofweek(d) + 1 AS BIGINT) AS DAY_OF_WEEK, strftime(d, '%a') AS WEEK_DAY_ABBR,
  strftime(d, '%A') AS WEEK_DAY, {WEEK_OF_YEAR.format(d='d')} AS WEEK_OF_YEAR, {WEEK_OF_MONTH.format(d='d')} AS WEEK_OF_MONTH,
  {WEEKEND.format(d='d')} AS WEEKEND, CAST(quarter(d) AS BIGINT) AS QUARTER, 'Q' || quarter(d) AS QUARTER_FORM,
  {SEASON.format(d='d')} AS SEASON,
  regexp_replace(coalesce({MOVABLE.format(d='d')}, {FIXED.format(d='d')}), '-| ', '_', 'g') AS HOLIDAY
FROM days JOIN e ON year(d) = y
"""


@query(
    "dim_date",
    CALENDAR_SQL.format(first="lo", last="hi", source="FROM (SELECT min(o_orderdate) AS lo, max(l_shipdate) AS hi FROM orders, (SELECT max(l_shipdate) AS l_shipdate FROM lineitem))"),
)
def dim_date(spark, sf):
    # The calendar spans the tables' own dates.
    first = read_table(spark, sf, "orders").agg(F.min(F.col("o_orderdate").cast("date"))).first()[0]
    last = read_table(spark, sf, "lineitem").agg(F.max(F.col("l_shipdate").cast("date"))).first()[0]
    return tidy(cal.dim_date(spark, first.isoformat(), last.isoformat()))


@query("date_week_of_year", _rule(WEEK_OF_YEAR.format(d="d"), "week"))
def date_week_of_year(spark, sf):
    return tidy(days_of_orders(spark, sf).select("o_orderkey", cal.week_of_year(F.col("d")).alias("week")))


@query("date_week_of_month", _rule(WEEK_OF_MONTH.format(d="d"), "week"))
def date_week_of_month(spark, sf):
    return tidy(days_of_orders(spark, sf).select("o_orderkey", cal.week_of_month(F.col("d")).alias("week")))


@query("date_weekend", _rule(WEEKEND.format(d="d"), "weekend"))
def date_weekend(spark, sf):
    return days_of_orders(spark, sf).select("o_orderkey", cal.weekend(F.col("d")).alias("weekend"))


@query("date_season", _rule(SEASON.format(d="d"), "season"))
def date_season(spark, sf):
    return days_of_orders(spark, sf).select("o_orderkey", cal.season(F.col("d")).alias("season"))


@query("date_holiday_fixed", _rule(FIXED.format(d="d"), "holiday"))
def date_holiday_fixed(spark, sf):
    return days_of_orders(spark, sf).select("o_orderkey", cal.fixed_holiday(F.col("d")).alias("holiday"))


@query(
    "date_holiday_movable",
    f"""
WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders),
e AS ({EASTER_SQL.format(years='SELECT DISTINCT year(d) AS y FROM o')})
SELECT o_orderkey, d, {MOVABLE.format(d='d')} AS holiday FROM o JOIN e ON year(d) = y
""",
)
def date_holiday_movable(spark, sf):
    return days_of_orders(spark, sf).select("o_orderkey", "d", cal.movable_holiday(F.col("d")).alias("holiday"))
