"""History and projection on hand-made measurements."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyframe.functions import calendar as cal
from tallyframe.plans import air_quality as aq

SCHEMA = (
    "`Address` string, `State` string, `City` string, `County` string, `Site Num` int, `Date Local` date, "
    "`NO2 Mean` double, `O3 Mean` double, `SO2 Mean` double, `CO Mean` double"
)


@pytest.fixture(scope="module")
def past(spark):
    day = lambda i: dt.date(2016, 2, 20) + dt.timedelta(days=i)
    rows = []
    for i in range(10):
        # Station one: a row over the ceiling on day 3, two rows on day 5, and under two spellings.
        rows.append((" 1 elm st." if i % 2 else "1 Elm St", "oh ", "x", "y", 1, day(i), float(i), 1.0, 200.0 if i == 3 else 2.0, 3.0))
    rows.append((" 1 elm st.", "oh ", "x", "y", 1, day(5), 15.0, 1.0, 4.0, 3.0))
    for i in range(3):
        rows.append(("0 oak", "oh", "x", "y", 2, day(i), None if i == 1 else float(i), 1.0, 2.0, 3.0))
    raw = spark.createDataFrame(rows, SCHEMA)
    return aq.clean_history(raw, cal.dim_date(spark, "2016-01-01", "2017-12-31")).cache()


def test_history(past):
    assert len(past.columns) == 47
    rows = {(r.ADDRESS, r.DATE.day + 31 * r.DATE.month): r for r in past.collect()}
    elm = [r for r in past.orderBy("DATE").collect() if r.ADDRESS == "1_ELM_ST"]
    assert len(elm) == 9 and {r.DIM_ADDRESS_KEY for r in elm} == {2} and {r.STATE for r in elm} == {"OH"}
    # Day 5 is the mean of two rows; day 3 is gone, so lag 1 of day 4 is day 2.
    by_day = {r.DATE: r for r in elm}
    assert by_day[dt.date(2016, 2, 25)].NO2_MEAN == 10.0
    assert by_day[dt.date(2016, 2, 24)].NO2_MEAN_LAG_1 == 2.0
    median = sorted(r.NO2_MEAN for r in elm)[4]
    assert elm[0].NO2_MEAN_LAG_1 == median and elm[8].NO2_MEAN_LAG_7 == elm[1].NO2_MEAN
    assert elm[0].DIM_DATE_KEY == 31 + 20
    oak = [r for r in past.orderBy("DATE").collect() if r.ADDRESS == "0_OAK"]
    # A missing value makes the station's median missing, and with it every unfilled lag.
    assert [r.NO2_MEDIAN for r in oak] == [None] * 3
    assert [r.NO2_MEAN_LAG_1 for r in oak] == [None, 0.0, None]
    assert rows


def test_history_with_split_station(spark, past):
    raw = spark.createDataFrame(
        [("1 Elm St", "oh", "x", "y", 1, dt.date(2016, 1, 1) + dt.timedelta(days=i), float(i), 1.0, 2.0, 3.0) for i in range(300)],
        SCHEMA,
    )
    calendar = cal.dim_date(spark, "2016-01-01", "2017-12-31")
    got = {r.DATE: r.NO2_MEAN_LAG_7 for r in aq.clean_history(raw, calendar).collect()}
    start = dt.date(2016, 1, 1)
    assert len(got) == 300 and all(got[start + dt.timedelta(days=i)] == (i - 7 if i >= 7 else 149.5) for i in range(300))


def test_projection(past):
    future = aq.project(past, days=10)
    assert len(future.columns) == 42
    last = past.agg(F.max("DATE")).first()[0]
    ahead = future.filter(F.col("DATE") > last)
    assert ahead.count() == 2 * 10
    elm = ahead.filter("DIM_ADDRESS_KEY = 2").orderBy("DATE").collect()
    # No history on these days of the year: every mean is the median, and so is every lag.
    assert {r.NO2_MEAN for r in elm} == {elm[0].NO2_MEDIAN} and elm[0].NO2_MEAN_LAG_1 == elm[0].NO2_MEDIAN
    # Eight dates of history stay in front.
    tail = future.filter(F.col("DATE") <= last).select("DATE").distinct().count()
    assert tail <= 8 and future.agg(F.min("DATE")).first()[0] >= last - dt.timedelta(days=7)
    linked = aq.project(past, days=10, lags_from_history=True).filter("DIM_ADDRESS_KEY = 2").orderBy("DATE").collect()
    first = next(r for r in linked if r.DATE == last + dt.timedelta(days=1))
    assert first.NO2_MEAN_LAG_1 == 9.0
    floored = aq.project(past, days=10, floor="2016-03-05")
    assert floored.agg(F.min("DATE")).first()[0] >= dt.date(2016, 3, 5)
