"""Null rules, text, calendar, key hashes."""

import datetime as dt

from pyspark.sql import functions as F

from tallyframe.functions import calendar as cal
from tallyframe.functions import keys, nulls, strings
from tallyframe.operators import rows, splits
from tallyframe.sources import files, sinks


def values(df, col="v"):
    return [r[col] for r in df.collect()]


def test_membership_is_never_missing(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "i int, x string")
    assert values(df.select(nulls.is_in("x", ["a"]).alias("v"))) == [True, False, False]
    assert values(df.filter(nulls.not_in("x", ["a"])).orderBy("i"), "i") == [2, 3]


def test_if_else_keeps_missing_conditions_missing(spark):
    df = spark.createDataFrame([(1,), (None,), (0,)], "x int")
    assert values(df.select(nulls.if_else(F.col("x") == 1, "yes", "no").alias("v"))) == ["yes", None, "no"]


def test_strict_mean(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", 1.0), ("b", 3.0)], "g string, x double")
    out = dict(df.groupBy("g").agg(nulls.strict_mean("x").alias("m")).collect())
    assert out == {"a": None, "b": 2.0}


def test_missing_values_sort_last_both_ways(spark):
    df = spark.createDataFrame([(None,), (1,), (2,)], "x int")
    assert values(rows.arrange(df, "x"), "x") == [1, 2, None]
    assert values(rows.arrange(df, "-x"), "x") == [2, 1, None]


def test_division_by_zero_is_missing(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 2.0), (None, 2.0)], "a double, b double")
    assert values(df.select(nulls.ratio("a", "b").alias("v"))) == [None, 0.5, None]


def test_round_half_to_even(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (2.0005,)], "x double")
    assert values(df.select(F.bround("x", 0).alias("v")))[:3] == [0.0, 2.0, 2.0]
    assert values(df.select(F.bround("x", 3).alias("v")))[3] == 2.0


def test_text(spark):
    df = spark.createDataFrame([("\t 12  Main-St. #3 é\n",), ("o'neil street",)], "x string")
    # Two inner blanks stay two underscores; non-ASCII letters and punctuation go.
    assert values(df.select(strings.clean_key(F.col("x")).alias("v"))) == ["12__MAIN-ST_3_", "ONEIL_STREET"]
    assert values(df.select(strings.trim_all(F.col("x")).alias("v")))[0] == "12  Main-St. #3 é"
    assert values(df.select(strings.proper(F.col("x")).alias("v")))[1] == "O'neil Street"
    one = spark.createDataFrame([("aB.cD",)], "x string")
    assert values(one.select(strings.proper(F.col("x"), ".").alias("v"))) == ["Ab.Cd"]


def test_calendar_known_days(spark):
    expected = [
        ("2016-01-01", 6, 1, 1, "Winter", "New_Years_Day"),
        ("2016-03-27", 1, 13, 4, "Spring", "Easter"),
        ("2016-05-08", 1, 19, 2, "Spring", "Mothers_Day"),
        ("2016-05-30", 2, 22, 5, "Spring", "Memorial_day"),
        ("2016-06-21", 3, 25, 3, "Summer", "Non_Holiday"),
        ("2016-07-10", 1, 28, 2, "Summer", "Fathers_Day"),
        ("2016-09-05", 2, 36, 1, "Summer", "Labor_Day"),
        ("2016-11-24", 5, 47, 4, "Fall", "Thanksgiving_Day"),
        ("2016-12-21", 4, 51, 3, "Winter", "Non_Holiday"),
        ("2016-12-31", 7, 53, 5, "Winter", "New_Years_Eve"),
    ]
    table = {r["DATE"].isoformat(): r for r in cal.dim_date(spark, "2016-01-01", "2016-12-31").collect()}
    assert len(table) == 366
    for day, dow, woy, wom, season, holiday in expected:
        r = table[day]
        assert (r.DAY_OF_WEEK, r.WEEK_OF_YEAR, r.WEEK_OF_MONTH, r.SEASON, r.HOLIDAY) == (dow, woy, wom, season, holiday)
    assert table["2016-02-29"].SEASON == "Winter"
    assert table["2016-01-01"].DIM_DATE_KEY == 1


def test_corrected_fathers_day(spark):
    df = spark.createDataFrame([(dt.date(2016, 6, 19),), (dt.date(2016, 7, 10),)], "d date")
    assert values(df.select(cal.fixed_holiday(F.col("d"), corrected=True).alias("v"))) == ["Fathers Day", "Non-Holiday"]


def test_easter(spark):
    known = {1999: (4, 4), 2008: (3, 23), 2011: (4, 24), 2019: (4, 21), 2024: (3, 31), 2038: (4, 25)}
    df = spark.createDataFrame([(y,) for y in known], "y int")
    got = df.select("y", cal.easter(F.col("y")).alias("v")).collect()
    assert {r.y: (r.v.month, r.v.day) for r in got} == known


def test_key_hash_spreads_and_never_ties(spark):
    df = spark.range(100_000).withColumn("big", F.col("id") * 98_765_432_101)
    for key in ("id", "big"):
        r = df.agg(
            F.countDistinct(keys.key_order(F.col(key))).alias("n"),
            F.avg((keys.key_hash(F.col(key)) < int(0.75 * keys.RANGE)).cast("int")).alias("share"),
        ).first()
        assert r.n == 100_000 and abs(r.share - 0.75) < 0.01


def test_seeds_draw_independently(spark):
    label = lambda seed: splits.train_label("id", 0.75, seed)
    df = spark.range(100_000)
    for a, b in ((1, 2), (1, 123_456), (0, 1)):
        agree = df.filter(label(a) == label(b)).count() / 100_000
        assert abs(agree - 0.625) < 0.01
    missing = spark.createDataFrame([(None,), (5,)], "id bigint").select(splits.fold_label("id", 10).alias("f")).collect()
    assert all(r.f is not None for r in missing)


def test_csv_keeps_texts(spark, tmp_path):
    texts = ["a\nb", "", None, " lead", "trail ", 'say "x", y', "c\r\nd", "\\N x", "tab\there", "#no comment"]
    df = spark.createDataFrame(list(enumerate(texts)), "i bigint, t string")
    sinks.write_csv(df, str(tmp_path / "csv"))
    back = files.read_csv(spark, str(tmp_path / "csv"), "i bigint, t string")
    assert sorted(map(tuple, back.collect())) == list(enumerate(texts))


def test_sample_n_is_exact_and_repeatable(spark):
    df = spark.range(10_000)
    first = {r.id for r in rows.sample_n(df, 500, "id").collect()}
    again = {r.id for r in rows.sample_n(df.repartition(7), 500, "id").collect()}
    assert len(first) == 500 and first == again
    assert rows.sample_n(df, 20_000, "id").count() == 10_000
