"""Split groups must give what unsplit ones give."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tallyframe.operators import apply, distribute, evaluation, joins, linear, quantiles, splits, summaries, tables, windows


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds most rows, one value holds a third of them, some keys and values are missing."""
    rng = np.random.default_rng(7)
    rows = []
    for i in range(3000):
        key = "hot" if i % 3 else rng.choice(["a", "b", None])
        value = 5.0 if i % 3 == 1 else float(np.round(rng.exponential(40), 1))
        rows.append((i, key and str(key), int(rng.integers(0, 400)), value if i % 11 else None))
    return spark.createDataFrame(rows, "id bigint, k string, t int, v double").cache()


def test_running_totals(skewed):
    present = skewed.filter("v IS NOT NULL")
    got = distribute.running_totals(present, "v", {"n": F.lit(1), "s": F.col("t")}, ["k"])
    by = present.groupBy("k", "v").agg(F.count("*").alias("n"), F.sum("t").alias("s"))
    w = W.partitionBy("k").orderBy("v").rowsBetween(W.unboundedPreceding, 0)
    want = by.select(
        "k", "v", "n", "s", F.sum("n").over(w).alias("n_run"), F.sum("s").over(w).alias("s_run"),
        F.sum("n").over(W.partitionBy("k")).alias("n_all"), F.sum("s").over(W.partitionBy("k")).alias("s_all"),
    )
    got = got.select(*want.columns)
    assert got.count() == want.count() and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_running_totals_descending_without_keys(skewed):
    got = distribute.running_totals(skewed.filter("v IS NOT NULL"), "v", {"n": F.lit(1)}, descending=True)
    rows = sorted(got.collect(), key=lambda r: -r.v)
    total = 0
    for r in rows:
        total += r.n
        assert r.n_run == total
    assert all(r.n_all == total for r in rows)


def test_quantiles_match_numpy(skewed):
    probs = [0.0, 0.05, 0.25, 0.5, 0.9, 1.0]
    got = {r.k: r for r in quantiles.quantiles(skewed, ["v"], probs, ["k"]).collect()}
    pdf = skewed.toPandas()
    for key in ("hot", "a", "b", None):
        x = pdf[pdf.k.isna() if key is None else pdf.k == key].v.dropna()
        want = np.quantile(x, probs)
        assert np.allclose([got[key][f"q{i}"] for i in range(len(probs))], want, atol=1e-9)
        assert got[key].n == len(x)


def test_median_strictness(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", 1.0), ("b", 4.0), ("c", None)], "g string, x double")
    loose = dict(quantiles.group_medians(df, ["g"], {"x": "m"}).collect())
    strict = dict(quantiles.group_medians(df, ["g"], {"x": "m"}, strict=True).collect())
    assert loose == {"a": 1.0, "b": 2.5, "c": None}
    assert strict == {"a": None, "b": 2.5, "c": None}


@pytest.mark.parametrize("partitions", ["1", "8", "64"])
@pytest.mark.parametrize("order", [["t", "id"], ["-t", "id"], ["name", "id"], ["-name", "-id"]])
def test_lags_of_hot_groups(spark, skewed, partitions, order):
    """Numeric, text and descending orders, with a group that spans several parts of the sort."""
    df = skewed.withColumn("name", F.concat(F.lit("n"), (F.col("t") % 97).cast("string")))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        for keys in (["k"], []):
            plain = distribute.lag_in_groups(df, keys, order, ["v", "id"], [1, 2, 7])
            split = distribute.lag_columns(df, keys, order, ["v", "id"], [1, 2, 7])
            assert split.columns == plain.columns and split.count() == 3000
            assert split.exceptAll(plain).isEmpty() and plain.exceptAll(split).isEmpty()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_row_positions_and_dense_key(skewed):
    numbered = distribute.row_positions(skewed, [F.col("v").asc_nulls_last(), F.col("id")], "n")
    want = skewed.withColumn("n", F.row_number().over(W.orderBy(F.col("v").asc_nulls_last(), "id")).cast("bigint"))
    got = numbered.select(*want.columns)
    assert got.exceptAll(want).isEmpty() and got.count() == 3000
    keys = dict(distribute.dense_key(skewed, "k", "r").select("k", "r").distinct().collect())
    assert keys == {"a": 1, "b": 2, "hot": 3, None: None}


def test_nan_and_missing_keys(spark):
    nan = float("nan")
    df = spark.createDataFrame([("a", 1.0), ("a", nan), ("a", 3.0), (None, 5.0), (None, 7.0), ("b", None)], "k string, v double")
    assert {r.k: r.q0 for r in quantiles.quantiles(df, ["v"], [0.5], ["k"]).collect()} == {"a": 2.0, None: 6.0}
    assert windows.cumulative_share(df, "v", ["k"]).count() == 4
    medians = {(r.k, r.m) for r in windows.with_group_medians(df.filter("k IS NULL"), ["k"], {"v": "m"}).collect()}
    assert medians == {(None, 6.0)}
    counted = joins.group_stats(df, ["k"], n=F.count(F.lit(1)))
    assert counted.columns == ["k", "v", "n"] and {r.n for r in counted.filter("k IS NULL").collect()} == {2}


def test_degenerate_columns(spark):
    df = spark.createDataFrame([("a", "x", 1.0, 2.0), ("a", None, 1.0, 3.0), (None, "x", 1.0, 4.0), (None, "x", 1.0, 4.0)], "r string, c string, one double, v double")
    cells = {(x.r, x.c): x.n for x in tables.crosstab_chisq(df, "r", "c").collect()}
    assert cells == {("a", "x"): 1, ("a", None): 1, (None, "x"): 2, (None, None): 0}
    r = {(x.x, x.y): x.r for x in tables.correlation_matrix(df, ["one", "v"]).collect()}
    assert r == {("one", "one"): None, ("one", "v"): None, ("v", "one"): None, ("v", "v"): 1.0}
    assert [tuple(x) for x in summaries.density_overlay(df, "one").collect()] == [(0, 1.0, None, None)]
    assert summaries.density_overlay(df.filter("v > 9"), "v").count() == 0
    boxes = {x.r: (x.n, x.median) for x in summaries.box_stats(df, "v", ["r"]).collect()}
    assert boxes == {"a": (2, 2.5), None: (2, 4.0)}
    folds = linear.out_of_fold_means(df, "v", "r", "c")
    assert folds.count() == 3 and folds.filter("r IS NULL").count() == 1
    wrong = evaluation.confusion_matrix(spark.createDataFrame([("Y", "Y"), ("Y", None)], "a string, p string"), "a", "p")
    assert {x.class_error for x in wrong.collect()} == {0.5}


def test_stratified_split_sizes(skewed):
    out = splits.stratified_label(skewed, "id", "k", 0.7)
    sizes = {(r.k, r.part): r["count"] for r in out.groupBy("k", "part").count().collect()}
    for k in ("hot", "a", "b", None):
        n = sizes[k, "train"] + sizes[k, "validate"]
        assert sizes[k, "train"] == int(np.ceil(0.7 * n))
    assert out.count() == 3000


def test_cumulative_share(skewed):
    out = windows.cumulative_share(skewed, "v", ["k"])
    top = out.groupBy("k").agg(F.max("share").alias("m")).collect()
    assert all(r.m == 1.0 for r in top)


def test_group_combine_equals_group_apply(skewed):
    import pandas as pd

    schema = "k string, n bigint, total bigint"
    f = lambda p: pd.DataFrame({"k": [p["k"].iloc[0]], "n": [len(p)], "total": [p["t"].sum()]})
    merge = lambda p: pd.DataFrame({"k": [p["k"].iloc[0]], "n": [p["n"].sum()], "total": [p["total"].sum()]})
    whole = {tuple(r) for r in apply.group_apply(skewed.select("k", "t"), ["k"], f, schema).collect()}
    parts = {tuple(r) for r in apply.group_combine(skewed.select("k", "t"), ["k"], f, merge, schema).collect()}
    assert whole == parts and len(whole) == 4
