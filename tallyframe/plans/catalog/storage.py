"""Registered queries: reading, writing and reading back, table information, user functions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from tallyframe.operators import apply, summaries
from tallyframe.plans.bases import LONG_DAYS, TRIP_KEY, air, read_table
from tallyframe.plans.catalog.aggregates import trips_with_share
from tallyframe.plans.catalog.shape import tidy
from tallyframe.plans.registry import query
from tallyframe.session import scratch_path
from tallyframe.sources import files, sinks

ORDERS_SQL = "SELECT o_orderkey, o_custkey, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority FROM orders"
ORDERS_SCHEMA = "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate date, o_orderpriority string"


def some_orders(spark, sf):
    df = read_table(spark, sf, "orders")
    return df.select(
        "o_orderkey", "o_custkey", "o_totalprice", F.col("o_orderdate").cast("date").alias("o_orderdate"), "o_orderpriority"
    )


@query("src_table", "SELECT * FROM supplier")
def src_table(spark, sf):
    return tidy(read_table(spark, sf, "supplier"))


@query("src_csv_declared", ORDERS_SQL)
def src_csv_declared(spark, sf):
    path = scratch_path(spark, "csv-declared")
    sinks.write_csv(some_orders(spark, sf), path)
    return files.read_csv(spark, path, ORDERS_SCHEMA)


@query(
    "src_csv_missing_token",
    "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CASE WHEN ArrDelay > 0 THEN ArrDelay END AS ArrDelay, "
    "CASE WHEN DayOfWeek <> 'Sunday' THEN DayOfWeek END AS DayOfWeek FROM air",
    "air",
)
def src_csv_missing_token(spark, sf):
    # Delays that did not occur are written as "M"; Sunday is no declared level.
    df = air(spark, sf, *TRIP_KEY, "ArrDelay", "DayOfWeek")
    marked = df.withColumn("ArrDelay", F.when(F.col("ArrDelay") > 0, F.col("ArrDelay").cast("string")).otherwise("M"))
    path = scratch_path(spark, "csv-token")
    sinks.write_csv(marked, path)
    schema = "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber bigint, ArrDelay double, DayOfWeek string"
    return files.read_csv(spark, path, schema, missing="M", levels={"DayOfWeek": LONG_DAYS[:6]})


@query("src_csv_inferred", ORDERS_SQL)
def src_csv_inferred(spark, sf):
    path = scratch_path(spark, "csv-inferred")
    sinks.write_csv(some_orders(spark, sf), path)
    return tidy(files.read_csv(spark, path))


@query(
    "csv_to_columnar",
    "SELECT 'customer' AS source, c_custkey AS key, CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_mktsegment END AS level, "
    "c_acctbal AS amount FROM customer UNION ALL SELECT 'part', p_partkey, p_type, p_retailprice FROM part",
)
def csv_to_columnar(spark, sf):
    folder = scratch_path(spark, "columnar")
    customer = read_table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    part = read_table(spark, sf, "part").select("p_partkey", "p_type", "p_retailprice")
    sinks.write_csv(customer, f"{folder}/csv/customer")
    sinks.write_csv(part, f"{folder}/csv/part")
    paths = files.csv_to_columnar(
        spark,
        {"customer": f"{folder}/csv/customer", "part": f"{folder}/csv/part"},
        {
            "customer": "c_custkey bigint, c_mktsegment string, c_acctbal double",
            "part": "p_partkey bigint, p_type string, p_retailprice double",
        },
        f"{folder}/parquet",
        levels={"c_mktsegment": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"]},
    )
    read = lambda name: spark.read.parquet(paths[name]).toDF("key", "level", "amount").withColumn("source", F.lit(name))
    return read("customer").unionByName(read("part"))


@query(
    "src_sql_table",
    "SELECT o_custkey, count(*) AS n, round(avg(o_totalprice), 6) AS mean_price FROM orders GROUP BY o_custkey",
)
def src_sql_table(spark, sf):
    read_table(spark, sf, "orders").createOrReplaceTempView("orders_source")
    return tidy(
        files.read_catalog(
            spark, query="SELECT o_custkey, count(*) AS n, avg(o_totalprice) AS mean_price FROM orders_source GROUP BY o_custkey"
        )
    )


@query("csv_texts", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def csv_texts(spark, sf):
    """Texts with line breaks, quotes and blanks come back as they were."""
    path = scratch_path(spark, "csv-texts")
    sinks.write_csv(read_table(spark, sf, "documents").select("doc_id", "text", "lang", "source", "n_chars"), path)
    return files.read_csv(spark, path, "doc_id bigint, text string, lang string, source string, n_chars bigint")


@query("sink_csv", ORDERS_SQL)
def sink_csv(spark, sf):
    path = scratch_path(spark, "sink-csv")
    sinks.write_csv(some_orders(spark, sf), path)
    return files.read_csv(spark, path, ORDERS_SCHEMA)


@query("sink_table_overwrite", ORDERS_SQL)
def sink_table_overwrite(spark, sf):
    path, name = scratch_path(spark, "overwrite"), sinks.own_name("loaded_orders")
    df = some_orders(spark, sf)
    # The second load replaces the first.
    sinks.write_table(df.filter("o_orderpriority = '2-HIGH'"), name, path)
    return sinks.write_table(df, name, path)


@query("sink_append", ORDERS_SQL)
def sink_append(spark, sf):
    path = scratch_path(spark, "append")
    df = some_orders(spark, sf)
    sinks.append_rows(df.filter("o_orderpriority = '2-HIGH'"), path)
    sinks.append_rows(df.filter("o_orderpriority IS DISTINCT FROM '2-HIGH'"), path)
    return spark.read.parquet(path)


@query("sink_recreate", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey")
def sink_recreate(spark, sf):
    counts, name = read_table(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("n")), sinks.own_name("order_counts")
    sinks.recreate_table(counts.filter("n = 1"), name, scratch_path(spark, "recreate"))
    return sinks.recreate_table(counts, name, scratch_path(spark, "recreate"))


@query(
    "persist_result",
    "SELECT pickup_nhood, count(*) AS Num, round(avg(tip_pct), 10) AS ave_tip FROM trips WHERE tip_pct > 0.02 GROUP BY 1",
    "trips",
)
def persist_result(spark, sf):
    long_trips = trips_with_share(spark, sf, "pickup_nhood").filter("tip_pct > 0.02")
    stored = sinks.persist_to(long_trips, scratch_path(spark, "persist"))
    return tidy(stored.groupBy("pickup_nhood").agg(F.count("*").alias("Num"), F.avg("tip_pct").alias("ave_tip")), 10)


@query(
    "sink_split",
    'SELECT DayOfWeek, count(*) AS n, round(avg(ArrDelay), 6) AS mean_delay FROM air GROUP BY DayOfWeek',
    "air",
)
def sink_split(spark, sf):
    path = scratch_path(spark, "split")
    sinks.write_split(air(spark, sf, "ArrDelay", "DayOfWeek"), "DayOfWeek", path)
    # The level comes back from the folder names.
    back = spark.read.parquet(path)
    return tidy(back.groupBy("DayOfWeek").agg(F.count("*").alias("n"), F.avg("ArrDelay").alias("mean_delay")))


@query("view_define", "SELECT c_mktsegment, count(*) AS n FROM customer WHERE c_acctbal > 0 GROUP BY 1")
def view_define(spark, sf):
    sinks.define_view(read_table(spark, sf, "customer").filter("c_acctbal > 0"), "solvent_customers")
    return spark.sql("SELECT c_mktsegment, count(*) AS n FROM solvent_customers GROUP BY 1")


INFO_COLUMNS = {
    "o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double",
    "o_orderdate": "timestamp_ntz", "o_orderpriority": "string",
}


@query(
    "table_info",
    "WITH h AS (SELECT * FROM orders ORDER BY o_orderkey LIMIT 3)\n"
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{t}' AS type, CAST(min({c}) AS VARCHAR) AS low, CAST(max({c}) AS VARCHAR) AS high, "
        f"count(*) AS n, count(*) - count({c}) AS missing, "
        f"(SELECT string_agg(CAST({c} AS VARCHAR), ' | ' ORDER BY o_orderkey) FROM h) AS first_rows, "
        + (f"count(DISTINCT {c})" if t == "string" else "CAST(NULL AS BIGINT)")
        + " AS levels FROM orders"
        for c, t in INFO_COLUMNS.items()
    ),
)
def table_info(spark, sf):
    return tidy(summaries.table_info(read_table(spark, sf, "orders"), first=3, order=["o_orderkey"]))


@query("collect_bounded", "SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1")
def collect_bounded(spark, sf):
    counts = read_table(spark, sf, "customer").groupBy("c_mktsegment").agg(F.count("*").alias("n"))
    return spark.createDataFrame(files.collect_bounded(counts, 1000))


# --- user functions ------------------------------------------------------------------------


def _range(pdf: pd.DataFrame) -> pd.DataFrame:
    price = pdf["o_totalprice"].sort_values()
    return pd.DataFrame(
        {"o_custkey": [pdf["o_custkey"].iloc[0]], "n": [len(price)], "low": [price.iloc[0]], "high": [price.iloc[-1]]}
    )


@query(
    "group_apply",
    "SELECT o_custkey, count(*) AS n, min(o_totalprice) AS low, max(o_totalprice) AS high FROM orders GROUP BY 1",
)
def group_apply(spark, sf):
    df = read_table(spark, sf, "orders").select("o_custkey", "o_totalprice")
    return tidy(apply.group_apply(df, ["o_custkey"], _range, "o_custkey bigint, n bigint, low double, high double"))


@query(
    "group_apply_large",
    """
SELECT dropoff_dow, count(*) AS n, round(regr_slope(tip_pct, trip_distance), 9) AS slope,
       round(regr_r2(tip_pct, trip_distance), 9) AS r2 FROM trips GROUP BY dropoff_dow
""",
    "trips",
)
def group_apply_large(spark, sf):
    # Groups of any size: the function is written as aggregates that merge across tasks.
    df = trips_with_share(spark, sf, "dropoff_dow", "trip_distance")
    out = df.groupBy("dropoff_dow").agg(
        F.count("*").alias("n"),
        F.regr_slope("tip_pct", "trip_distance").alias("slope"),
        F.regr_r2("tip_pct", "trip_distance").alias("r2"),
    )
    return tidy(out, 9)


@query("param_grid_apply", "SELECT p_partkey, round(sqrt(p_retailprice), 6) AS root FROM part")
def param_grid_apply(spark, sf):
    grid = read_table(spark, sf, "part").select("p_partkey", "p_retailprice")
    run = lambda pdf: pd.DataFrame({"p_partkey": pdf["p_partkey"], "root": pdf["p_retailprice"] ** 0.5})
    return tidy(apply.param_grid_apply(grid, run, "p_partkey bigint, root double"))


def tips_by(df, *keys, least: int = 10):
    """A reusable chain with parameters: mean tip share and count per group, small groups left out."""
    out = df.groupBy(*keys).agg(F.avg("tip_pct").alias("ave_tip"), F.count("*").alias("Num"))
    return out.filter(F.col("Num") >= least)


@query(
    "reusable_function",
    "SELECT pickup_nhood, round(avg(tip_pct), 10) AS ave_tip, count(*) AS Num FROM trips GROUP BY 1 HAVING count(*) >= 100",
    "trips",
)
def reusable_function(spark, sf):
    return tidy(trips_with_share(spark, sf, "pickup_nhood").transform(tips_by, "pickup_nhood", least=100), 10)
