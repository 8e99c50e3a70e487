"""Registered queries: filters, selectors, computed columns, joins, stacking, text and type functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.functions import strings
from tallyframe.functions.nulls import if_else, is_in, not_in, ratio
from tallyframe.operators import joins, rows
from tallyframe.operators import select as sel
from tallyframe.operators.scoring import level_index
from tallyframe.plans import bases
from tallyframe.plans.bases import TRIP_KEY, nations_of, read_table, subs, trips
from tallyframe.plans.catalog.shape import big, r, tidy
from tallyframe.plans.registry import query

KEY = ", ".join(TRIP_KEY)


# --- filters -------------------------------------------------------------------------------


@query(
    "filter_and",
    f"SELECT {KEY}, dropoff_dow, round(tip_amount, 6) AS tip_amount FROM trips "
    "WHERE dropoff_dow IN ('Fri', 'Sat', 'Sun') AND tip_amount > 1",
    "trips",
)
def filter_and(spark, sf):
    df = trips(spark, sf, *TRIP_KEY, "dropoff_dow", "tip_amount")
    return tidy(df.filter(is_in("dropoff_dow", ["Fri", "Sat", "Sun"]) & (F.col("tip_amount") > 1)))


@query(
    "filter_regex",
    f"SELECT {KEY}, pickup_nhood FROM trips WHERE regexp_matches(pickup_nhood, 'N_1[0-4]$')",
    "trips",
)
def filter_regex(spark, sf):
    return tidy(trips(spark, sf, *TRIP_KEY, "pickup_nhood").filter(F.col("pickup_nhood").rlike("N_1[0-4]$")))


@query("filter_count", "SELECT count(*) AS n FROM trips WHERE pickup_nhood = 'NATION_7'", "trips")
def filter_count(spark, sf):
    return trips(spark, sf, "pickup_nhood").filter(F.col("pickup_nhood") == "NATION_7").agg(F.count("*").alias("n"))


POLLUTION_ROWS = 'SITE_NUM, DATE, round(NO2_MEAN, 6) AS NO2_MEAN, round(SO2_MEAN, 6) AS SO2_MEAN'


def raw_pollution(spark, sf):
    """Raw measurements under clean names."""
    return sel.upper_names(bases.pollution(spark, sf)).withColumnRenamed("DATE_LOCAL", "DATE")


@query(
    "filter_not_missing",
    f"SELECT {POLLUTION_ROWS} FROM pollution WHERE NO2_MEAN IS NOT NULL AND SO2_MEAN IS NOT NULL",
    "pollution",
)
def filter_not_missing(spark, sf):
    df = raw_pollution(spark, sf).select("SITE_NUM", "DATE", "NO2_MEAN", "SO2_MEAN")
    return tidy(df.dropna(subset=["NO2_MEAN", "SO2_MEAN"]))


@query(
    "filter_bound_objects",
    f"SELECT {KEY}, pickup_nhood FROM trips WHERE pickup_nhood IN (SELECT nhood FROM nhoods)",
    "trips nhoods",
)
def filter_bound_objects(spark, sf):
    # A list from outside is a table, of any length.
    return tidy(joins.semi_on(trips(spark, sf, *TRIP_KEY, "pickup_nhood"), nations_of(spark, sf), "nhood", "pickup_nhood"))


@query(
    "filter_not_in",
    "SELECT SITE_NUM, DATE FROM pollution WHERE coalesce(floor(NO2_MEAN) NOT IN (10, 20, 30), TRUE)",
    "pollution",
)
def filter_not_in(spark, sf):
    df = raw_pollution(spark, sf).filter(not_in(F.floor("NO2_MEAN"), [10, 20, 30]))
    return df.select("SITE_NUM", "DATE")


@query(
    "filter_range",
    f"SELECT {POLLUTION_ROWS} FROM pollution WHERE SO2_MEAN <= 100 AND DATE >= DATE '2024-01-15'",
    "pollution",
)
def filter_range(spark, sf):
    df = raw_pollution(spark, sf).filter((F.col("SO2_MEAN") <= 100) & (F.col("DATE") >= F.lit("2024-01-15").cast("date")))
    return tidy(df.select("SITE_NUM", "DATE", "NO2_MEAN", "SO2_MEAN"))


@query(
    "filter_tail_window",
    "SELECT SITE_NUM, DATE FROM pollution WHERE DATE >= (SELECT max(DATE) FROM pollution) - INTERVAL 7 DAY",
    "pollution",
)
def filter_tail_window(spark, sf):
    return rows.tail_window(raw_pollution(spark, sf).select("SITE_NUM", "DATE"), "DATE", 7)


@query(
    "filter_having",
    """
SELECT dropoff_nhood, count(*) AS Num, round(avg(tip_pct), 10) AS ave_tip FROM trips
GROUP BY dropoff_nhood HAVING count(*) >= 10 AND avg(tip_pct) > 0.05
""",
    "trips",
)
def filter_having(spark, sf):
    df = trips(spark, sf, "dropoff_nhood", "tip_amount", "fare_amount")
    out = df.groupBy("dropoff_nhood").agg(
        F.count("*").alias("Num"), F.avg(ratio("tip_amount", "fare_amount")).alias("ave_tip")
    )
    return tidy(out.filter((F.col("Num") >= 10) & (F.col("ave_tip") > 0.05)), 10)


# --- columns -------------------------------------------------------------------------------


@query("select_cols", f"SELECT {KEY}, fare_amount, round(tip_amount, 6) AS tip_amount FROM trips", "trips")
def select_cols(spark, sf):
    return tidy(trips(spark, sf, *TRIP_KEY, "fare_amount", "tip_amount"))


@query("select_helpers", "SELECT l_orderkey, l_partkey, l_suppkey, l_extendedprice, l_tax, l_shipdate FROM lineitem")
def select_helpers(spark, sf):
    df = read_table(spark, sf, "lineitem")
    names = [
        *sel.between(df, "l_orderkey", "l_suppkey"),
        *sel.contains(df, "PRICE"),
        *sel.starts_with(df, "l_ta"),
        *sel.ends_with(df, "dt"),
        *sel.matches(df, "^l_ship.*e$"),
        *sel.num_range(df, "l_line", range(1, 6), width=2),
    ]
    return df.select(*dict.fromkeys(names))


@query("select_drop", "SELECT * EXCLUDE (o_totalprice, o_orderdate) FROM orders")
def select_drop(spark, sf):
    return read_table(spark, sf, "orders").drop("o_totalprice", "o_orderdate")


@query("rename_cols", "SELECT c_custkey AS customer, c_acctbal AS balance, c_mktsegment FROM customer")
def rename_cols(spark, sf):
    df = read_table(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    return df.withColumnsRenamed({"c_custkey": "customer", "c_acctbal": "balance"})


@query(
    "rename_pattern",
    "SELECT SITE_NUM, DATE AS DATE_LOCAL, round(NO2_MEAN, 6) AS NO2_AVG, round(CO_MEAN, 6) AS CO_AVG FROM pollution",
    "pollution",
)
def rename_pattern(spark, sf):
    df = sel.swap_suffix(sel.upper_names(bases.pollution(spark, sf)), "_MEAN$", "_AVG")
    return tidy(df.select("SITE_NUM", "DATE_LOCAL", "NO2_AVG", "CO_AVG"))


@query("mutate", f"SELECT {KEY}, fare_amount, round(tip_amount, 6) AS tip_amount, round(tip_pct, 6) AS tip_pct FROM trips", "trips")
def mutate(spark, sf):
    df = trips(spark, sf, *TRIP_KEY, "fare_amount", "tip_amount")
    return tidy(df.withColumn("tip_pct", ratio("tip_amount", "fare_amount")))


@query("transmute", f"SELECT {KEY}, round(tip_pct, 6) AS tip_pct FROM trips", "trips")
def transmute(spark, sf):
    df = trips(spark, sf, *TRIP_KEY, "fare_amount", "tip_amount")
    return tidy(df.select(*TRIP_KEY, ratio("tip_amount", "fare_amount").alias("tip_pct")))


@query(
    "mutate_across",
    """
SELECT SITE_NUM, DATE, round(NO2_MEAN / 10, 6) AS NO2_MEAN, round(O3_MEAN / 10, 6) AS O3_MEAN,
       round(SO2_MEAN / 10, 6) AS SO2_MEAN, round(CO_MEAN / 10, 6) AS CO_MEAN FROM pollution
""",
    "pollution",
)
def mutate_across(spark, sf):
    df = raw_pollution(spark, sf)
    df = sel.mutate_across(df, sel.matches(df, "_MEAN$"), lambda c: c / 10)
    return tidy(df.select("SITE_NUM", "DATE", *sel.matches(df, "_MEAN$")))


@query(
    "recode_flag",
    """
SELECT SITE_NUM, DATE, CASE WHEN NO2_MEAN > 50 THEN 'high' WHEN NO2_MEAN <= 50 THEN 'low' END AS level
FROM pollution
""",
    "pollution",
)
def recode_flag(spark, sf):
    df = raw_pollution(spark, sf)
    return df.select("SITE_NUM", "DATE", if_else(F.col("NO2_MEAN") > 50, "high", "low").alias("level"))


@query("distinct_rows", "SELECT DISTINCT pickup_nhood, dropoff_dow, passenger_count FROM trips", "trips")
def distinct_rows(spark, sf):
    return tidy(trips(spark, sf, "pickup_nhood", "dropoff_dow", "passenger_count").distinct())


@query(
    "slice_rows",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5 OFFSET 2",
)
def slice_rows(spark, sf):
    df = read_table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return rows.slice_rows(df, 3, 7, "-o_totalprice", "o_orderkey")


# --- joins ---------------------------------------------------------------------------------


@query(
    "join_left_dim",
    "SELECT o_orderkey, o_totalprice, c_mktsegment FROM orders LEFT JOIN customer ON o_custkey = c_custkey",
)
def join_left_dim(spark, sf):
    orders = read_table(spark, sf, "orders").select("o_orderkey", "o_totalprice", F.col("o_custkey").alias("c_custkey"))
    return joins.left_dim(orders, read_table(spark, sf, "customer"), "c_custkey", "c_mktsegment").drop("c_custkey")


@query(
    "join_left_composite",
    """
WITH m AS (SELECT l_partkey, l_suppkey, l_linenumber, max(l_quantity) AS best FROM lineitem
           WHERE l_returnflag = 'R' GROUP BY ALL)
SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_quantity, m.best
FROM lineitem l LEFT JOIN m USING (l_partkey, l_suppkey, l_linenumber)
""",
)
def join_left_composite(spark, sf):
    line = read_table(spark, sf, "lineitem").select(*TRIP_KEY, "l_quantity", "l_returnflag")
    keys = ["l_partkey", "l_suppkey", "l_linenumber"]
    best = line.filter("l_returnflag = 'R'").groupBy(*keys).agg(F.max("l_quantity").alias("best"))
    return tidy(line.drop("l_returnflag").join(best, keys, "left"))


@query(
    "join_left_group_stats",
    """
SELECT o_orderkey, o_custkey, o_totalprice, s.n_orders, round(s.mean_price, 6) AS mean_price FROM orders
LEFT JOIN (SELECT o_custkey, count(*) AS n_orders, avg(o_totalprice) AS mean_price FROM orders GROUP BY o_custkey) s
USING (o_custkey)
""",
)
def join_left_group_stats(spark, sf):
    orders = read_table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    out = joins.group_stats(
        orders, ["o_custkey"], n_orders=F.count("*"), mean_price=F.avg("o_totalprice")
    )
    return tidy(out)


@query(
    "join_left_override",
    """
SELECT p_partkey, coalesce(s.p_retailprice, p.p_retailprice) AS p_retailprice FROM part p
LEFT JOIN (SELECT l_partkey, max(l_extendedprice) AS p_retailprice FROM lineitem WHERE l_discount = 0 GROUP BY 1) s
ON p_partkey = l_partkey
""",
)
def join_left_override(spark, sf):
    part = read_table(spark, sf, "part").select("p_partkey", "p_retailprice")
    line = read_table(spark, sf, "lineitem").filter("l_discount = 0")
    sold = line.groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.max("l_extendedprice").alias("p_retailprice"))
    return joins.left_override(part, sold, "p_partkey", "p_retailprice")


@query(
    "join_cross_grid",
    """
SELECT SITE_NUM, CAST(m.last + CAST(k AS INTEGER) AS DATE) AS DATE
FROM (SELECT DISTINCT SITE_NUM FROM pollution) s, (SELECT max(DATE) AS last FROM pollution) m, range(1, 366) t(k)
""",
    "pollution",
)
def join_cross_grid(spark, sf):
    df = raw_pollution(spark, sf)
    last = df.agg(F.max("DATE")).scalar()
    return joins.day_grid(df.select("SITE_NUM").distinct(), last, 365)


@query(
    "join_semi",
    f"""
SELECT {KEY}, pickup_nhood, dropoff_nhood FROM trips
WHERE pickup_nhood IN (SELECT nhood FROM nhoods) AND dropoff_nhood IN (SELECT nhood FROM nhoods)
""",
    "trips nhoods",
)
def join_semi(spark, sf):
    df = trips(spark, sf, *TRIP_KEY, "pickup_nhood", "dropoff_nhood")
    return tidy(joins.semi_on(df, nations_of(spark, sf), "nhood", "pickup_nhood", "dropoff_nhood"))


@query(
    "join_anti",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey NOT IN "
    "(SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')",
)
def join_anti(spark, sf):
    orders = read_table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    returned = read_table(spark, sf, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return joins.anti_on(orders, returned, "o_orderkey")


# --- stacking ------------------------------------------------------------------------------


@query(
    "union_null_padded",
    """
SELECT o_orderkey AS key, o_totalprice AS hist, CAST(NULL AS DOUBLE) AS pred FROM orders
UNION ALL SELECT l_orderkey, NULL, l_extendedprice FROM lineitem
""",
)
def union_null_padded(spark, sf):
    hist = read_table(spark, sf, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("hist"))
    pred = read_table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("key"), F.col("l_extendedprice").alias("pred"))
    return rows.stack(hist, pred, pad=True)


@query(
    "bind_rows",
    "SELECT c_nationkey AS nation, c_acctbal AS bal FROM customer UNION ALL SELECT s_nationkey, s_acctbal FROM supplier",
)
def bind_rows(spark, sf):
    customer = read_table(spark, sf, "customer").select(big("c_nationkey").alias("nation"), F.col("c_acctbal").alias("bal"))
    # Columns are matched by name, not by position.
    supplier = read_table(spark, sf, "supplier").select(F.col("s_acctbal").alias("bal"), big("s_nationkey").alias("nation"))
    return rows.stack(customer, supplier)


@query(
    "union_many",
    """
SELECT 'customer' AS kind, c_custkey AS key FROM customer UNION ALL SELECT 'supplier', s_suppkey FROM supplier
UNION ALL SELECT 'part', p_partkey FROM part
""",
)
def union_many(spark, sf):
    part = lambda t, k: read_table(spark, sf, t).select(F.lit(t).alias("kind"), F.col(k).alias("key"))
    return rows.stack(part("customer", "c_custkey"), part("supplier", "s_suppkey"), part("part", "p_partkey"))


@query("replicate_rows", "SELECT s_suppkey, s_acctbal, k AS copy FROM supplier, range(1, 301) t(k)")
def replicate_rows(spark, sf):
    df = read_table(spark, sf, "supplier").select("s_suppkey", "s_acctbal")
    return tidy(rows.replicate(df, 300, "copy"))


# --- text, numbers, types ------------------------------------------------------------------

CLEAN = (
    r"regexp_replace(regexp_replace(upper(regexp_replace({c}, '^\s+|\s+$', '', 'g')), "
    r"'[^A-Za-z0-9\s-]', '', 'g'), ' ', '_', 'g')"
)


@query(
    "str_clean_key",
    f"SELECT SITE_NUM, DATE, {CLEAN.format(c='ADDRESS')} AS ADDRESS, {CLEAN.format(c='CITY')} AS CITY FROM pollution",
    "pollution",
)
def str_clean_key(spark, sf):
    df = sel.mutate_across(raw_pollution(spark, sf), ["ADDRESS", "CITY"], strings.clean_key)
    return df.select("SITE_NUM", "DATE", "ADDRESS", "CITY")


@query(
    "str_trim",
    r"SELECT doc_id, regexp_replace(regexp_replace(text, '^[ \t\n\r\f]+', ''), '[ \t\n\r\f]+$', '') AS text FROM documents",
)
def str_trim(spark, sf):
    return read_table(spark, sf, "documents").select("doc_id", strings.trim_all(F.col("text")).alias("text"))


@query(
    "str_proper",
    """
SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '),
       lambda w: upper(w[1:1]) || lower(w[2:])), ' ') AS name,
       array_to_string(list_transform(string_split(p_type, '-'), lambda w: upper(w[1:1]) || lower(w[2:])), '-') AS kind
FROM part
""",
)
def str_proper(spark, sf):
    return read_table(spark, sf, "part").select(
        "p_partkey", strings.proper(F.col("p_name")).alias("name"), strings.proper(F.col("p_type"), "-").alias("kind")
    )


@query("str_concat", "SELECT o_orderkey, 'Q' || quarter(o_orderdate) || ' ' || o_orderstatus AS label FROM orders")
def str_concat(spark, sf):
    quarter = F.quarter(F.col("o_orderdate").cast("date"))
    label = F.concat(F.lit("Q"), quarter, F.lit(" "), F.col("o_orderstatus"))
    return read_table(spark, sf, "orders").select("o_orderkey", label.alias("label"))


@query(
    "str_replace_class",
    "SELECT o_orderkey, regexp_replace(o_orderpriority, '-| ', '_', 'g') AS priority FROM orders",
)
def str_replace_class(spark, sf):
    return read_table(spark, sf, "orders").select("o_orderkey", strings.underscore(F.col("o_orderpriority")).alias("priority"))


@query("num_round", "SELECT o_orderkey, round_even(o_totalprice / 7, 3) AS price FROM orders")
def num_round(spark, sf):
    return read_table(spark, sf, "orders").select("o_orderkey", F.bround(F.col("o_totalprice") / 7, 3).alias("price"))


@query(
    "cast_types",
    """
SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS text_key, CAST(CAST(o_totalprice AS VARCHAR) AS DOUBLE) AS price,
       CAST(strftime(o_orderdate, '%Y-%m-%d') AS DATE) AS day, TRY_CAST(left(o_orderpriority, 1) AS BIGINT) AS rank,
       TRY_CAST(o_orderpriority AS BIGINT) AS not_a_number FROM orders
""",
)
def cast_types(spark, sf):
    return read_table(spark, sf, "orders").select(
        "o_orderkey",
        F.col("o_custkey").cast("string").alias("text_key"),
        F.col("o_totalprice").cast("string").cast("double").alias("price"),
        F.date_format("o_orderdate", "yyyy-MM-dd").cast("date").alias("day"),
        F.left("o_orderpriority", F.lit(1)).try_cast("bigint").alias("rank"),
        F.col("o_orderpriority").try_cast("bigint").alias("not_a_number"),
    )


@query(
    "factor_levels",
    f"""
SELECT doc_id, MarketingChannel, nullif(list_position(['src0', 'src1', 'src2', 'src10'], MarketingChannel), 0)
       AS level FROM subs
""",
    "subs",
)
def factor_levels(spark, sf):
    # Text outside the declared levels becomes missing.
    df = subs(spark, sf, "doc_id", "MarketingChannel")
    return df.withColumn("level", level_index("MarketingChannel", ["src0", "src1", "src2", "src10"]))


@query(
    "pipe",
    """
SELECT dropoff_dow, round(avg(tip_amount), 6) AS mean_tip FROM trips WHERE trip_distance > 10 GROUP BY dropoff_dow
""",
    "trips",
)
def pipe(spark, sf):
    keep_long = lambda df, least: df.filter(F.col("trip_distance") > least)
    by_day = lambda df: df.groupBy("dropoff_dow").agg(r(F.avg("tip_amount")).alias("mean_tip"))
    return trips(spark, sf, "dropoff_dow", "tip_amount", "trip_distance").transform(keep_long, 10).transform(by_day)


