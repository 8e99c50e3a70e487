"""The analyses' input relations, laid over the given tables.

Each relation takes only the joins its requested columns need: an unused inner
join cannot be removed by the optimizer, so it is not added in the first place.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.sources import files

# Schemas of the given tables.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}

DAYS = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]
LONG_DAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
POLLUTANTS = ["NO2", "O3", "SO2", "CO"]
MEANS = [f"{p}_MEAN" for p in POLLUTANTS]
TRIP_KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
HOME_REGION = "ASIA"


def read_table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return files.read_table(spark, sf, name, TABLES[name])


def weekday_name(d: Column, names: list[str]) -> Column:
    """The name of a date's weekday, looked up by number: far cheaper per row than formatting the date."""
    return F.element_at(F.array(*[F.lit(n) for n in names]), F.weekday(d) + 1)


def nations_of(spark: SparkSession, sf: str, region: str = HOME_REGION) -> DataFrame:
    """Neighbourhood list: names of one region's nations."""
    read = partial(read_table, spark, sf)
    r = read("region").filter(F.col("r_name") == region)
    return read("nation").join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("nhood"))


def trips(
    spark: SparkSession, sf: str, *cols: str, pickup_in: DataFrame | None = None, dropoff_in: DataFrame | None = None
) -> DataFrame:
    """Taxi-like trips, one per order line.

    ``pickup_in`` and ``dropoff_in`` (one column of names) keep trips between
    those neighbourhoods only. They thin out suppliers and customers first, and
    through them order lines and orders, before the two large tables meet.
    """
    read = partial(read_table, spark, sf)

    def homes(table: str, key: str, nation: str, name: str, only: DataFrame | None) -> DataFrame:
        names = read("nation").select(F.col("n_nationkey").alias(nation), F.col("n_name").alias(name))
        if only is not None:
            names = names.join(only.toDF(name), name, "left_semi")
        return read(table).select(key, nation).join(names, nation)

    df = read("lineitem")
    if "pickup_nhood" in cols or pickup_in is not None:
        supplier = homes("supplier", "s_suppkey", "s_nationkey", "p_name", pickup_in)
        df = df.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    from_customer = "dropoff_nhood" in cols or dropoff_in is not None
    if "pickup_dow" in cols or from_customer:
        orders = read("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        if from_customer:
            customer = homes("customer", "c_custkey", "c_nationkey", "d_name", dropoff_in)
            orders = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        df = df.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    computed = {
        "fare_amount": F.col("l_extendedprice"),
        "tip_amount": F.col("l_extendedprice") * F.col("l_discount"),
        "trip_distance": F.col("l_quantity"),
        "passenger_count": F.col("l_linenumber"),
        "pickup_hour": F.col("l_partkey") % 24,
        "dropoff_dow": weekday_name(F.col("l_shipdate").cast("date"), DAYS),
        "pickup_dow": weekday_name(F.col("o_orderdate").cast("date"), DAYS),
        "dropoff_nhood": F.col("d_name"),
        "pickup_nhood": F.col("p_name"),
    }
    return df.select(*[computed[c].alias(c) if c in computed else F.col(c) for c in cols])


def air(spark: SparkSession, sf: str, *cols: str) -> DataFrame:
    """Flight-like rows: delay in days, weekday, scheduled time."""
    read = partial(read_table, spark, sf)
    df = read("lineitem")
    if "ArrDelay" in cols or not cols:
        orders = read("orders").select("o_orderkey", "o_orderdate")
        df = df.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).withColumn(
            "ArrDelay", F.datediff(F.col("l_shipdate").cast("date"), F.col("o_orderdate").cast("date")).cast("double")
        )
    df = df.withColumns(
        {
            "DayOfWeek": weekday_name(F.col("l_shipdate").cast("date"), LONG_DAYS),
            "CRSDepTime": F.col("l_quantity"),
        }
    )
    return df.select(*(cols or ("ArrDelay", "CRSDepTime", "DayOfWeek", *TRIP_KEY)))


def loans(spark: SparkSession, sf: str, *cols: str) -> DataFrame:
    """Mortgage-like rows, one per order."""
    read = partial(read_table, spark, sf)
    df = read("orders")
    if "creditScore" in cols or not cols:
        customer = read("customer").select("c_custkey", F.col("c_acctbal").alias("creditScore"))
        df = df.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    df = df.withColumns(
        {
            "default": (F.col("o_orderstatus") == "F").cast("bigint"),
            "ccDebt": F.col("o_totalprice"),
            "year": F.year(F.col("o_orderdate").cast("date")).cast("bigint"),
            "houseAge": F.col("o_custkey") % 40,
            "yearsEmploy": F.col("o_custkey") % 15,
        }
    )
    every = ("o_orderkey", "creditScore", "houseAge", "yearsEmploy", "ccDebt", "year", "default")
    return df.select(*(cols or every))


def subs(spark: SparkSession, sf: str, *cols: str) -> DataFrame:
    """Subscription-like rows, one per labelled document."""
    read = partial(read_table, spark, sf)
    docs = read("documents").withColumns(
        {
            "TotalSales": F.col("n_chars").cast("double"),
            "FavCategory": F.col("lang"),
            "MarketingChannel": F.col("source"),
            # Words are runs of non-blank characters.
            "UniqueProducts": F.regexp_count("text", F.lit(r"[^ \t\r\n]+")).cast("bigint"),
        }
    )
    labels = read("labels").select(
        "doc_id", F.col("quality").cast("bigint").alias("Subscription"), F.col("toxic").cast("string").alias("Region")
    )
    every = ("doc_id", "Subscription", "TotalSales", "FavCategory", "MarketingChannel", "UniqueProducts", "Region")
    wanted = cols or every
    doc_cols = ["doc_id", *[c for c in wanted if c not in ("doc_id", "Subscription", "Region")]]
    return docs.select(*doc_cols).join(labels, "doc_id").select(*wanted)


def calendar_span(spark: SparkSession, sf: str) -> tuple[str, str]:
    """Whole years that cover the measurements and the year after them."""
    ends = read_table(spark, sf, "events").agg(F.year(F.min("ts")).alias("first"), F.year(F.date_add(F.max("ts").cast("date"), 366)).alias("last")).first()
    return f"{ends['first']:04d}-01-01", f"{ends['last']:04d}-12-31"


def pollution(spark: SparkSession, sf: str, users_per_station: int = 1) -> DataFrame:
    """Raw measurements with the raw file's column names: one row per station and day.

    A day with other events only has no measurement at all, but keeps its row.
    Larger ``users_per_station`` gives fewer stations with fewer gaps, which
    the model fits need.
    """
    events = read_table(spark, sf, "events")
    kind = {"NO2": "click", "O3": "view", "SO2": "purchase", "CO": "signup"}
    # One value column per kind of event, averaged map-side first.
    station = F.floor(F.col("user_id") / users_per_station)
    daily = events.groupBy(station.alias("user_id"), F.col("ts").cast("date").alias("Date Local")).agg(
        *[F.avg(F.when(F.col("event_type") == k, F.col("value"))).alias(f"{p} Mean") for p, k in kind.items()]
    )
    u = F.col("user_id")
    text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    return daily.select(
        text("  ", u, " Main-St. #", u % 7, "\t").alias("Address"),
        text(" State ", u % 5).alias("State"),
        text("City ", u % 11, " ").alias("City"),
        text("county ", u % 13).alias("County"),
        u.alias("Site Num"),
        "Date Local",
        *[f"{p} Mean" for p in kind],
    )


# name -> (relations it reads, SQL)
BASE_SQL: dict[str, tuple[list[str], str]] = {
    "nhoods": (
        [],
        f"SELECT n_name AS nhood FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = '{HOME_REGION}'",
    ),
    "trips": (
        [],
        """
SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber,
       sn.n_name AS pickup_nhood, cn.n_name AS dropoff_nhood,
       l.l_extendedprice AS fare_amount, l.l_extendedprice * l.l_discount AS tip_amount,
       l.l_quantity AS trip_distance, l.l_linenumber AS passenger_count,
       strftime(o.o_orderdate, '%a') AS pickup_dow, strftime(l.l_shipdate, '%a') AS dropoff_dow,
       l.l_partkey % 24 AS pickup_hour,
       l.l_extendedprice * l.l_discount / nullif(l.l_extendedprice, 0) AS tip_pct
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation cn ON c.c_nationkey = cn.n_nationkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation sn ON s.s_nationkey = sn.n_nationkey
""",
    ),
    "air": (
        [],
        """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
       CAST(datediff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS DOUBLE) AS ArrDelay,
       strftime(l_shipdate, '%A') AS DayOfWeek, l_quantity AS CRSDepTime
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
""",
    ),
    "loans": (
        [],
        """
SELECT o_orderkey, c_acctbal AS creditScore, o_custkey % 40 AS houseAge, o_custkey % 15 AS yearsEmploy,
       o_totalprice AS ccDebt, CAST(year(o_orderdate) AS BIGINT) AS year,
       CAST(o_orderstatus = 'F' AS BIGINT) AS "default"
FROM orders JOIN customer ON o_custkey = c_custkey
""",
    ),
    "subs": (
        [],
        r"""
SELECT d.doc_id, CAST(quality AS BIGINT) AS Subscription, CAST(n_chars AS DOUBLE) AS TotalSales,
       lang AS FavCategory, source AS MarketingChannel,
       CAST(len(regexp_extract_all(text, '[^ \t\r\n]+')) AS BIGINT) AS UniqueProducts,
       CAST(toxic AS VARCHAR) AS Region
FROM documents d JOIN labels l ON d.doc_id = l.doc_id
""",
    ),
    "pollution": (
        [],
        r"""
SELECT '  ' || user_id || ' Main-St. #' || user_id % 7 || chr(9) AS ADDRESS, ' State ' || user_id % 5 AS STATE,
       'City ' || user_id % 11 || ' ' AS CITY, 'county ' || user_id % 13 AS COUNTY, user_id AS SITE_NUM,
       CAST(ts AS DATE) AS DATE,
       avg(value) FILTER (event_type = 'click') AS NO2_MEAN, avg(value) FILTER (event_type = 'view') AS O3_MEAN,
       avg(value) FILTER (event_type = 'purchase') AS SO2_MEAN, avg(value) FILTER (event_type = 'signup') AS CO_MEAN
FROM events GROUP BY user_id, CAST(ts AS DATE)
""",
    ),
}
