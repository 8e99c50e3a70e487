"""Ordered work (running totals, lags, row numbers) that no single task has to carry.

A Spark window puts each partition-by group into one task. Where a group can
hold a large share of the table, the functions here cut it into ranges of the
order column first, work inside each range, and carry a small summary from
range to range. Range limits come from an approximate quantile sketch; they
affect balance only, never the result.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from tallyframe.functions.nulls import order_by
from tallyframe.session import materialize, shuffle_partitions


def as_number(df: DataFrame, col: str) -> Column:
    """Order-preserving double for a numeric, date or timestamp column."""
    kind = df.schema[col].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(F.col(col)).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.col(col).cast("timestamp").cast("double")
    if isinstance(kind, T.NumericType):
        return F.col(col).cast("double")
    raise TypeError(f"cannot cut {col} of type {kind.simpleString()} into ranges")


def range_splits(df: DataFrame, col: str, parts: int | None = None) -> list[float]:
    """At most ``parts - 1`` limits that cut ``col`` into ranges of similar row counts; NaN counts as missing."""
    parts = parts or shuffle_partitions(df.sparkSession)
    if parts == 1:
        return []
    number = as_number(df, col)
    sketch = F.percentile_approx(F.when(~F.isnan(number), number), [i / parts for i in range(1, parts)], 4 * parts)
    return sorted(set(df.agg(sketch.alias("limits")).first()["limits"] or []))


def bucketize(df: DataFrame, col: str, splits: Sequence[float], out: str) -> DataFrame:
    """Range number of ``col``; missing values and NaN land in the last range."""
    if not splits:
        return df.withColumn(out, F.lit(0))
    cut = Bucketizer(
        splits=[-math.inf, *splits, math.inf], inputCol="_number", outputCol="_range", handleInvalid="keep"
    )
    numbered = cut.transform(df.withColumn("_number", as_number(df, col)))
    return numbered.withColumn(out, F.col("_range").cast("int")).drop("_number", "_range")


def running_totals(
    df: DataFrame,
    order: str,
    sums: dict[str, Column],
    keys: Sequence[str] = (),
    descending: bool = False,
    splits: Sequence[float] | None = None,
) -> DataFrame:
    """Totals per distinct ``order`` value, running totals and group totals.

    Returns ``keys``, ``order`` and, for each name in ``sums``, the total at this
    value, ``<name>_run`` (this value and all before it) and ``<name>_all`` (the
    whole group). Rows with a missing order value must be removed beforehand.

    Equal values are combined before the shuffle, so neither a hot key nor a hot
    value reaches one task as raw rows. Each range starts from a seed row that
    holds the total of the ranges before it.
    """
    keys = list(keys)
    if splits is None:
        splits = range_splits(df, order)
    totals = df.groupBy(*keys, order).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    totals = bucketize(totals, order, splits, "_bucket")
    if descending:
        totals = totals.withColumn("_bucket", -F.col("_bucket"))

    before = W.partitionBy(*keys).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(*keys)
    # One row per key and range: with no keys this window sees as many rows as there are ranges.
    seeds = (
        totals.groupBy(*keys, "_bucket")
        .agg(*[F.sum(n).alias(n) for n in sums])
        .select(
            *keys,
            "_bucket",
            F.lit(True).alias("_seed"),
            *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(n) for n in sums],
            *[F.sum(n).over(whole).alias(f"{n}_all") for n in sums],
        )
    )
    rows = totals.withColumn("_seed", F.lit(False)).unionByName(seeds, allowMissingColumns=True)
    value = F.col(order).desc() if descending else F.col(order).asc()
    upto = (
        W.partitionBy(*keys, "_bucket")
        .orderBy(F.col("_seed").desc(), value)
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    out = rows.select(
        *keys,
        order,
        "_seed",
        *sums,
        *[F.sum(n).over(upto).alias(f"{n}_run") for n in sums],
        *[F.first(f"{n}_all", ignorenulls=True).over(upto).alias(f"{n}_all") for n in sums],
    )
    return out.filter(~F.col("_seed")).drop("_seed")


def sorted_parts(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """The rows in a total order, as ``_part`` (range of the order) and ``_at`` (place in its part, from 0).

    The sort is a range partitioning, so rows spread over all tasks whatever the type or direction of
    the order columns; a written table pins the parts and places.
    """
    placed = df.orderBy(*order).withColumn("_position", F.monotonically_increasing_id())
    rows = materialize(placed, name)
    return rows.withColumns({
        "_part": F.shiftright("_position", 33), "_at": F.col("_position").bitwiseAND((1 << 33) - 1),
    }).drop("_position")


def row_positions(df: DataFrame, order: Sequence[Column], out: str = "ROW_NUMBER") -> DataFrame:
    """Number all rows 1..n in a total order; the part sizes (one row per task) give each part its starting number."""
    rows = sorted_parts(df, order, "row-positions")
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        rows.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    return (
        rows.join(F.broadcast(starts), "_part")  # one row per task of the sort
        .withColumn(out, F.col("_start") + F.col("_at") + 1)
        .drop("_part", "_start", "_at")
    )


def dense_key(df: DataFrame, col: str, out: str) -> DataFrame:
    """Dense rank of ``col`` in ascending order; a missing value gets a missing rank.

    Only the distinct values are ranked; the join back is left to the optimizer,
    which broadcasts the ranks when they are small and splits skewed partitions
    when they are not.
    """
    distinct = df.select(col).filter(F.col(col).isNotNull()).distinct()
    return df.join(row_positions(distinct, [F.col(col).asc()], out), col, "left")


def lag_in_groups(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str], lags: Sequence[int], name: str = "{col}_LAG_{k}"
) -> DataFrame:
    """Like :func:`lag_columns`, each group in one task: for groups whose size is bounded by construction."""
    w = W.partitionBy(*keys).orderBy(*order_by(*order))
    return df.withColumns({name.format(col=c, k=k): F.lag(c, k).over(w) for c in cols for k in lags})


def _sorts_before(left: dict[str, Column], right: dict[str, Column], order: Sequence[str]) -> Column:
    """True if ``left`` comes before ``right`` in the order, missing values last."""
    out = F.lit(False)
    for name in reversed(order):
        down, c = name.startswith("-"), name.removeprefix("-")
        x, y = left[c], right[c]
        ahead = F.when(x.isNull() | y.isNull(), x.isNotNull() & y.isNull()).otherwise(x > y if down else x < y)
        out = ahead | (x.eqNullSafe(y) & out)
    return out


def _plain(order: Sequence[str]) -> list[str]:
    return [name.removeprefix("-") for name in order]


#: Sampled rows behind each limit of a range; affects balance only.
SAMPLED_PER_CUT = 64


def range_cuts(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame | None:
    """Limits that cut the groups too large for one task: ``keys`` and ``_cuts``, the limits in order, in blocks; None if no group is.

    A group is cut if it holds more than half of an even share of the rows, so there are at most two groups
    to a task and about as many limits. Limits are sampled rows of the group, whatever the type of the order columns.
    """
    keys, parts = list(keys), shuffle_partitions(df.sparkSession)
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    share = sizes.agg(F.sum("_n")).scalar() / (2 * parts)
    large = materialize(sizes.filter((F.col("_n") > share) & (F.col("_n") > 1)).withColumn("_pieces", F.ceil(F.col("_n") / share)), "large-groups")
    if large.isEmpty():
        return None
    columns = _plain(order)
    named = large.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    rows = df.select(*dict.fromkeys([*keys, *columns])).join(F.broadcast(named), same)  # at most two groups to a task
    sample = rows.filter(F.rand(17) * F.col("_n") < SAMPLED_PER_CUT * F.col("_pieces"))
    inside = W.partitionBy(*keys)
    placed = sample.withColumns({"_i": F.row_number().over(inside.orderBy(*order_by(*order))), "_m": F.count(F.lit(1)).over(inside)})
    step = lambda i: F.floor(i * F.col("_pieces") / F.col("_m"))
    limits = placed.filter(step(F.col("_i")) > step(F.col("_i") - 1)).filter(F.col("_i") < F.col("_m"))
    found = limits.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("_i", *columns))).alias("_limits"))
    block = F.ceil(F.sqrt(F.size("_limits"))).cast("int")
    starts = F.sequence(F.lit(1), F.size("_limits"), block)
    return materialize(found.select(*keys, F.transform(starts, lambda i: F.slice("_limits", i, block)).alias("_cuts")), "range-cuts")


def _range_of(order: Sequence[str]) -> Column:
    """How many limits of ``_cuts`` a row does not come before: first among the blocks, then inside one."""
    row = {c: F.col(c) for c in _plain(order)}
    reached = lambda limit: ~_sorts_before(row, {c: limit[c] for c in row}, order)
    block = F.size(F.filter("_cuts", lambda b: reached(b[0]))) - 1
    own = F.when(block >= 0, F.size(F.col("_cuts")[0]) * block + F.size(F.filter(F.get("_cuts", block), reached)))
    return F.coalesce(own, F.lit(0)).cast("int")


def lag_columns(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str], lags: Sequence[int], name: str = "{col}_LAG_{k}"
) -> DataFrame:
    """Add the value ``k`` rows earlier in the same group, for each column and lag.

    Groups too large for one task are cut into ranges of the order (:func:`range_cuts`); each range is preceded by
    the last few rows before it, which a bounded state per range hands on. The rows themselves are shuffled once.
    ``order`` may be of any sortable type, ``-name`` is descending, and rows should be unique in it.
    """
    if not keys:
        return lag_columns(df.withColumn("_group", F.lit(0)), ["_group"], order, cols, lags, name).drop("_group")
    keys, columns, depth = list(keys), df.columns, max(lags)
    cuts = range_cuts(df, keys, order)
    lagged = lambda rows, w: rows.withColumns({name.format(col=c, k=k): F.lag(c, k).over(w) for c in cols for k in lags})
    if cuts is None:
        return lagged(df, W.partitionBy(*keys).orderBy(*order_by(*order)))
    named = cuts.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    rows = df.join(F.broadcast(named), same, "left")  # at most two groups to a task
    rows = rows.withColumn("_range", _range_of(order))
    needed = list(dict.fromkeys([*keys, *cols]))
    from_end = [
        F.col(c.removeprefix("-")).asc_nulls_first() if c.startswith("-") else F.col(c).desc_nulls_first() for c in order
    ]
    last = rows.filter(F.col("_cuts").isNotNull()).select(*dict.fromkeys([*needed, *_plain(order)]), "_range")
    last = last.withColumn("_back", F.row_number().over(W.partitionBy(*keys, "_range").orderBy(*from_end))).filter(F.col("_back") <= depth)
    # The rest has at most ``depth`` rows to a range.
    ends = last.groupBy(*keys, "_range").agg(F.sort_array(F.collect_list(F.struct((-F.col("_back")).alias("_at"), F.struct(*needed).alias("_row")))).alias("_end"))
    earlier = W.partitionBy(*keys).orderBy("_range").rowsBetween(-depth, -1)
    before = F.flatten(F.collect_list("_end").over(earlier))
    halo = ends.select("_range", F.slice(before, F.greatest(F.lit(1), F.size(before) - depth + 1), depth).alias("_before"))
    halo = halo.select("_range", F.posexplode("_before").alias("_i", "_one")).select(
        "_range", (F.col("_i") - depth).alias("_at"), *[F.col("_one._row")[c].alias(c) for c in needed]
    )
    both = rows.select(*columns, "_range", F.lit(0).alias("_at")).unionByName(halo, allowMissingColumns=True)
    new = lagged(both, W.partitionBy(*keys, "_range").orderBy("_at", *order_by(*order)))
    return new.filter(F.col("_at") == 0).drop("_range", "_at")
