"""Exact quantiles without a per-group buffer."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.operators.distribute import running_totals
from tallyframe.operators.joins import left_on
from tallyframe.session import materialize


def long_form(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """``keys``, ``variable``, ``value`` (double): one row per listed column.

    Written as an exploded array instead of ``unpivot``: the two branches of a
    running total then share one shuffle, which they do not over an Expand node.
    """
    pairs = [F.struct(F.lit(c).alias("variable"), F.col(c).cast("double").alias("value")) for c in cols]
    return df.select(*keys, F.inline(F.array(*pairs)))


#: Points of the sketch, and its accuracy: its values are off by at most one part in so many of the rows.
GRID, ACCURACY = 200, 2_000


def _order_statistics(p: float, n: Column) -> tuple[Column, Column]:
    """Places (from 0) of the two values that the quantile lies between."""
    at = F.lit(float(p)) * (n - 1)
    return F.floor(at), F.ceil(at)


def _brackets(probs: Sequence[float], n: Column, grid: Column) -> Column:
    """For each probability a range of values that holds its order statistics, from a sketch of the column."""
    slack, out = 4.0 / ACCURACY, []
    for p in sorted(probs):
        low, high = _order_statistics(p, n)
        first = F.floor((low / n - slack) * GRID) - 1
        last = F.ceil(((high + 1) / n + slack) * GRID) + 1
        end = lambda i, beyond: F.coalesce(F.get(grid, i.cast("int")), F.lit(beyond))
        out.append(F.struct(end(first, float("-inf")).alias("lo"), end(last, float("inf")).alias("hi")))
    return F.array(*out)


def _literal(ranges: dict[str, list]) -> Column:
    """The ranges of each variable as one constant expression, parsed at once."""
    number = lambda x: f"double('{x!r}')"
    pair = lambda r: f"named_struct('lo', {number(r['lo'])}, 'hi', {number(r['hi'])})"
    name = lambda v: "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    cases = " ".join(f"WHEN {name(v)} THEN array({', '.join(map(pair, r))})" for v, r in ranges.items())
    return F.expr(f"CASE variable {cases} END") if ranges else F.lit(None).cast("array<struct<lo:double,hi:double>>")


def narrowed(values: DataFrame, probs: Sequence[float], keys: Sequence[str] = ()) -> tuple[DataFrame, list[float] | None]:
    """The values with their numbers (``n``), those that no order statistic of ``probs`` can be among lumped together.

    One scan sketches each column, a second one counts: a value inside a range that may hold an order statistic
    keeps its identity, the values between two such ranges become one row at the largest of them (``lump``).
    Ranks inside the ranges stay what they were. Without keys there is one row of ranges to a column, which the
    driver holds; their limits are returned as well, to cut the rest of the work at.
    """
    by = [*keys, "variable"]
    # One parsed text: as many single literals would each be a call to the JVM.
    points = ", ".join(f"{i / GRID!r}D" for i in range(GRID + 1))
    grid = F.expr(f"percentile_approx(value, array({points}), {ACCURACY})")
    sketch = values.groupBy(*by).agg(F.count("value").alias("_n"), grid.alias("_grid"))
    ranges, limits = sketch.select(*by, _brackets(probs, F.col("_n"), F.col("_grid")).alias("_ranges")), None
    if keys:
        # Written, so that its size is known when the join with it is planned.
        rows = left_on(values, materialize(ranges, "ranges"), by)
    else:
        found = {r["variable"]: r["_ranges"] for r in ranges.collect()}
        rows = values.withColumn("_ranges", _literal(found))
        limits = sorted({r["lo"] for rs in found.values() for r in rs if math.isfinite(r["lo"])})
    v = F.col("value")
    inside = F.exists("_ranges", lambda r: (v >= r["lo"]) & (v <= r["hi"]))
    cell = F.size(F.filter("_ranges", lambda r: r["hi"] < v))
    cells = rows.select(*by, "value", F.when(inside, v).alias("_own"), F.when(~inside, cell).alias("_cell"))
    counts = cells.groupBy(*by, "_own", "_cell").agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("_most"))
    return counts.select(*by, F.coalesce("_own", "_most").alias("value"), "n", F.col("_own").isNull().cast("int").alias("lump")), limits


def quantiles(
    df: DataFrame,
    cols: Sequence[str],
    probs: Sequence[float],
    keys: Sequence[str] = (),
    approx: bool = False,
    narrow: bool | None = None,
) -> DataFrame:
    """Linear-interpolation quantiles of each column, missing values and NaN left out.

    One row per group and variable: ``n`` (values present) and ``q0``, ``q1``, …
    in the order of ``probs``. Values are counted, ranked by :func:`running_totals`,
    and the order statistics picked by a plain minimum, so no task holds a group's
    values. ``narrow`` first lumps together what cannot hold an order statistic
    (:func:`narrowed`), which pays where groups are large; without keys it is done unless refused.
    ``approx`` is the choice of a sketch instead.
    """
    values = long_form(df, cols, keys).filter(F.col("value").isNotNull() & ~F.isnan("value"))
    by = [*keys, "variable"]
    if approx:
        q = F.percentile_approx("value", list(probs), 10_000)
        out = values.groupBy(*by).agg(F.count("value").alias("n"), q.alias("_q"))
        return out.select(*by, "n", *[F.col("_q")[i].alias(f"q{i}") for i in range(len(probs))])
    narrow = not keys if narrow is None else narrow
    if narrow:
        values, limits = narrowed(values, probs, keys)
        if limits is None:
            values = materialize(values, "narrowed")
        ranked = running_totals(values, "value", {"n": F.col("n"), "lump": F.col("lump")}, by, splits=limits)
    else:
        ranked = running_totals(values, "value", {"n": F.lit(1)}, by)
    aggs, picks = [], []
    for i, p in enumerate(probs):
        lower, upper = _order_statistics(p, F.col("n_all"))
        aggs.append(F.min(F.when(F.col("n_run") > lower, F.col("value"))).alias(f"_lo{i}"))
        aggs.append(F.min(F.when(F.col("n_run") > upper, F.col("value"))).alias(f"_hi{i}"))
        # A lump between the two places would mean that the sketch broke its bound.
        missed = (F.col("lump") > 0) & (F.col("n_run") > lower) & (F.col("n_run") - F.col("n") <= upper) if narrow else F.lit(False)
        aggs.append(F.max(missed).alias(f"_missed{i}"))
        part = F.lit(float(p)) * (F.col("n") - 1)
        lo, hi = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        between = (F.ceil(part) - part) * lo + (part - F.floor(part)) * hi
        value = F.when((F.floor(part) == F.ceil(part)) | (lo == hi), lo).otherwise(between)
        picks.append(F.when(F.col(f"_missed{i}"), F.raise_error(F.lit("order statistic outside its range"))).otherwise(value).alias(f"q{i}"))
    return ranked.groupBy(*by).agg(F.max("n_all").alias("n"), *aggs).select(*by, "n", *picks)


def group_medians(
    df: DataFrame,
    keys: Sequence[str],
    cols: dict[str, str],
    strict: bool = False,
    approx: bool = False,
) -> DataFrame:
    """One row per group with the median of each column, named by ``cols`` (column → name).

    ``strict`` makes a median missing when the group has any missing value.
    """
    keys = list(keys)
    q = quantiles(df, list(cols), [0.5], keys, approx)
    medians = q.groupBy(*keys).agg(
        *[F.max(F.when(F.col("variable") == c, F.col("q0"))).alias(n) for c, n in cols.items()],
        *[F.max(F.when(F.col("variable") == c, F.col("n"))).alias(f"_n_{n}") for c, n in cols.items()],
    )
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    on = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    named = medians.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    joined = sizes.join(named, on, "left")
    pick = lambda n: F.when(F.col(f"_n_{n}") == F.col("_rows"), F.col(n)) if strict else F.col(n)
    return joined.select(*keys, *[pick(n).alias(n) for n in cols.values()])
