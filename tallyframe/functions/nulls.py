"""Missing-value rules of statistics packages, as column expressions.

SQL and statistics packages disagree on missing values in a handful of places;
each function here states the statistics-package side.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_in(c: Column | str, values: Iterable) -> Column:
    """Membership that is never missing: a missing value is simply not a member."""
    return F.coalesce(_col(c).isin(list(values)), F.lit(False))


def not_in(c: Column | str, values: Iterable) -> Column:
    """Complement of :func:`is_in`; rows with a missing value are kept."""
    return ~is_in(c, values)


def if_else(cond: Column, yes, no) -> Column:
    """Two-way choice where a missing condition gives a missing result."""
    as_col = lambda v: v if isinstance(v, Column) else F.lit(v)
    return F.when(cond, as_col(yes)).when(~cond, as_col(no))


def strict_mean(c: Column | str) -> Column:
    """Mean that is missing when any input is missing."""
    return F.when(F.count(_col(c)) == F.count(F.lit(1)), F.avg(_col(c)))


def order_by(*cols: str) -> list[Column]:
    """Sort expressions with missing values last; a leading ``-`` means descending."""
    return [
        F.col(c[1:]).desc_nulls_last() if c.startswith("-") else F.col(c).asc_nulls_last()
        for c in cols
    ]


def ratio(num: Column | str, den: Column | str) -> Column:
    """Division where a zero denominator gives a missing value.

    Infinities and NaN would spoil later aggregates.
    """
    return F.try_divide(_col(num).cast("double"), _col(den).cast("double"))
