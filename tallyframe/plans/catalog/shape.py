"""Result shaping shared by the registered queries: types and digits that compare across engines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def r(c: Column | str, digits: int = 6) -> Column:
    """Rounded half away from zero, because engines add doubles in different orders.

    Plain arithmetic: the built-in ``round`` goes through a decimal per value.
    """
    c = F.col(c) if isinstance(c, str) else c
    scale = F.lit(float(10**digits))
    return F.signum(c) * F.floor(F.abs(c) * scale + 0.5) / scale


def big(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("bigint")


def tidy(df: DataFrame, digits: int = 6, **special: int) -> DataFrame:
    """Round every double (``special`` sets other digits by name) and widen every integer."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = r(c.cast("double"), special.get(f.name, digits))
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        out.append(c.alias(f.name))
    return df.select(*out)
