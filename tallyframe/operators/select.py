"""Column selection by name, renaming, and the same expression over many columns."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _fold(text: str, ignore_case: bool) -> str:
    return text.lower() if ignore_case else text


def between(df: DataFrame, first: str, last: str) -> list[str]:
    """Columns from ``first`` to ``last`` in table order."""
    cols = df.columns
    return cols[cols.index(first) : cols.index(last) + 1]


def contains(df: DataFrame, part: str, ignore_case: bool = True) -> list[str]:
    return [c for c in df.columns if _fold(part, ignore_case) in _fold(c, ignore_case)]


def starts_with(df: DataFrame, prefix: str, ignore_case: bool = True) -> list[str]:
    return [c for c in df.columns if _fold(c, ignore_case).startswith(_fold(prefix, ignore_case))]


def ends_with(df: DataFrame, suffix: str, ignore_case: bool = True) -> list[str]:
    return [c for c in df.columns if _fold(c, ignore_case).endswith(_fold(suffix, ignore_case))]


def matches(df: DataFrame, pattern: str, ignore_case: bool = True) -> list[str]:
    """Columns whose name contains a match of a regular expression."""
    rx = re.compile(pattern, re.IGNORECASE if ignore_case else 0)
    return [c for c in df.columns if rx.search(c)]


def num_range(df: DataFrame, prefix: str, numbers: Sequence[int], width: int = 0) -> list[str]:
    """Columns named ``prefix`` and a number, zero-padded to ``width``."""
    wanted = [f"{prefix}{n:0{width}d}" if width else f"{prefix}{n}" for n in numbers]
    return [c for c in wanted if c in df.columns]


def rename_all(df: DataFrame, rule: Callable[[str], str]) -> DataFrame:
    return df.toDF(*[rule(c) for c in df.columns])


def upper_names(df: DataFrame) -> DataFrame:
    """Upper-case names with blanks as underscores."""
    return rename_all(df, lambda c: c.replace(" ", "_").upper())


def swap_suffix(df: DataFrame, pattern: str, replacement: str) -> DataFrame:
    return rename_all(df, lambda c: re.sub(pattern, replacement, c))


def mutate_across(df: DataFrame, cols: Sequence[str], rule: Callable[[Column], Column]) -> DataFrame:
    """Apply one expression to each listed column, in place."""
    return df.withColumns({c: rule(F.col(c)) for c in cols})


def agg_across(
    df: DataFrame, keys: Sequence[str], cols: Sequence[str], rule: Callable[[Column], Column]
) -> DataFrame:
    """Aggregate each listed column with the same expression, keeping its name."""
    return df.groupBy(*keys).agg(*[rule(F.col(c)).alias(c) for c in cols])
