"""Model terms from column lists."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def predictors(
    columns: Sequence[str], response: str, omit: Sequence[str] = (), substring: bool = False
) -> list[str]:
    """Columns other than the response and the omitted ones.

    ``substring`` also leaves out every column whose name merely contains one
    of those names (so that "year" drops "yearsEmploy" too).
    """
    out = [response, *omit]
    if substring:
        return [c for c in columns if not any(o in c for o in out)]
    return [c for c in columns if c not in out]


def model_terms(
    columns: Sequence[str], response: str, interact: Sequence[str] = (), omit: Sequence[str] = (), substring: bool = False
) -> list[tuple[str, ...]]:
    """Main effects and pairwise products, each once, as tuples of column names."""
    crossed = [c for c in interact if c != response]
    mains = dict.fromkeys([*crossed, *predictors(columns, response, omit, substring)])
    return [(c,) for c in mains] + list(combinations(crossed, 2))


def formula_text(response: str, terms: Sequence[tuple[str, ...]]) -> str:
    """The terms as a model formula."""
    return f"{response} ~ " + " + ".join(":".join(t) for t in terms)


def with_products(df: DataFrame, terms: Sequence[tuple[str, ...]], sep: str = "_x_") -> DataFrame:
    """Add one column per product term."""
    return df.withColumns({sep.join(t): F.col(t[0]) * F.col(t[1]) for t in terms if len(t) == 2})
