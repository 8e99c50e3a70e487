"""All registered queries."""

from tallyframe.plans.catalog import (  # noqa: F401
    aggregates,
    calendars,
    composites,
    fits,
    ordering,
    selection,
    storage,
)
from tallyframe.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
