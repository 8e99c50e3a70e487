"""Text functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns that define a station key.
OUTER_WHITE_SPACE = r"^\s+|\s+$"
NOT_KEY_CHARACTER = r"[^A-Za-z0-9\s-]"
HYPHEN_OR_BLANK = "-| "


def trim_all(c: Column) -> Column:
    """Strip blanks, tabs and line breaks from both ends."""
    return F.regexp_replace(c, OUTER_WHITE_SPACE, "")


def clean_key(c: Column) -> Column:
    """Upper-cased key of ASCII letters, digits, hyphens; blanks become ``_``."""
    kept = F.regexp_replace(F.upper(trim_all(c)), NOT_KEY_CHARACTER, "")
    return F.regexp_replace(kept, " ", "_")


def underscore(c: Column) -> Column:
    """Hyphens and blanks become ``_``."""
    return F.regexp_replace(c, HYPHEN_OR_BLANK, "_")


def proper(c: Column, sep: str = " ") -> Column:
    """First letter of each ``sep``-separated word upper, the rest lower."""
    literal_sep = "\\Q" + sep + "\\E"
    words = F.transform(
        F.split(c, literal_sep),
        lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, 2, 1 << 30))),
    )
    return F.array_join(words, sep)
