"""String expressions for log fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The path-segment patterns and what replaces them.
UUID_SEGMENT = r"(?i)/[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}"
UUID_MARK = "/{uuid}"
ID_SEGMENT = r"/\p{Nd}{2,}"
ID_MARK = "/{id}"

# Every Unicode blank plus the four ASCII separators, at either end.
OUTER_SPACE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def strip_space(text: Column) -> Column:
    """Remove white space of any kind from both ends (``trim`` only knows the blank)."""
    return F.regexp_replace(text, OUTER_SPACE, "")


def strip_query(endpoint: Column) -> Column:
    """The part of a path before its first question mark."""
    return F.substring_index(endpoint, "?", 1)


def mask_ids(endpoint: Column) -> Column:
    """Replace UUID segments first, then runs of two or more digits after a slash."""
    return F.regexp_replace(F.regexp_replace(endpoint, UUID_SEGMENT, UUID_MARK), ID_SEGMENT, ID_MARK)


def normalize_endpoint(endpoint: Column) -> Column:
    return mask_ids(strip_query(endpoint))


def hash_below(rate: float, *parts: Column) -> Column:
    """True for about ``rate`` of all distinct ``parts``, the same ones on every run and layout."""
    if not 0 <= rate < 1:
        raise ValueError("rate must be in [0, 1)")
    return F.substring(F.md5(F.concat_ws("|", *parts)), 1, 8) < F.lit(f"{int(rate * 2**32):08x}")
