"""Keys that compare without regard to letter case and surrounding blanks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def loose_key(text: Column) -> Column:
    """Lower case, without surrounding white space of any kind; null for null and for blank text (no reference)."""
    s = F.lower(F.regexp_replace(text, r"(?U)^\s+|\s+$", ""))
    return F.when(s != "", s)
