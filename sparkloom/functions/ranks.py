"""Two readings of a rank as it is written, both in use."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col, edge_strip

UNRANKED = 9999


def rank_middle(c: Column | str) -> Column:
    """A rank as a double: =7 gives 7, 51-100 the middle 75.5, a number its whole part, anything else null."""
    t = edge_strip(c)
    bounds = r"^([0-9]{1,9})\s*-\s*([0-9]{1,9})$"
    middle = (F.regexp_extract(t, bounds, 1).try_cast("double") + F.regexp_extract(t, bounds, 2).try_cast("double")) / 2
    return F.when(t.rlike(bounds), middle).when(t.rlike(r"^=?[0-9]{1,9}$"), F.regexp_replace(t, "^=", "").try_cast("double")).when(t.rlike(r"^[0-9]{1,9}\.[0-9]+$"), F.floor(t.try_cast("double")).cast("double"))


def rank_first(c: Column | str) -> Column:
    """A rank as an integer: the first number of a range, commas dropped; 9999 for what isn't a whole number."""
    t = F.regexp_replace(F.regexp_replace(edge_strip(F.coalesce(col(c), F.lit(""))), "^=+", ""), ",", "")
    first = edge_strip(F.substring_index(t, "-", 1))
    return F.when(first.rlike("^[0-9]{1,9}$"), first.try_cast("int")).otherwise(F.lit(UNRANKED))
