"""Week keys used to bucket trips.

``week``: ISO week number only (1..53). Week 1 of every year falls in one
group, and the last days of December can be week 1 of the next ISO year.
This is the default, as in the system being replaced.
``iso_year_week``: the ISO week-numbering year and the week number, so that
weeks of different years stay apart.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WEEK_KEYS = ("week", "iso_year_week")


def week_key(ts, kind: str = "week") -> list[Column]:
    """Grouping columns for the week of ``ts`` (aliased ``iso_year``, ``week``)."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    week = F.weekofyear(ts).cast("int").alias("week")
    if kind == "week":
        return [week]
    if kind == "iso_year_week":
        return [F.extract(F.lit("YEAROFWEEK"), ts).cast("int").alias("iso_year"), week]
    raise ValueError(f"week key must be one of {WEEK_KEYS}, not {kind!r}")
