"""Time of day and the half-hour time range it falls in."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def time_of_day(ts) -> Column:
    """Clock time as the integer HMM / HHMM (hour*100 + minute); seconds ignored."""
    ts = _col(ts)
    return (F.hour(ts) * 100 + F.minute(ts)).cast("int")


def half_hour_bucket(ts) -> Column:
    """Id (1..48) of the half-hour range holding the timestamp.

    Equal to the range lookup against the seeded ``time_range`` table
    (range i covers minutes [30*(i-1), 30*i - 1] of the day), computed
    with arithmetic instead of a join.
    """
    ts = _col(ts)
    return (F.hour(ts) * 2 + F.floor(F.minute(ts) / 30) + 1).cast("int")


def time_range_label(time_from, time_to) -> Column:
    """'HHMM-HHMM' label of a range."""
    return F.concat(F.lpad(_col(time_from).cast("string"), 4, "0"), F.lit("-"),
                    F.lpad(_col(time_to).cast("string"), 4, "0"))
