"""Parsing of the raw text columns: datetime, POINT coordinates, names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must match the source format.
# Datetime: year-month-day hour:minute:second; single-letter fields so that
# unpadded numbers ("2018-5-28 9:03:40") parse like padded ones.
DATETIME_FORMAT = "yyyy-M-d H:m:s"
# Point text: "POINT (x y)", x then y, optional sign, optional fraction.
POINT_PATTERN = r"^\s*POINT\s*\(\s*([-+]?[0-9]+(?:\.[0-9]*)?)\s+([-+]?[0-9]+(?:\.[0-9]*)?)\s*\)\s*$"
# Whitespace removed around names: what Python's str.strip() removes for
# ASCII text (blank, tab, newline, carriage return, form feed, vertical tab).
STRIP_CHARS = " \t\n\r\f\v"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_datetime(c) -> Column:
    """Text -> TIMESTAMP_NTZ. Bad text raises under ANSI mode; NULL stays NULL."""
    return F.to_timestamp_ntz(_col(c), F.lit(DATETIME_FORMAT))


def try_parse_datetime(c) -> Column:
    """NULL when the text does not parse; use it as a validity test only.

    ``try_to_timestamp`` reads the text in the session time zone, so in a
    zone with daylight saving a wall-clock time inside the spring gap comes
    back shifted; take the value from :func:`parse_datetime`.
    """
    return F.try_to_timestamp(_col(c), F.lit(DATETIME_FORMAT)).cast("timestamp_ntz")


def _point_part(c, group: int, digits: int) -> Column:
    # regexp_extract gives "" when the text does not match; try_cast turns
    # that into NULL. Each step references the previous one once, so the
    # expression never repeats the regex when Catalyst inlines it.
    text = F.regexp_extract(_col(c), POINT_PATTERN, group)
    return normalize_zero(F.round(text.try_cast("double"), digits))


def point_x(c, digits: int = 2) -> Column:
    """First number of a POINT text, rounded; NULL when it does not parse."""
    return _point_part(c, 1, digits)


def point_y(c, digits: int = 2) -> Column:
    """Second number of a POINT text, rounded; NULL when it does not parse."""
    return _point_part(c, 2, digits)


def normalize_zero(c) -> Column:
    """Map -0.0 to 0.0 (IEEE: -0.0 + 0.0 = 0.0) so equal points share a key."""
    return _col(c) + F.lit(0.0)


def strip_text(c) -> Column:
    """Remove surrounding whitespace like Python's str.strip()."""
    return F.btrim(_col(c), F.lit(STRIP_CHARS))
