"""Cleaning of raw trip records into typed trips.

Adds ``time_range_id`` (half-hour bucket 1..48) and the four rounded
coordinates, types ``datetime`` and strips the two names. Every step is a
narrow, built-in expression: no shuffle, no Python. Each parsed value is
one chain of expressions referenced once, so when Catalyst inlines it into
later filters or projections the text is not parsed repeatedly.

Bad or missing values (``on_error``):

* ``"fail"`` (default): a bad or missing datetime or point raises when the
  value is computed (``coalesce(value, raise_error(...))``), failing the
  job before the caller writes anything (a failed job commits no files).
  Only values that a query uses are computed, so a query that reads no
  point does not notice a bad one; ``every_value=True`` checks all of them
  on every row, whatever the query uses. An ingest computes them all.
* ``"quarantine"``: rows are kept with a ``reject_reason``; use
  :func:`split_rejects` to separate accepted and rejected rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from triploom.functions import (
    half_hour_bucket, parse_datetime, point_x, point_y, strip_text,
    try_parse_datetime,
)

CLEAN_COLUMNS = ["time_range_id", "origin_x", "origin_y",
                 "destination_x", "destination_y"]
ON_ERROR = ("fail", "quarantine")
POINTS = (("origin_x", point_x, "origin_coord"), ("origin_y", point_y, "origin_coord"),
          ("destination_x", point_x, "destination_coord"),
          ("destination_y", point_y, "destination_coord"))


def _is_text(df: DataFrame) -> bool:
    return isinstance(df.schema["datetime"].dataType, T.StringType)


def _or_fail(value: Column, what: str, raw: str) -> Column:
    """``value``, or a raised error naming the raw text when it is NULL."""
    text = F.coalesce(F.col(raw).cast("string"), F.lit("NULL"))
    return F.coalesce(value, F.raise_error(
        F.concat(F.lit(f"bad trip record: {what} missing or unparseable: "), text)))


def clean_trips(df: DataFrame, on_error: str = "fail",
                every_value: bool = False) -> DataFrame:
    """Typed trips from raw records.

    Input: ``region, origin_coord, destination_coord, datetime, datasource``
    (``datetime`` as text ``yyyy-M-d H:m:s`` or already a timestamp), plus any
    extra columns, which are passed through.
    """
    if on_error not in ON_ERROR:
        raise ValueError(f"on_error must be one of {ON_ERROR}")
    text = _is_text(df)
    names = {"region": strip_text("region"), "datasource": strip_text("datasource")}
    if on_error == "fail":
        # ANSI parsing raises on bad text itself; coalesce catches NULLs
        # (missing text, or bad text with ANSI off).
        dt = parse_datetime("datetime") if text else F.col("datetime").cast("timestamp_ntz")
        typed = df.withColumns({**names, "datetime": _or_fail(dt, "datetime", "datetime")})
        typed = typed.withColumns({c: _or_fail(fn(src), src, src) for c, fn, src in POINTS})
        if every_value:
            # a filter that reads every value: it can't be pruned
            typed = typed.filter(F.concat_ws("", "datetime", *[c for c, _, _ in POINTS]) != "")
        return typed.withColumn("time_range_id", half_hour_bucket("datetime")) \
                    .select(*df.columns, *CLEAN_COLUMNS)
    # quarantine: NULL for what does not parse, and the reasons
    if text:
        # try_to_timestamp only tests validity: it goes through the session
        # zone, while to_timestamp_ntz keeps the wall-clock time as written
        dt = F.when(try_parse_datetime("datetime").isNotNull(), parse_datetime("datetime"))
    else:
        dt = F.col("datetime").cast("timestamp_ntz")
    typed = df.withColumns({**names, "datetime_raw": F.col("datetime").cast("string"),
                            "datetime": dt,
                            **{c: fn(src) for c, fn, src in POINTS}})
    malformed = (F.when(F.col("_corrupt_record").isNotNull(), F.lit("malformed line"))
                 if "_corrupt_record" in df.columns else F.lit(None).cast("string"))
    reason = F.concat_ws(
        "; ", malformed,
        F.when(F.col("datetime_raw").isNull(), F.lit("datetime missing"))
         .when(F.col("datetime").isNull(), F.lit("datetime unparseable")),
        *[F.when(F.col(src).isNull(), F.lit(f"{src} missing"))
           .when(F.col(x).isNull() | F.col(y).isNull(), F.lit(f"{src} unparseable"))
          for src, x, y in (("origin_coord", "origin_x", "origin_y"),
                            ("destination_coord", "destination_x", "destination_y"))])
    return (typed.withColumn("reject_reason", F.when(reason != "", reason))
            .withColumn("time_range_id", half_hour_bucket("datetime"))
            .select(*df.columns, *CLEAN_COLUMNS, "reject_reason", "datetime_raw"))


def split_rejects(cleaned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted trips, rejected raw rows with reason) of a quarantine clean."""
    accepted = (cleaned.filter(F.col("reject_reason").isNull())
                .drop("reject_reason", "datetime_raw"))
    rejected = (cleaned.filter(F.col("reject_reason").isNotNull())
                .drop("datetime", *CLEAN_COLUMNS)
                .withColumnRenamed("datetime_raw", "datetime"))
    return accepted, rejected
