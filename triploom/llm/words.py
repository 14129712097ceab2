"""Word splitting in DataFrame functions, shared by the native operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPACES = r"[\x20\x09-\x0D]+"                        # between words, op 4 and 8
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"        # between words, op 1


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, everything else as it is. An all-ASCII text (as
    many bytes as characters) can take the fast built-in."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower()))


def split_words(text: Column, gap: str) -> Column:
    """The words between matches of ``gap``; null and empty texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), gap), "")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def window_hashes(words: Column, size: int) -> Column:
    """One 64-bit hash per window of ``size`` consecutive words."""
    n = F.size(words) - size
    return F.when(n < 0, F.array().cast("array<bigint>")).otherwise(F.transform(
        F.sequence(F.lit(0), F.greatest(n, F.lit(0))),
        lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(size)])))
