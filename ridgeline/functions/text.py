"""Keys, numbers and durations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def plain_key(key: Column) -> Column:
    """Small letters; colons, hyphens and blanks become underscores."""
    return F.lower(F.translate(key, ":- ", "___"))


def whole_number(value: Column) -> Column:
    """A number rounded half to even, as text."""
    return F.rint(value).cast("long").cast("string")


def duration(seconds: Column) -> Column:
    """1h 02m 03s, 2m 03s or 3s."""
    s = seconds.cast("long")
    h, m, r = F.floor(s / 3600), F.floor((s % 3600) / 60), s % 60
    return F.when(h > 0, F.format_string("%dh %02dm %02ds", h, m, r)).when(m > 0, F.format_string("%dm %02ds", m, r)).otherwise(F.format_string("%ds", r))
