"""Calendar fields from epoch seconds (UTC, pure arithmetic, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# 1970-01-01 was a Thursday; with Monday = 0 that is weekday 3.
EPOCH_WEEKDAY = 3


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hour_of(ts="QueryTs") -> Column:
    """Hour of day 0..23 of epoch seconds."""
    return F.floor(F.pmod(_c(ts), F.lit(86400)) / 3600).cast("int")


def weekday_of(ts="QueryTs") -> Column:
    """Weekday, Monday = 0 .. Sunday = 6, of epoch seconds."""
    return F.pmod(F.floor(_c(ts) / 86400) + EPOCH_WEEKDAY, F.lit(7)).cast("int")


def month_to_quarter(month="month") -> Column:
    """Month 1..12 -> quarter 1..4."""
    return F.ceil(_c(month) / 3).cast("int")


def combine_period(year="year", month="month", by: str = "q") -> Column:
    """Year + quarter (``by='q'``) or year + month key as a string."""
    part = month_to_quarter(month) if by == "q" else _c(month)
    return F.concat(_c(year).cast("string"), part.cast("string"))
