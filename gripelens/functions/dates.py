"""Timestamps and review age."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MICROS = 86_400_000_000
# ISO dates and times, and dates with the month in words, in either order. Dates in figures
# only are read year first, or month first between slashes.
DEFAULT_FORMATS = (
    "yyyy-M-d",
    "yyyy-M-d HH:mm:ss",
    "yyyy-M-d'T'HH:mm:ss",
    "MMM d, yyyy",
    "MMMM d, yyyy",
    "d MMM, yyyy",
    "d MMMM, yyyy",
    "M/d/yyyy",
)


def from_epoch_ms(ms: Column) -> Column:
    return F.timestamp_millis(ms.cast("bigint"))


def _marks(text: Column, fmt: str) -> Column:
    """Whether the text holds the marks that the format spells out; without them it cannot fit."""
    found = F.lit(True)
    for mark in "-/,:":
        if mark in fmt:
            found = found & text.contains(mark)
    return found


def parse_date(text: Column, formats: Sequence[str] = DEFAULT_FORMATS) -> Column:
    """First format that fits; null when none does (blank and junk included). Only formats whose
    marks the text holds are tried."""
    return F.coalesce(*[F.when(_marks(text, f), F.try_to_timestamp(text, F.lit(f))) for f in formats])


def age_days(ts: Column, as_of: dt.datetime | Column) -> Column:
    """Whole days elapsed: the floor of the time difference, not a calendar difference."""
    if isinstance(as_of, dt.datetime):
        if as_of.tzinfo is None:
            as_of = as_of.replace(tzinfo=dt.timezone.utc)
        now_micros = F.lit(round(as_of.timestamp() * 1_000_000))
    else:
        now_micros = F.unix_micros(as_of)
    return F.floor((now_micros - F.unix_micros(ts)) / F.lit(DAY_MICROS)).cast("bigint")
