"""Cohort months, maturity and time-zone bounds."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

REPORT_ZONE = "America/Los_Angeles"  # fixed value: day boundaries of the processor reports


def month_of(day: Column) -> Column:
    return F.trunc(day, "MM")


def matured(day: Column, days: int, as_of: dt.date) -> Column:
    """True when more than ``days`` days lie between the day and ``as_of``."""
    return F.date_diff(F.lit(as_of), day) > days


def since_local_date(
    ts: Column, date: dt.date, zone: str = REPORT_ZONE, source_zone: str = "UTC"
) -> Column:
    """``ts`` in the local zone is on or after ``date``.

    A zone conversion cannot be pushed into the scan, so a plain bound two days earlier goes with it;
    no two zones are further apart than that.
    """
    start = dt.datetime(date.year, date.month, date.day)
    local = F.convert_timezone(F.lit(source_zone), F.lit(zone), ts.cast("timestamp_ntz"))
    return (ts >= F.lit(date - dt.timedelta(days=2)).cast("timestamp_ntz")) & (
        local >= F.lit(start.isoformat(sep=" ")).cast("timestamp_ntz")
    )


def months_back(as_of: dt.date, months: int = 6) -> dt.date:
    """Same day some months earlier, clipped to the length of the month."""
    index = as_of.year * 12 + as_of.month - 1 - months
    year, month = divmod(index, 12)
    first_of_next = dt.date(year + (month == 11), (month + 1) % 12 + 1, 1)
    last_day = (first_of_next - dt.timedelta(days=1)).day
    return dt.date(year, month + 1, min(as_of.day, last_day))


def iso_text(ts: Column) -> Column:
    return F.date_format(ts.cast("timestamp_ntz"), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def day_text(df: DataFrame) -> DataFrame:
    """Dates and timestamps as ``yyyy-MM-dd`` text."""
    kinds = (T.DateType, T.TimestampType, T.TimestampNTZType)
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in names}) if names else df


def without_zone(df: DataFrame) -> DataFrame:
    """Cast zone-aware timestamps to zone-less ones; other columns are untouched."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in names}) if names else df
