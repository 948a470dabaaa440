"""Partial aggregates per day, kept in a folder; a later load computes only the days that can have changed since.

A load covers all days from its first one on, and a later load takes over from where it begins, so a day is
read from the last load that reaches back to it. A load is one folder that counts once it is complete: one that
dies leaves nothing behind for readers, and is done again.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vintner.sources.cache import fingerprint
from vintner.sources.storage import exists, names_in

#: More loads than this are written together as one, so that a read never opens many of them.
MOST_LOADS = 16
BEGINNING = dt.date(1, 1, 1)


def load_days(
    spark: SparkSession,
    folder: str,
    name: str,
    rows: DataFrame,
    day: str,
    partial: Callable[[DataFrame], DataFrame],
    until: dt.date,
    settled_days: int,
    **arguments,
) -> DataFrame:
    """``partial(rows)`` from the folder, after the days that are new at ``until`` have been computed.

    ``partial`` keeps the date column ``day`` and mixes no two days. Rows of a day may come or change for
    ``settled_days`` after it and not later; a load at a later date than the last reads the days from the last
    date less ``settled_days`` on, and no others. A load at the same or an earlier date reads the folder alone.
    Rows without a day are left out. ``arguments`` are all else that decides the result.
    """
    path = f"{folder}/{name}-{fingerprint([], settled_days=settled_days, **arguments)}"
    loads = _loads(spark, path)
    if not loads or until > loads[-1][0]:
        since = loads[-1][0] - dt.timedelta(days=settled_days) if loads else BEGINNING
        if len(loads) >= MOST_LOADS:
            fresh = partial(rows.filter(_from(day, since)))
            settled = _read(spark, path, loads, day).filter(F.col(day) < F.lit(since))
            since, result = BEGINNING, settled.unionByName(fresh)
        else:
            result = partial(rows.filter(_from(day, since)))
        result.write.mode("overwrite").parquet(_folder(path, until, since))
        loads = [*loads, (until, since)]
    return _read(spark, path, loads, day)


def _from(day: str, since: dt.date) -> Column:
    return F.col(day).isNotNull() if since == BEGINNING else F.col(day) >= F.lit(since)


def _folder(path: str, until: dt.date, since: dt.date) -> str:
    return f"{path}/{until.isoformat()}_{since.isoformat()}"


def _loads(spark: SparkSession, path: str) -> list[tuple[dt.date, dt.date]]:
    """(date, first day) of all complete loads, by date."""
    complete = [n for n in names_in(spark, path) if exists(spark, f"{path}/{n}/_SUCCESS")]
    return sorted(tuple(map(dt.date.fromisoformat, n.split("_"))) for n in complete)


def _read(spark: SparkSession, path: str, loads: list[tuple[dt.date, dt.date]], day: str) -> DataFrame:
    """Every day from the last load that covers it."""
    out, before = None, None
    for until, since in reversed(loads):
        part = spark.read.parquet(_folder(path, until, since)).filter(_from(day, since))
        if before is not None:
            part = part.filter(F.col(day) < F.lit(before))
        out = part if out is None else out.unionByName(part)
        before = since
        if since == BEGINNING:
            break
    return out
