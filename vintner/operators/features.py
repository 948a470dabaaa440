"""Feature views and the dataset they make with a spine."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintner.functions.dates import without_zone
from vintner.sources.commit_log import CommitLog


@dataclass(frozen=True)
class View:
    """Features of one thing per key tuple, under a name and a version."""

    name: str
    rows: DataFrame
    version: int = 1


def repeated_keys(view: View, keys: list[str]) -> DataFrame:
    """Key tuples that a view holds more than once."""
    return view.rows.groupBy(*keys).agg(F.count("*").alias("rows")).filter("rows > 1")


def checked(view: View, keys: list[str]) -> View:
    """The view with timestamps without a zone; every key must be a column and no key tuple may repeat.

    A repeated key would multiply the rows of the spine. The test is one aggregate over the view.
    """
    lacking = sorted(set(keys) - set(view.rows.columns))
    if lacking:
        raise ValueError(f"view {view.name!r} has no column {', '.join(lacking)}")
    view = replace(view, rows=without_zone(view.rows))
    example = repeated_keys(view, keys).first()
    if example is not None:
        raise ValueError(f"view {view.name!r} holds a key more than once: {example.asDict()}")
    return view


def dataset(spine: DataFrame, views: list[View], keys: list[str]) -> DataFrame:
    """The spine with the columns of every view, matched on the keys.

    Spine and views are aggregates over the same keys, so the joins reuse their shuffles. A NULL key
    matches nothing: the row of the spine stays and its features are NULL.
    """
    out = without_zone(spine)
    for view in views:
        out = out.join(view.rows, keys, "left")
    return out


def store_view(view: View, folder: str, replace_stored: bool = False) -> View:
    """The view read from ``folder``, written there first unless this version is stored already.

    With ``replace_stored`` it is written beside the old rows and takes their place by one commit, so that a view may
    be made from its own stored version, and readers see the old rows until then, also if the write fails.
    """
    log, name = CommitLog(view.rows.sparkSession, f"{folder}/{view.name}"), f"v{view.version}"
    if replace_stored or not log.has(name):
        log.replace({name: view.rows})
    return replace(view, rows=log.read(name))


def registered(view: View, keys: list[str], folder: str, replace_stored: bool = False) -> View:
    """A view from outside: its keys are checked before it is stored."""
    return store_view(checked(view, keys), folder, replace_stored)


def store_dataset(rows: DataFrame, folder: str, name: str) -> DataFrame:
    """Written under a name of its own, so that two runs never share a folder, and read back."""
    path = f"{folder}/{name}/{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return rows.sparkSession.read.parquet(path)
