"""Read-through parquet cache, keyed by all that decides the result."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vintner.sources.storage import exists


def fingerprint(sources: list[DataFrame | None], **arguments) -> str:
    """A name for the result of a job: its arguments, and the files, columns and plans of its sources.

    A source that was written again has other files. Frames that hold their rows themselves are known
    by their plan only.
    """
    described = []
    for frame in sources:
        if frame is not None:
            plan = re.sub(r"#\d+L?|plan_id=\d+", "", frame._jdf.queryExecution().analyzed().toString())
            described.append([frame.dtypes, sorted(frame.inputFiles()), plan])
    text = json.dumps([described, arguments], default=str, sort_keys=True)
    return hashlib.sha256(text.encode()).hexdigest()[:24]


def load_through(
    spark: SparkSession,
    folder: str,
    name: str,
    build: Callable[[], DataFrame],
    enabled: bool = True,
    sources: list[DataFrame | None] = (),
    **arguments,
) -> DataFrame:
    """Stored frame of this name, these arguments and these sources if there is one, else build and store it."""
    if not enabled:
        return build()
    path = f"{folder}/{name}-{fingerprint(list(sources), **arguments)}.parquet"
    # A job that died while writing leaves no _SUCCESS marker; such a folder is written again.
    if not exists(spark, f"{path}/_SUCCESS"):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
