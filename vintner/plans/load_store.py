"""Skeleton job: load a source, store it under a name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame


def load_and_store(load: Callable[[], DataFrame], sink, name: str = "RAW_DATA") -> DataFrame:
    frame = load()
    sink.write(name, frame)
    return frame
