"""Tables in the shared folder, columns of a batch, bounded samples of labelled rows."""

from __future__ import annotations

import re

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintner.sources.storage import scratch_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read back: computed once, and safe when executors are lost."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_folder(spark: SparkSession, name: str) -> str:
    """The URI of a new, empty folder in the shared folder, for files that tasks write themselves."""
    path = scratch_path(spark, name)
    uri = "file://" + path if path.startswith("/") else re.sub("^file:/+", "file:///", path)
    store, inner = fs.FileSystem.from_uri(uri)
    store.create_dir(inner, recursive=True)
    return uri


def appended(batch: pa.RecordBatch, **columns: pa.Array) -> pa.RecordBatch:
    """The batch with more columns at its end."""
    arrays = [*batch.columns, *columns.values()]
    return pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names, *columns])


def fresh(name: str, taken: list[str]) -> str:
    """A column name that is not taken, whatever its case."""
    lower = {x.lower() for x in taken}
    while name.lower() in lower:
        name += "_"
    return name


def bounded_sample(labels: DataFrame, key: str, by: str, limit: int) -> DataFrame:
    """At most ``limit`` rows of each value of ``by``, chosen by a hash of the key; repeatable.

    ``by`` must have few values (classes of a label). The rows read beyond the limit are few, as the
    hash first keeps about nine tenths of it.
    """
    order = F.xxhash64(F.lit("sample"), F.col(key))
    out = None
    for row in labels.groupBy(by).count().collect():
        share = min(1.0, 0.9 * limit / row["count"])
        part = labels.filter(F.col(by).eqNullSafe(F.lit(row[by])))
        if share < 1.0:
            part = part.filter(F.pmod(order, F.lit(1_000_000)) < int(share * 1_000_000))
            part = part.orderBy(order, key).limit(limit)
        out = part if out is None else out.unionByName(part)
    return labels.limit(0) if out is None else out
