"""Division, NULL and NaN rules shared by all jobs.

Spark runs in ANSI mode: a plain ``/`` raises on zero, and NaN compares greater than any number.
Every ratio and every row mask goes through this module.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def div0(numerator: Column, denominator: Column) -> Column:
    """n/d, 0 when d is 0, NULL when either input is NULL."""
    n, d = numerator.cast("double"), denominator.cast("double")
    return F.when((d == 0) & n.isNotNull(), F.lit(0.0)).otherwise(F.try_divide(n, d))


def ratio(numerator: Column, denominator: Column) -> Column:
    """n/d, NULL when d is 0 or an input is NULL."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def nan_to_null(df: DataFrame) -> DataFrame:
    """Replace NaN by NULL in every floating column, so that comparisons and averages ignore it."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None)) for c in floats}) if floats else df


def certain(condition: Column) -> Column:
    """A mask that is never NULL: unknown counts as false."""
    return F.coalesce(condition, F.lit(False))


def label_missing(value: Column, name: str) -> Column:
    return F.coalesce(value, F.lit(f"MISSING_{name.upper()}"))


def same_keys(left: str, right: str, keys: list[str]) -> Column:
    """Equality of the keys of two aliased frames, NULL equal to NULL."""
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(f"{left}.{key}").eqNullSafe(F.col(f"{right}.{key}"))
    return condition


def upper_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.upper() for c in df.columns])
