"""Groups of many combinations of dimensions whose weight exceeds a threshold, one dimension after the other.

A group can exceed the threshold only if each group that holds it does, as weights are not negative. So rows are
walked dimension by dimension: each of them enters combinations that add the dimension, if its group there is
above the threshold, and stays in those that do without it, where rows that differ in it only are merged. A
combination is thus built from rows of no more dimensions than it and the later ones have, not from all rows, and
the dimension with most values goes first. Values of a dimension that fall below the threshold by themselves are
alike for all combinations, so rows that differ only in them are merged at the start.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintner.sources.storage import written


@dataclass(frozen=True)
class Level:
    """Combinations of ``size`` dimensions."""

    size: int
    #: The rows that were aggregated: merged rows of the combinations when they got their last dimension.
    entered: DataFrame
    #: (mask, code of each dimension or 0, weight, other) of every group above the threshold.
    groups: DataFrame


def _codes(n: int) -> list[str]:
    return [f"_c{i}" for i in range(n)]


def _sums(weight: str = "_weight", other: str = "_other") -> list[Column]:
    return [F.sum(weight).alias("_weight"), F.sum(other).alias("_other")]


def frequent_values(rows: DataFrame, dimensions: list[str], weight: str, least: int) -> DataFrame:
    """(position of the dimension, value, code): values above the threshold, numbered from 1; NULL is a value.

    There are at most total weight / threshold of them per dimension.
    """
    slim = rows.select(*(F.col(d).cast("string").alias(str(i)) for i, d in enumerate(dimensions)), F.col(weight).alias("_weight"))
    long = slim.unpivot(["_weight"], [str(i) for i in range(len(dimensions))], "_position", "_value")
    sums = long.groupBy("_position", "_value").agg(F.sum("_weight").alias("_weight")).filter(F.col("_weight") > least)
    numbered = sums.select(F.col("_position").cast("int"), "_value", (F.monotonically_increasing_id() + 1).alias("_code"))
    return written(numbered, "frequent-values")


def _matches(value: str, values: DataFrame, position: int, name: str) -> tuple[DataFrame, Column]:
    own = values.filter(F.col("_position") == position).select(F.col("_value").alias(f"_v{position}"), F.col("_code").alias(name))
    return own, F.col(value).cast("string").eqNullSafe(F.col(f"_v{position}"))


def encoded(rows: DataFrame, dimensions: list[str], values: DataFrame, weight: str, other: str) -> DataFrame:
    """Codes instead of values, 0 for those below the threshold; rows that become equal are merged.

    ``_alive`` has a bit for each dimension with a code. No hint on the joins: Spark broadcasts values by their size.
    """
    names = _codes(len(dimensions))
    out = rows.select(*dimensions, F.col(weight).alias("_weight"), F.col(other).alias("_other"))
    for i, d in enumerate(dimensions):
        own, same = _matches(d, values, i, names[i])
        out = out.join(own, same, "left").drop(f"_v{i}")
    out = out.withColumns({c: F.coalesce(c, F.lit(0)) for c in names})
    alive = reduce(Column.bitwiseOR, [F.when(F.col(c) > 0, 1 << i).otherwise(0) for i, c in enumerate(names)])
    return out.groupBy(*names).agg(*_sums()).withColumn("_alive", alive)


def _kept_groups(entered: DataFrame, names: list[str], least: int) -> DataFrame:
    return entered.groupBy("_mask", *_group_key(names)).agg(*_sums()).filter(F.col("_weight") > least)


def _group_key(names: list[str]) -> list[Column]:
    return [F.when(F.col("_mask").bitwiseAND(1 << i) != 0, F.col(c)).otherwise(F.lit(0)).alias(c) for i, c in enumerate(names)]


def smallest_parents(masks: list[int], sizes: dict[int, int]) -> dict[int, list[int]]:
    """The masks to build from each parent: for every mask the parent with the fewest rows, if all parents have some."""
    out: dict[int, list[int]] = {}
    for mask in masks:
        parents = [mask & ~(1 << i) for i in range(mask.bit_length()) if mask >> i & 1]
        if all(sizes.get(p) for p in parents):
            out.setdefault(min(parents, key=lambda p: (sizes[p], p)), []).append(mask)
    return out


@dataclass(frozen=True)
class Step:
    """Combinations whose last dimension is the one of this step: the merged rows that entered, groups above the threshold."""

    entered: DataFrame
    groups: DataFrame


def _advanced(rows: DataFrame, names: list[str], i: int, kept: dict[int, int]) -> DataFrame:
    """Each row with and without dimension ``i``; ``kept`` has the masks that go on and the dimensions they still need."""
    bit = 1 << i
    out = rows.withColumn("_mask", F.explode(F.array(F.col("_mask"), F.col("_mask").bitwiseOR(bit))))
    has_value = (F.col("_mask").bitwiseAND(bit) == 0) | (F.col(names[i]) > 0)
    out = out.filter(F.col("_mask").isin(*kept) & has_value)
    for k, c in enumerate(names):
        needing = [m for m, dims in kept.items() if dims >> k & 1]
        if len(needing) < len(kept):
            out = out.withColumn(c, F.when(F.col("_mask").isin(*needing), F.col(c)).otherwise(F.lit(0)) if needing else F.lit(0).cast("bigint"))
    return out.groupBy("_mask", *names).agg(*_sums())


def steps(rows: DataFrame, n_dimensions: int, wanted: list[int], least: int) -> Iterator[Step]:
    """Walk the dimensions over encoded rows, that with most values first; masks are sums of 1 << position."""
    names = _codes(n_dimensions)
    used = [i for i in range(n_dimensions) if any(w >> i & 1 for w in wanted)]
    sizes = rows.agg(*(F.approx_count_distinct(names[i]) for i in used)).first()
    state, passed = rows.withColumn("_mask", F.lit(0)).select("_mask", *names, "_weight", "_other"), 0
    for _, i in sorted(zip(sizes, used, strict=True), key=lambda x: (-x[0], x[1])):
        passed |= 1 << i
        needs: dict[int, int] = {}
        for w in wanted:
            needs[w & passed] = needs.get(w & passed, 0) | w
        going = [m for m, dims in needs.items() if dims & ~passed]
        merged = written(_advanced(state, names, i, {m: d for m, d in needs.items() if m >> i & 1 or m in going}), "iceberg-rows")
        own = F.col("_mask").bitwiseAND(1 << i) != 0
        entered = merged.filter(own)
        groups = written(_kept_groups(entered, names, least), "iceberg-groups")
        yield Step(entered, groups)
        on = F.col("_mask").isin(*going)
        keys = groups.filter(on).select("_mask", *(F.col(c).alias(f"_k{k}") for k, c in enumerate(names)))
        state = merged.filter(on & ~own).unionByName(_semi(entered.filter(on), keys, names))


def levels(rows: DataFrame, n_dimensions: int, wanted: list[int], least: int) -> Iterator[Level]:
    """The wanted combinations over encoded rows by their number of dimensions, from few to many."""
    walked = list(steps(rows, n_dimensions, wanted, least))
    for size in sorted({m.bit_count() for m in wanted}):
        of_size = F.col("_mask").isin(*(m for m in wanted if m.bit_count() == size))
        yield Level(
            size,
            reduce(DataFrame.unionByName, [x.entered for x in walked]).filter(of_size),
            reduce(DataFrame.unionByName, [x.groups for x in walked]).filter(of_size),
        )


def _semi(entered: DataFrame, keys: DataFrame, names: list[str]) -> DataFrame:
    """Rows whose group is among the keys."""
    own = [key.alias(f"_k{i}") for i, key in enumerate(_group_key(names))]
    keyed = entered.select("*", *own)
    held = [f"_k{i}" for i in range(len(names))]
    return keyed.join(keys, ["_mask", *held], "left_semi").drop(*held)


def decoded(groups: DataFrame, dimensions: list[str], values: DataFrame) -> DataFrame:
    """Values instead of codes; NULL in dimensions that do not belong to the combination."""
    out = groups
    for i, (d, c) in enumerate(zip(dimensions, _codes(len(dimensions)), strict=True)):
        own = values.filter(F.col("_position") == i).select(F.col("_code").alias(c), F.col("_value").alias(d))
        out = out.join(own, c, "left")
    return out


def frequent_groups(rows: DataFrame, dimensions: list[str], wanted: list[int], weight: str, other: str, least: int) -> DataFrame:
    """(mask, dimensions as text, weight, other): groups of the wanted combinations above the threshold.

    ``weight`` must not be negative anywhere; ``other`` is added up beside it.
    """
    values = frequent_values(rows, dimensions, weight, least)
    start = written(encoded(rows, dimensions, values, weight, other), "encoded-rows")
    walked = steps(start, len(dimensions), wanted, least)
    groups = reduce(DataFrame.unionByName, [x.groups for x in walked]).filter(F.col("_mask").isin(*wanted))
    out = decoded(groups, dimensions, values)
    return out.select("_mask", *dimensions, F.col("_weight").alias(weight), F.col("_other").alias(other))
