"""Result rows in the shape of a dashboard: additive columns only, so that any grouping can sum them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintner import config as c
from vintner.config import Level, Step
from vintner.functions.safe import certain


@dataclass(frozen=True)
class Output:
    """A column of the dashboard: a count as it is, or a value per gross add turned into a total."""

    name: str
    source: str
    per_add: bool = False

    def expression(self) -> Column:
        value = F.col(self.source)
        return (value * F.col(c.GROSS_ADDS) if self.per_add else value).alias(self.name)


# fixed values: means per gross add whose totals the dashboard shows
MEANS = {
    "promo_days": "avg_promo_days",
    "promo_price": "avg_promo_price",
    "recurring_days": "avg_recurring_days",
    "recurring_price": "avg_recurring_price",
    "cross_sell_price": "avg_cross_sell_price",
    "cross_sell_adds_day_one": "cross_sell_adds_day_one_rate",
}


def outputs(steps: tuple[Step, ...] = c.STEPS) -> list[Output]:
    """Every column beside keys and flags. A total is left out where the count itself is there."""
    counts = {c.matured_column(1), c.canceled_column(1), c.cross_sell_column(1)}
    counts |= {s.maturity for s in steps} | {n for s in steps for n in s.filled}
    totals = [Output(name, source, per_add=True) for name, source in MEANS.items() if name not in counts]
    billed = [Output(c.total_billings_column(n), c.avg_billings_column(n), per_add=True) for n in c.BILLING_DAYS]
    return [*(Output(n, n) for n in sorted(counts)), *totals, *billed]


def dashboard_rows(result: DataFrame, level: Level, steps: tuple[Step, ...] = c.STEPS) -> DataFrame:
    """Keys, ``is_predicted`` (any step predicted something), gross adds and all outputs whose source is there."""
    there = set(result.columns)
    predicted = [certain(F.col(s.status_column) == c.PREDICTED) for s in steps if s.status_column in there]
    return result.select(
        *(n for n in ("model_id", *level.keys) if n in there),
        F.greatest(F.lit(False), F.lit(False), *predicted).alias("is_predicted"),
        c.GROSS_ADDS,
        *(o.expression() for o in outputs(steps) if o.source in there),
    )
