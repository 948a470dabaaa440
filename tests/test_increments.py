"""Day sums kept in a folder: equal to a full run, and only the days that can have changed are read."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.test_cohorts import GROSS, row
from vintner.config import Level
from vintner.operators.cohorts import cohort_spine
from vintner.plans.cohort_dataset import maintained_spine
from vintner.sources import increments
from vintner.sources.increments import load_days

START, LEVEL = dt.date(2023, 1, 1), Level("CAMPAIGN")
DAYS = [dt.date(2023, 1, 1) + dt.timedelta(days=i) for i in range(0, 300, 3)]


def gross(spark, until, adds=10):
    rows = [row(d, adds=adds + i % 7, promo=i % 2 == 0, brand="bc"[i % 5 == 0]) for i, d in enumerate(DAYS) if d <= until]
    return spark.createDataFrame([*rows, row(None)], GROSS)


def key(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_spine_of_kept_days_equals_a_full_run(spark, folder):
    for as_of in (dt.date(2023, 3, 1), dt.date(2023, 3, 2), dt.date(2023, 6, 1), dt.date(2023, 10, 30)):
        rows = gross(spark, as_of)
        kept = maintained_spine(rows, LEVEL, as_of, START, "c", folder=folder)
        assert key(kept) == key(cohort_spine(rows, LEVEL, as_of, START, "c"))
    # an earlier date finds all rows that came since
    early = maintained_spine(rows, LEVEL, dt.date(2023, 6, 1), START, "c", folder=folder)
    assert key(early) == key(cohort_spine(rows, LEVEL, dt.date(2023, 6, 1), START, "c"))


def counted(spark, folder, rows, until, settled=10):
    return load_days(spark, folder, "n", rows, "day", lambda r: r.groupBy("day").agg(F.sum("v").alias("v")), until, settled)


def table(spark, value, last=30):
    return spark.createDataFrame([(dt.date(2024, 1, d), value) for d in range(1, last + 1)] * 2, "day date, v bigint")


def test_only_days_that_can_have_changed_are_read_again(spark, folder):
    counted(spark, folder, table(spark, 1, 20), dt.date(2024, 1, 20))
    # the second load sees other values everywhere, and takes those from January 10 on
    second = {r["day"].day: r["v"] for r in counted(spark, folder, table(spark, 100), dt.date(2024, 1, 30)).collect()}
    assert second == {d: 2 if d < 10 else 200 for d in range(1, 31)}
    # the same or an earlier date reads the folder alone
    for until in (dt.date(2024, 1, 30), dt.date(2024, 1, 5)):
        assert {r["day"].day: r["v"] for r in counted(spark, folder, table(spark, 7), until).collect()} == second
    # other arguments are another folder
    assert counted(spark, folder, table(spark, 7), dt.date(2024, 1, 30), settled=11).first()["v"] == 14


def test_the_filter_on_days_reaches_the_scan(spark, folder):
    table(spark, 1).write.parquet(f"{folder}/raw")
    counted(spark, folder, spark.read.parquet(f"{folder}/raw"), dt.date(2024, 1, 20))
    seen = []

    def partial(rows):
        seen.append(rows._jdf.queryExecution().executedPlan().toString())
        return rows

    load_days(spark, folder, "m", spark.read.parquet(f"{folder}/raw"), "day", partial, dt.date(2024, 1, 20), 10)
    load_days(spark, folder, "m", spark.read.parquet(f"{folder}/raw"), "day", partial, dt.date(2024, 1, 25), 10)
    assert "GreaterThanOrEqual(day,2024-01-10)" in seen[1]


def test_a_load_that_died_is_done_again(spark, folder):
    def dies(rows):
        return rows.select("day", F.when(F.col("v") > 0, F.raise_error(F.lit("lost"))).cast("bigint").alias("v"))

    counted(spark, folder, table(spark, 1, 20), dt.date(2024, 1, 20))
    with pytest.raises(Exception, match="lost"):
        load_days(spark, folder, "n", table(spark, 5), "day", dies, dt.date(2024, 1, 30), 10)
    assert counted(spark, folder, table(spark, 1), dt.date(2024, 1, 20)).count() == 20
    assert counted(spark, folder, table(spark, 1), dt.date(2024, 1, 30)).count() == 30


def test_many_loads_are_written_together(spark, folder, monkeypatch):
    monkeypatch.setattr(increments, "MOST_LOADS", 3)
    for last in range(10, 18):
        kept = counted(spark, folder, table(spark, 1, last), dt.date(2024, 1, last), settled=2)
        assert {r["day"].day: r["v"] for r in kept.collect()} == {d: 2 for d in range(1, last + 1)}
    assert len({f.rsplit("/", 2)[1] for f in kept.inputFiles()}) <= 3
