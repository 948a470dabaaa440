import datetime as dt

import pytest

from vintner.operators.features import View, checked, dataset, repeated_keys, store_dataset, store_view


@pytest.fixture()
def spine(spark):
    return spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, s string")


@pytest.fixture()
def view(spark):
    return View("V", spark.createDataFrame([(1, 10), (None, 30)], "k int, x int"))


def test_views_join_the_spine_on_the_keys(spine, view):
    rows = dataset(spine, [checked(view, ["k"])], ["k"]).collect()
    assert sorted(map(tuple, rows), key=str) == [(1, "a", 10), (2, "b", None), (None, "c", None)]
    assert dataset(spine, [], ["k"]).count() == 3


def test_a_view_needs_its_keys_once(spine, view):
    with pytest.raises(ValueError, match="no column k"):
        checked(View("W", spine.select("s")), ["k"])
    twice = View("W", view.rows.union(view.rows))
    assert repeated_keys(twice, ["k"]).count() == 2
    with pytest.raises(ValueError, match="more than once"):
        checked(twice, ["k"])


def test_a_stored_version_stays_unless_it_is_replaced(spark, view, folder):
    assert store_view(view, folder).rows.count() == 2
    larger = View("V", view.rows.union(view.rows).union(view.rows))
    assert store_view(larger, folder).rows.count() == 2
    assert store_view(View("V", larger.rows, 2), folder).rows.count() == 6
    held = store_view(larger, folder, replace_stored=True)
    assert held.rows.count() == 6
    # a view made from its own stored rows
    assert store_view(View("V", held.rows.filter("x = 10")), folder, replace_stored=True).rows.count() == 3


def test_stored_datasets_do_not_meet(spark, spine, folder):
    first, second = store_dataset(spine, folder, "D"), store_dataset(spine.limit(1), folder, "D")
    assert (first.count(), second.count()) == (3, 1)


def test_timestamps_lose_their_zone(spark):
    frame = spark.createDataFrame([(1, dt.datetime(2024, 1, 1))], "k int, ts timestamp")
    assert dict(checked(View("V", frame), ["k"]).rows.dtypes)["ts"] == "timestamp_ntz"
