import dataclasses
import datetime as dt
import uuid
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from checks import queries as q
from checks import sample_sources as src
from vintner.config import RISK_DIMENSIONS
from vintner.operators import risk
from vintner.plans import risk_report as plan

SF = "/root/testdata/sf0.001"
SCHEMA = "type string, " + ", ".join(f"{d} string" for d in RISK_DIMENSIONS) + ", count bigint"


def events(spark, rows):
    """rows of (type, {dimension: value}, count); other dimensions are constant."""
    data = [(t, *[dims.get(d, "x") for d in RISK_DIMENSIONS], n) for t, dims, n in rows]
    return spark.createDataFrame(data, SCHEMA)


def sample(spark):
    return events(
        spark,
        [
            ("fraud", {"bin": "1"}, 30),
            ("dispute", {"bin": "1"}, 20),
            ("settlement", {"bin": "1"}, 100),
            ("fraud", {"bin": None, "offer_type": None}, 10),
            ("settlement", {"bin": None}, 400),
            ("dispute", {"bin": "2"}, 5),
            (None, {"bin": "3"}, 7),
        ],
    )


def test_ratios_of_one_dimension(spark):
    out = {r["bin"]: r for r in risk.risk_ratios(sample(spark), ["bin"]).collect()}
    assert set(out) == {"1", "2", "3", "MISSING_BIN"}
    one = out["1"]
    assert (one["fraud_disputes_count"], one["settled_count"], one["ratio"]) == (50, 100, 0.5)
    assert one["global_ratio"] == 65 / 500
    assert one["delta"] == 0.5 - 65 / 500
    assert one["delta_percentage"] == 0.5 / (65 / 500)
    assert out["2"]["ratio"] is None  # nothing settled
    assert (out["3"]["fraud_disputes_count"], out["3"]["settled_count"]) == (0, 0)


def test_threshold_is_strict_and_honoured(spark):
    def kept(minimum):
        report = risk.risk_all_levels(sample(spark), min_bad_count=minimum)
        return {r["value"] for r in report.filter("level = 'BIN'").collect()}

    assert kept(9) == {"1", "MISSING_BIN"}
    assert kept(10) == {"1"}
    assert kept(50) == set()


def test_levels_come_in_order_and_add_up(spark):
    report = risk.risk_all_levels(sample(spark), min_bad_count=-1).collect()
    levels = list(dict.fromkeys(r["level"] for r in report))
    assert levels == [d.upper() for d in RISK_DIMENSIONS]
    for level in levels:
        rows = [r for r in report if r["level"] == level]
        assert (sum(r["fraud_disputes_count"] for r in rows), sum(r["settled_count"] for r in rows)) == (65, 500)
        rated = [r["delta_percentage"] for r in rows if r["delta_percentage"] is not None]
        assert rated == sorted(rated, reverse=True)


def test_combinations_match_brute_force(spark):
    stream = q.events(spark, SF).cache()
    rows = stream.collect()
    combos = risk.level_combinations(RISK_DIMENSIONS, 2, 3) + [list(RISK_DIMENSIONS)]
    assert len(risk.level_combinations()) == 502
    bad, good = defaultdict(Counter), defaultdict(Counter)
    for r in rows:
        for combo in combos:
            key = tuple(r[d] for d in combo)
            side = bad if r["type"] in ("fraud", "dispute") else good
            side["-".join(combo).upper()][key] += r["count"]
    minimum = 20
    expected = {
        (level, "-".join(f"MISSING_{d}" if v is None else v for d, v in zip(level.split("-"), key)), n, good[level][key])
        for level, groups in bad.items()
        for key, n in groups.items()
        if n > minimum
    }
    report = risk.risk_combinations(stream, combos, min_bad_count=minimum).collect()
    assert {(r["level"], r["value"], r["fraud_disputes_count"], r["settled_count"]) for r in report} == expected
    assert len(report) == len(expected) > 0
    total = sum(bad["PROCESSOR-BIN"].values()) / sum(good["PROCESSOR-BIN"].values())
    assert {r["global_ratio"] for r in report} == {total}


TRANSACTIONS = """id bigint, payment_processor_id string, brand_slug string, sku_type_slug string, channel_slug string,
bin string, traffic_source_id bigint, plan_id bigint, payment_option_id bigint"""
DISPUTES = """`Capture Modification Merchant Reference` string, `Record Type` string, `Merchant Account` string,
`Payment Method` string, `Record Date` timestamp_ntz, RDR boolean"""
DAY = dt.datetime(2024, 5, 1)


def sources(spark, transactions, disputes=None, fraud=None):
    return plan.RiskSources(
        spark.createDataFrame(transactions, TRANSACTIONS),
        spark.createDataFrame([(1, "ads")], "id bigint, short_name string"),
        spark.createDataFrame([(1, "trial")], "id bigint, offer_type string"),
        spark.createDataFrame([(1, "MC")], "id bigint, card_network string"),
        adyen_disputes=None if disputes is None else spark.createDataFrame(disputes, DISPUTES),
        braintree_fraud=None
        if fraud is None
        else spark.createDataFrame(
            fraud, "transaction_id string, merchant_account string, payment_instrument_subtype string, fraud_post_date timestamp_ntz"
        ),
    )


def tx(id, processor_id=None, brand="b", plan_id=1):
    return (id, processor_id, brand, "s", "c", "411111", 1, plan_id, 1)


def run(found, **kw):
    return plan.processor_events(found, risk.ReportWindow(dt.date(2024, 4, 1)), **kw)


def test_disputes_are_filtered_and_counted_once(spark):
    disputes = [
        ("TXN_7", "Chargeback", "m", "mc", DAY, False),
        ("TXN_7", "Chargeback", "m", "mc", DAY, False),  # the same event again
        ("0007", "NotificationOfFraud", "m", "Visa", DAY, False),
        ("bad", "Chargeback", "m", "Visa", DAY, False),  # no readable id
        ("8", "Chargeback", "m", "Visa", DAY, None),  # unknown RDR flag
        ("8", "Chargeback", "m", "Visa", DAY, True),
        ("8", "Chargeback", "shut", "Visa", DAY, False),
        ("8", "Other", "m", "Visa", DAY, False),
        ("8", "Chargeback", "m", "Visa", dt.datetime(2024, 3, 1), False),
    ]
    out = run(sources(spark, [tx(7), tx(8)], disputes), excluded_adyen="shut").collect()
    got = sorted((r["ref_txn_id"], r["txn_id"], r["type"], r["card_network"], r["brand_slug"], r["count"]) for r in out if r["txn_id"])
    assert got == [("0007", 7, "fraud", "visa", "b", 1), ("TXN_7", 7, "dispute", "mastercard", "b", 1)]
    (unread,) = [r for r in out if r["txn_id"] is None]
    assert (unread["ref_txn_id"], unread["count"], unread["brand_slug"]) == ("bad", 0, None)
    assert {r["offer_type"] for r in out if r["txn_id"]} == {"trial"}


def test_one_processor_id_may_fan_out(spark):
    fraud = [("p1", "m", "Visa", DAY), ("p2", "m", "Visa", DAY), (None, "m", "Visa", DAY)]
    found = sources(spark, [tx(1, "p1"), tx(2, "p1", plan_id=99), tx(3, None)], fraud=fraud)
    out = sorted((str(r["ref_txn_id"]), str(r["txn_id"]), str(r["offer_type"]), r["count"]) for r in run(found).collect())
    assert out == [("None", "None", "None", 0), ("p1", "1", "trial", 1), ("p1", "2", "None", 1), ("p2", "None", "None", 1)]


def test_hot_processor_id_gives_the_same_events(spark, monkeypatch):
    fraud = [(f"p{i % 4}", f"m{i % 3}", "Visa", DAY) for i in range(40)]
    found = sources(spark, [tx(i, "p1" if i % 3 else f"p{i % 7}", f"b{i % 2}") for i in range(300)], fraud=fraud)
    plainly = sorted(map(str, run(found).collect()))
    original = risk.spread_left_join
    monkeypatch.setattr(
        risk, "spread_left_join", lambda *a, **k: original(*a, **k, salts=5, share=10)
    )
    assert sorted(map(str, run(found).collect())) == plainly


def test_transactions_are_read_once_per_key_and_dimensions_meet_events_only(spark, folder):
    found = sources(spark, [tx(7, "p7")], [("TXN_7", "Chargeback", "m", "mc", DAY, False)], [("p7", "m", "Visa", DAY)])
    found.transactions.write.parquet(f"{folder}/transactions")
    found = dataclasses.replace(found, transactions=spark.read.parquet(f"{folder}/transactions"))
    plan_text = run(found)._jdf.queryExecution().optimizedPlan().toString()
    # one read per join key, and two slim ones that look for hot processor ids on either side of the join
    assert plan_text.count("Relation") <= 2 + 4
    assert plan_text.count("short_name") and run(found).count() == 2


def test_events_are_read_once(spark):
    report = risk.risk_all_levels(sample(spark), ordered=False)
    assert "Expand" not in report._jdf.queryExecution().executedPlan().toString()
    ratios = risk.risk_ratios(sample(spark).repartition(2), ["bin"])
    ratios.collect()
    final = ratios._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("ReusedExchange") == 1


def test_report_caches_events_and_writes(spark, folder):
    from vintner.sources.sinks import make_sink

    as_of = dt.date(1996, 7, 1)  # six months back is the start used elsewhere
    sink = make_sink("csv", folder)
    args = dict(min_bad_count=10, cache_folder=f"{folder}/cache", sink=sink)
    first = plan.risk_report(src.risk_sources(spark, SF), as_of, **args)
    stored = spark.read.option("header", True).csv(sink.path("threshold_all_levels"))
    assert stored.columns == [c.upper() for c in first.columns]
    assert stored.count() == first.count() > 0
    assert spark.read.parquet(f"{folder}/cache/1996-01-01-*.parquet").count() > 0
    again = plan.risk_report(src.risk_sources(spark, SF), as_of, **args)
    assert sorted(map(str, again.collect())) == sorted(map(str, first.collect()))


def test_no_report_is_an_error(spark):
    with pytest.raises(ValueError, match="no processor report"):
        run(sources(spark, [tx(1)]))


def test_zone_filter_reaches_the_scan(spark):
    frame = risk.adyen_disputes(
        src.risk_sources(spark, SF).adyen_disputes, risk.ReportWindow(dt.date(1998, 1, 1))
    )
    plan_text = frame._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_shipdate" in plan_text


def lines_above_scans(plan, table):
    """For every scan of the table, the nodes between it and the next join above it."""
    lines = [(len(x) - len(x.lstrip(" :+-")), x.lstrip(" :+-")) for x in plan.splitlines()]
    for k, (depth, line) in enumerate(lines):
        if "Scan" in line and table in line:
            above = []
            for d, x in reversed(lines[:k]):
                if d < depth:
                    above.append(x)
                    depth = d
                    if "SortMergeJoin" in x or "ShuffledHashJoin" in x:
                        break
            yield above


def test_a_stored_history_is_not_shuffled(spark):
    name = f"history_{uuid.uuid4().hex}"
    many = [tx(i, f"p{i}") for i in range(300)] + [tx(1000 + i, "hot") for i in range(300)] + [tx(5000)]
    disputes = [(f"TXN_{i}", "Chargeback", "m", "mc", DAY, False) for i in (3, 7, 5000, 9999)] + [("bad", "Chargeback", "m", "mc", DAY, False)]
    fraud = [("p5", "m", "Visa", DAY), ("hot", "m", "Visa", DAY), ("none", "m", "Visa", DAY)]
    found = sources(spark, many, disputes, fraud)
    risk.store_transactions(found.transactions, name, 4)
    stored = dataclasses.replace(found, transactions=risk.open_transactions(spark, name))
    key = lambda rows: sorted(map(tuple, rows), key=str)
    want = key(run(found).collect())
    assert len([r for r in want if "hot" in r]) == 300
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        events = run(stored)
        assert key(events.collect()) == want
        plan_text = run(stored)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for table in ("by_id", "by_processor_id"):
        (above,) = lines_above_scans(plan_text, f"{name}_{table}[")
        assert above and "Join" in above[-1] and not any("Exchange" in x for x in above), above


def test_a_report_over_a_stored_history_is_cached_until_it_changes(spark, folder):
    name = f"history_{uuid.uuid4().hex}"
    found = sources(spark, [tx(7), tx(8, brand="c")], [("7", "Chargeback", "m", "mc", DAY, False)] * 2)
    as_of = dt.date(2024, 8, 2)

    def brands():
        stored = dataclasses.replace(found, transactions=risk.open_transactions(spark, name))
        report = plan.risk_report(stored, as_of, 0, folder)
        return {r["value"] for r in report.filter("level = 'BRAND_SLUG'").select(F.col("value")).collect()}

    risk.store_transactions(found.transactions, name, 2)
    assert brands() == brands() == {"b"}
    risk.store_transactions(found.transactions.withColumn("brand_slug", F.lit("other")), name, 2)
    assert brands() == {"other"}


def test_events_are_compared_as_a_whole_only_where_an_id_repeats(spark):
    disputes = [(r, "Chargeback", "m", "mc", DAY, False) for r in ("TXN_7", "7", "8", "bad", None)]
    fraud = [(p, "m", "Visa", DAY) for p in ("p1", "p2", "none", None)]
    once = [tx(7, "p1"), tx(8, "p1"), tx(9, "p2")]

    def top(found):
        """Names of the nodes above the joins."""
        lines = run(found)._jdf.queryExecution().optimizedPlan().toString().splitlines()
        return " ".join(lines[: next(i for i, x in enumerate(lines) if "Join" in x)])

    def rows(found):
        return sorted(map(str, run(found).collect()))

    unique = sources(spark, once, disputes, fraud)
    assert "Aggregate" not in top(unique)
    assert len(rows(unique)) == 5 + 5
    # a transaction twice, once with another plan that has no offer either; a plan twice; two without an id
    again = sources(spark, [*once, tx(7, "p1")], disputes, fraud)
    twice = dataclasses.replace(unique, plans=unique.plans.union(unique.plans))
    assert rows(again) == rows(twice) == rows(unique)
    for found in (again, twice):
        assert "Aggregate" in top(found)
    other = sources(spark, [tx(7, "p1", plan_id=98), tx(7, "p1", plan_id=99)], disputes, fraud)
    assert len(rows(other)) == 5 + 4
    assert len(rows(sources(spark, [tx(None, "p1"), tx(None, "p1")], disputes, fraud))) == 5 + 4


def test_repeated_ids_of_a_stored_history_are_seen(spark):
    for k, (history, unique) in enumerate(
        [
            ([tx(1, "p"), tx(2, "p"), tx(None, "p"), tx(3, None)], True),
            ([tx(1, "p"), tx(1, "q")], False),
            ([tx(None, "p"), tx(None, "p")], False),
        ]
    ):
        name = f"history_{uuid.uuid4().hex}"
        frame = spark.createDataFrame(history, TRANSACTIONS)
        assert risk.one_row_per_id(risk.store_transactions(frame, name, 2)) is unique, k
