"""The same results in plain SQL, for a second engine to check."""

from __future__ import annotations

from itertools import combinations

from vintner import config as c
from vintner.config import LEVELS, LTV_LEVELS, LTV_MONTHS, RISK_DIMENSIONS, Level

AS_OF = "DATE '2001-08-02'"

ORDERS = """SELECT * FROM orders
JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey"""

KEYS = """CAST(date_trunc('month', o_orderdate) AS DATE) AS cohort_month, o_orderkey % 2 = 0 AS plan__is_promo,
o_orderstatus AS gross_add__type, r_name AS brand, c_mktsegment AS sku_type, o_orderpriority AS channel,
n_name AS traffic_source, CASE WHEN o_custkey % 10 <> 0 THEN 'C' || (o_custkey % 7) ELSE 'NONE' END AS campaign"""


def div0(n: str, d: str) -> str:
    return f"CASE WHEN ({d}) = 0 AND ({n}) IS NOT NULL THEN 0.0 ELSE CAST({n} AS DOUBLE) / NULLIF(CAST({d} AS DOUBLE), 0) END"


def ratio(n: str, d: str) -> str:
    return f"CAST({n} AS DOUBLE) / NULLIF(CAST({d} AS DOUBLE), 0)"


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def rnd(x: str, digits: int = 9) -> str:
    return f"round(CAST({x} AS DOUBLE), {digits})"


GROSS = f"""SELECT {KEYS}, CAST(o_orderdate AS DATE) AS created, 1 + o_orderkey % 3 AS gross_adds,
CASE WHEN o_orderkey % 12 = 0 THEN 1 ELSE 0 END AS c1, CASE WHEN o_orderkey % 6 = 0 THEN 1 ELSE 0 END AS c3,
CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS c7, 1 + o_orderkey % 5 AS promo_price,
7 * (1 + o_orderkey % 3) AS promo_days, 10 + o_custkey % 20 AS recurring_price,
30 * (1 + o_custkey % 3) AS recurring_days
FROM ({ORDERS}) WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND r_name <> 'MIDDLE EAST'"""


def spine_select() -> str:
    """Aggregates and ratios of the spine, over the columns of GROSS."""

    def mat(n):
        return f"date_diff('day', created, {AS_OF}) > {n}"

    def sum_if(n, x):
        return f"sum(CASE WHEN {mat(n)} THEN {x} ELSE 0 END)"

    parts = [f"{big(sum_if(n, 'gross_adds'))} AS {c.matured_column(n)}" for n in c.MATURITY_DAYS]
    parts.append(f"{big('sum(gross_adds)')} AS gross_adds")
    for n in c.EARLY_DAYS:
        count = c.canceled_column(n)
        parts.append(f"{big(sum_if(n, f'c{n}'))} AS {count}")
        parts.append(f"{div0(sum_if(n, f'c{n}'), sum_if(n, 'gross_adds'))} AS {count}_rate")
    for kind in ("days", "price"):
        promo = f"CASE WHEN plan__is_promo THEN {div0(f'sum(promo_{kind} * gross_adds)', 'sum(gross_adds)')} END"
        recurring = div0(f"sum(recurring_{kind} * gross_adds)", "sum(gross_adds)")
        parts += [f"{promo} AS avg_promo_{kind}", f"{recurring} AS avg_recurring_{kind}"]
        parts.append(f"{div0(promo, recurring)} AS promo_to_recurring_{kind}_ratio")
    return ", ".join(parts)


def spine(level: Level) -> str:
    keys = ", ".join(level.keys)
    return f"SELECT {keys}, {spine_select()} FROM ({GROSS}) GROUP BY {keys}"


def retention(level: Level) -> str:
    keys = ", ".join(level.keys)
    adds = "1 + o_orderkey % 3"
    source = f"""SELECT {KEYS}, CASE WHEN o_orderkey % 2 = 0 THEN {adds} ELSE 0 END AS ep,
CASE WHEN o_orderkey % 4 = 0 THEN {adds} ELSE 0 END AS sp, CASE WHEN o_orderkey % 5 <> 0 THEN {adds} ELSE 0 END AS er,
CASE WHEN o_orderkey % 5 <> 0 AND o_orderkey % 7 <> 0 THEN {adds} ELSE 0 END AS sr FROM ({ORDERS})"""
    return f"""SELECT {keys}, {big("coalesce(sum(ep), 0)")} AS eligible_promo_activations,
{big("coalesce(sum(sp), 0)")} AS survived_promo_activations_excl_retries,
coalesce({div0("sum(sp)", "sum(ep)")}, 0) AS promo_activation_rate_excl_retries,
{big("coalesce(sum(er), 0)")} AS eligible_first_rebills,
{big("coalesce(sum(sr), 0)")} AS survived_first_rebills_excl_retries,
coalesce({div0("sum(sr)", "sum(er)")}, 0) AS first_rebill_rate_excl_retries
FROM ({source}) GROUP BY {keys}"""


LINES = f"""SELECT *, date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS lag
FROM ({ORDERS}) JOIN lineitem ON o_orderkey = l_orderkey"""


def billing(level: Level) -> str:
    keys = ", ".join(level.keys)
    sums = ", ".join(
        f"CAST(sum(CASE WHEN lag BETWEEN 0 AND {n} THEN price END) AS DOUBLE) AS {c.billings_column(n)}"
        for n in c.BILLING_DAYS
    )
    source = f"""SELECT {KEYS}, lag, CAST(l_extendedprice AS DECIMAL(18,2)) AS price
FROM ({LINES}) WHERE o_orderstatus <> 'P'"""
    return f"SELECT {keys}, {sums} FROM ({source}) GROUP BY {keys}"


def cross_sell(level: Level) -> str:
    keys = ", ".join(level.keys)
    days = ", ".join(
        f"{big(f'coalesce(sum(CASE WHEN lag BETWEEN 0 AND {n} THEN 1 ELSE 0 END), 0)')} AS {c.cross_sell_column(n)}"
        for n in c.EARLY_DAYS
    )
    source = f"SELECT {KEYS}, lag, 10 + o_custkey % 20 AS price FROM ({LINES})"
    return f"""SELECT {keys}, count(*) AS total_cross_sell_adds,
coalesce({div0("sum(price)", "count(*)")}, 0) AS avg_cross_sell_price, {days} FROM ({source}) GROUP BY {keys}"""


def dataset(level: Level) -> str:
    keys = ", ".join(level.keys)
    return f"""SELECT * FROM ({spine(level)}) LEFT JOIN ({retention(level)}) USING ({keys})
LEFT JOIN ({billing(level)}) USING ({keys}) LEFT JOIN ({cross_sell(level)}) USING ({keys})"""


def clean(level: Level) -> str:
    averages = [f"{ratio(c.billings_column(n), c.matured_column(n))} AS {c.avg_billings_column(n)}" for n in c.BILLING_DAYS]
    rates = [f"{ratio(c.cross_sell_column(n), c.matured_column(n))} AS {c.cross_sell_rate_column(n)}" for n in c.EARLY_DAYS]
    dropped = ", ".join(c.billings_column(n) for n in c.BILLING_DAYS)
    return f"SELECT * EXCLUDE ({dropped}), {', '.join(averages + rates)} FROM ({dataset(level)})"


def levels_all() -> str:
    sets = ", ".join(f"({', '.join(level.keys)})" for level in LEVELS)
    keys = ", ".join(LEVELS[-1].keys)
    cases = " ".join(
        f"WHEN {(1 << (len(LEVELS) - i)) - 1} THEN '{level.name}'" for i, level in enumerate(LEVELS, start=1)
    )
    lower = ", ".join(c.LEVEL_COLUMNS)
    return f"""SELECT CASE grouping({lower}) {cases} END AS level, {keys}, {spine_select()}
FROM ({GROSS}) GROUP BY GROUPING SETS ({sets})"""


def plain(sql: str, **columns: str) -> str:
    """Some columns replaced, whatever the inner query is."""
    return f"""SELECT * REPLACE ({", ".join(f"{v} AS {k}" for k, v in columns.items())}) FROM
(SELECT * FROM ({sql}))"""


MONTH = "strftime(cohort_month, '%Y-%m-%d')"


def cohort(sql: str) -> str:
    return plain(sql, cohort_month=MONTH)


# --- payment risk --------------------------------------------------------------------------------

TRANSACTIONS = f"""SELECT o_orderkey AS id, 'bt' || o_orderkey AS payment_processor_id, r_name AS brand_slug,
c_mktsegment AS sku_type_slug, o_orderpriority AS channel_slug, CAST(o_custkey % 50 AS VARCHAR) AS bin,
t.n_name AS traffic_source_short_name, p_type AS offer_type,
CASE s_suppkey % 4 WHEN 0 THEN 'mc' WHEN 1 THEN 'Visa' WHEN 2 THEN 'American Express' WHEN 3 THEN 'visa' END AS option_network
FROM (SELECT o_orderkey, o_custkey, o_orderpriority, r_name, c_mktsegment, c_nationkey FROM ({ORDERS})) o
LEFT JOIN nation t ON t.n_nationkey = o.c_nationkey
LEFT JOIN part ON p_partkey = o.o_orderkey % 2500 LEFT JOIN supplier ON s_suppkey = o.o_custkey % 120"""

REFERENCE = "CASE WHEN l_linenumber % 2 = 0 THEN 'TXN_' || l_orderkey ELSE lpad(CAST(l_orderkey AS VARCHAR), 9, '0') END"
NETWORK = "CASE l_suppkey % 4 WHEN 0 THEN 'mc' WHEN 1 THEN 'Visa' WHEN 2 THEN 'American Express' ELSE 'visa' END"
LA = "(({}) AT TIME ZONE 'UTC' AT TIME ZONE 'America/Los_Angeles')"
JSON_K = "CAST(json_extract_string(props, '$.k') AS INTEGER) % 10"
JSON_NETWORK = f"CASE WHEN {JSON_K} = 0 THEN 'paypal_account' WHEN {JSON_K} = 1 THEN 'Master Card' WHEN {JSON_K} = 2 THEN 'mc' ELSE 'visa' END"
CLEAN_NETWORK = "CASE WHEN replace(lower(card_network), ' ', '') = 'mc' THEN 'mastercard' ELSE replace(lower(card_network), ' ', '') END"
ATTRIBUTES = "brand_slug, sku_type_slug, channel_slug, traffic_source_short_name, bin, offer_type"

ADYEN = f"""SELECT ref_txn_id, id_text, processor, type, merchant_account, card_network, {ATTRIBUTES},
count(DISTINCT id_text) AS count FROM (
SELECT {REFERENCE} AS ref_txn_id, CAST(l_orderkey AS BIGINT) AS id_text, 'adyen' AS processor,
CASE l_returnflag WHEN 'R' THEN 'dispute' WHEN 'A' THEN 'fraud' ELSE 'settlement' END AS type,
'M' || (l_suppkey % 8) AS merchant_account, {NETWORK} AS card_network
FROM lineitem WHERE {LA.format("l_shipdate")} >= TIMESTAMP '1996-01-01' AND l_suppkey % 8 <> 7
AND (l_returnflag NOT IN ('R', 'A') OR l_linenumber NOT IN (6, 7))) e
LEFT JOIN ({TRANSACTIONS}) t ON t.id = e.id_text GROUP BY ALL"""

BRAINTREE = f"""SELECT ref_txn_id, id AS txn_id, 'braintree' AS processor, type, merchant_account,
CASE WHEN type = 'settlement' THEN option_network ELSE network END AS card_network, {ATTRIBUTES},
count(DISTINCT ref_txn_id) AS count FROM (
SELECT 'bt' || event_id AS ref_txn_id, 'm' || (user_id % 5) AS merchant_account, {JSON_NETWORK} AS network,
CASE event_type WHEN 'click' THEN 'dispute' WHEN 'error' THEN 'fraud' WHEN 'purchase' THEN 'settlement' END AS type
FROM events WHERE {LA.format("ts")} >= TIMESTAMP '1996-01-01' AND event_type IN ('click', 'error', 'purchase')
AND user_id % 5 <> 4 AND (event_type = 'error' OR {JSON_K} <> 0)) e
LEFT JOIN ({TRANSACTIONS}) t ON t.payment_processor_id = e.ref_txn_id GROUP BY ALL"""

WORLDPAY = f"""SELECT ref_txn_id, id AS txn_id, 'worldpay' AS processor, 'dispute' AS type, merchant_account,
CAST(NULL AS VARCHAR) AS card_network, brand_slug, CAST(NULL AS VARCHAR) AS sku_type_slug, channel_slug,
traffic_source_short_name, bin, offer_type, count(DISTINCT arn) AS count FROM (
SELECT 'bt' || l_orderkey AS ref_txn_id, 'SHOP LLC ' || (l_suppkey % 4) || ' - ' || (l_suppkey % 3) AS merchant_account,
'ARN' || l_partkey AS arn FROM lineitem
WHERE l_suppkey % 9 = 0 AND l_returnflag = 'R' AND {LA.format("l_shipdate")} >= TIMESTAMP '1996-01-01' AND l_suppkey % 4 <> 3) e
LEFT JOIN ({TRANSACTIONS}) t ON t.payment_processor_id = e.ref_txn_id GROUP BY ALL"""

_EVENTS = f"""SELECT ref_txn_id, id_text AS txn_id, processor, type, merchant_account, card_network, {ATTRIBUTES}, count FROM ({ADYEN})
UNION ALL BY NAME SELECT * FROM ({BRAINTREE})"""


def events(with_worldpay: bool = False) -> str:
    union = f"{_EVENTS} UNION ALL BY NAME SELECT * FROM ({WORLDPAY})" if with_worldpay else _EVENTS
    return f"SELECT * REPLACE ({CLEAN_NETWORK} AS card_network, {big('count')} AS count) FROM ({union})"


BAD = big("coalesce(sum(CASE WHEN type IN ('fraud', 'dispute') THEN count END), 0)")
GOOD = big("coalesce(sum(CASE WHEN type = 'settlement' THEN count END), 0)")


def ratios(counts: str, head: str, minimum: int | None) -> str:
    """Report columns over (level, ..., fraud_disputes_count, settled_count)."""
    where = "" if minimum is None else f"WHERE fraud_disputes_count > {minimum}"
    return f"""WITH counts AS ({counts}),
totals AS (SELECT level, {ratio("sum(fraud_disputes_count)", "sum(settled_count)")} AS g FROM counts GROUP BY level),
rated AS (SELECT c.*, {ratio("fraud_disputes_count", "settled_count")} AS r, g FROM counts c JOIN totals USING (level) {where})
SELECT {head}, fraud_disputes_count, settled_count, r AS ratio, g AS global_ratio,
r - g AS delta, r / g AS delta_percentage FROM rated"""


def risk_all(minimum: int) -> str:
    parts = [
        f"""SELECT '{d.upper()}' AS level, coalesce(CAST({d} AS VARCHAR), 'MISSING_{d.upper()}') AS value,
{BAD} AS fraud_disputes_count, {GOOD} AS settled_count FROM ev GROUP BY {d}"""
        for d in RISK_DIMENSIONS
    ]
    return ratios(f"WITH ev AS ({events()}) " + " UNION ALL ".join(parts), "level, value", minimum)


def risk_combinations(sizes: range, minimum: int) -> str:
    combos = [list(x) for size in sizes for x in combinations(RISK_DIMENSIONS, size)]
    sets = ", ".join(f"({', '.join(combo)})" for combo in combos)
    dims = ", ".join(RISK_DIMENSIONS)
    bit = {d: 1 << (len(RISK_DIMENSIONS) - 1 - i) for i, d in enumerate(RISK_DIMENSIONS)}
    used = ", ".join(f"CASE WHEN gid & {bit[d]} = 0 THEN '{d.upper()}' END" for d in RISK_DIMENSIONS)
    values = ", ".join(
        f"CASE WHEN gid & {bit[d]} = 0 THEN coalesce({d}, 'MISSING_{d.upper()}') END" for d in RISK_DIMENSIONS
    )
    grouped = f"""SELECT {dims}, grouping({dims}) AS gid, {BAD} AS fraud_disputes_count, {GOOD} AS settled_count
FROM ({events()}) GROUP BY GROUPING SETS ({sets})"""
    counts = f"""SELECT concat_ws('-', {used}) AS level, concat_ws('-', {values}) AS value,
fraud_disputes_count, settled_count FROM ({grouped})"""
    return ratios(counts, "level, value", minimum)


def risk_one(dimension: str) -> str:
    counts = f"""SELECT 1 AS level, coalesce({dimension}, 'MISSING_{dimension.upper()}') AS {dimension},
{BAD} AS fraud_disputes_count, {GOOD} AS settled_count FROM ({events()}) e GROUP BY e.{dimension}"""
    return ratios(counts, dimension, None)


# --- lifetime value ------------------------------------------------------------------------------

BILLINGS = """SELECT o_custkey AS customer_id, CAST(acquired AS DATE) AS acquisition_date, r_name AS brand,
c_mktsegment AS acquisition_sku_bucket, CAST(o_custkey % 3 AS VARCHAR) AS acquisition_channel,
CAST(o_custkey % 4 AS VARCHAR) AS payment_type, CAST(o_custkey % 2 AS VARCHAR) AS mobile,
o_custkey % 9 = 0 AS canceled,
floor(days / 30) * ((30 * (1 + o_custkey % 2)) / 30.0) AS age,
CASE WHEN l_linenumber <= 5 THEN price ELSE 0 END - CASE WHEN l_returnflag = 'R' THEN price ELSE 0 END AS net
FROM (SELECT *, date_diff('day', CAST(acquired AS DATE), CAST(l_shipdate AS DATE)) AS days,
CAST(l_extendedprice AS DECIMAL(18,2)) AS price FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN (SELECT o_custkey, min(o_orderdate) AS acquired FROM orders GROUP BY o_custkey) USING (o_custkey)
JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
WHERE days >= 0"""


def ltv(depths: list[int]) -> str:
    measures = ", ".join(
        f"CAST(sum(CASE WHEN age < {m} THEN net ELSE 0 END) AS DOUBLE) / count(DISTINCT customer_id) AS ltv_{m}mo"
        for m in LTV_MONTHS
    )
    last = max(depths)
    parts = []
    for depth in depths:
        dims = [d if i < depth else f"CAST(NULL AS VARCHAR) AS {d}" for i, d in enumerate(LTV_LEVELS[:last])]
        parts.append(f"""SELECT '{LTV_LEVELS[depth - 1]}' AS level, acquisition_date, {", ".join(dims)},
count(DISTINCT customer_id) AS cohort_size,
CAST(count(DISTINCT CASE WHEN canceled THEN customer_id END) AS DOUBLE) / count(DISTINCT customer_id) AS canceled_day_1,
{measures} FROM b GROUP BY acquisition_date, {", ".join(LTV_LEVELS[:depth])}""")
    return f"WITH b AS ({BILLINGS}) " + " UNION ALL ".join(parts)


LTV_DAY = "strftime(acquisition_date, '%Y-%m-%d')"


def ltv_plain(sql: str) -> str:
    return plain(sql, acquisition_date=LTV_DAY)


DAILY = """SELECT event_type, CAST(ts AS DATE) AS ds, CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) AS y
FROM events GROUP BY event_type, CAST(ts AS DATE)"""
MONTHLY = f"""SELECT r_name, CAST(date_trunc('month', o_orderdate) AS DATE) AS ds, CAST(count(*) AS DOUBLE) AS y
FROM ({ORDERS}) GROUP BY r_name, CAST(date_trunc('month', o_orderdate) AS DATE)"""
