"""Run queries and their SQL side by side: ``python -m checks.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import sys
import time

import duckdb

from checks.queries import ORACLE, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


def _value(x):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return ""
    if isinstance(x, bool):
        return str(x)
    if isinstance(x, float):
        return repr(x + 0.0)
    return str(x)


def normal(columns, rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_value(row[i]) for i in order) for row in rows)


def spark_result(df):
    return normal(df.columns, [tuple(r) for r in df.collect()])


def sql_result(db, sql: str):
    cursor = db.execute(sql)
    return normal([d[0] for d in cursor.description], cursor.fetchall())


def difference(spark, db, sf_dir: str, name: str) -> str | None:
    """None when both sides agree, else what differs."""
    ours = spark_result(QUERIES[name](spark, sf_dir))
    if name not in ORACLE:
        return None if ours[1] else "no rows"
    theirs = sql_result(db, ORACLE[name])
    if ours[0] != theirs[0]:
        return f"columns differ: {sorted(set(ours[0]) ^ set(theirs[0]))}"
    if len(ours[1]) != len(theirs[1]):
        return f"{len(ours[1])} rows, expected {len(theirs[1])}"
    for a, b in zip(*(side[1] for side in (ours, theirs))):
        if a != b:
            wrong = [(n, x, y) for n, x, y in zip(ours[0], a, b) if x != y]
            return f"first differing row: {wrong[:4]}"
    return None if ours[1] else "no rows on either side"


def main() -> int:
    from vintner.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark, db = local_session(), connect(sf_dir)
    failures = 0
    for name in names:
        started = time.time()
        try:
            problem = difference(spark, db, sf_dir, name)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failures += problem is not None
        kind = "sql " if name in ORACLE else "rows"
        print(f"{'ok  ' if problem is None else 'FAIL'} {kind} {name:28} {time.time() - started:6.1f}s {problem or ''}", flush=True)
    print(f"{len(names) - failures}/{len(names)} agree")
    return failures


if __name__ == "__main__":
    sys.exit(main())
