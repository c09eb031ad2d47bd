"""Run registered queries against their SQL: python tests/check.py [data folder] [name ...]."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def duck(folder: str):
    import duckdb

    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, date):
        return value.isoformat()
    return value


def counted(rows, order) -> Counter:
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def compare(name: str, result, connection, sql: str) -> list[str]:
    """Differences between a Spark result and its SQL, empty if they agree."""
    expected = connection.execute(sql)
    expected_names = [d[0] for d in expected.description]
    names = result.columns
    if sorted(names) != sorted(expected_names):
        return [f"{name}: columns {sorted(names)} != {sorted(expected_names)}"]
    got = counted(result.collect(), sorted(range(len(names)), key=names.__getitem__))
    want = counted(expected.fetchall(), sorted(range(len(names)), key=expected_names.__getitem__))
    if got == want:
        return []
    return [
        f"{name}: {sum(got.values())} rows, expected {sum(want.values())}; columns {sorted(names)}",
        *[f"  only spark: {r}" for r in list((got - want).items())[:4]],
        *[f"  only sql:   {r}" for r in list((want - got).items())[:4]],
    ]


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    chosen = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8").config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = duck(folder)
    oracle = entry.oracle_sql()
    failed = 0
    for name, build in entry.queries().items():
        if chosen and name not in chosen:
            continue
        started = time.time()
        try:
            result = build(spark, folder)
            if name in oracle:
                problems = compare(name, result, connection, oracle[name])
            else:
                problems = []
                print(f"{name}: no SQL, {len(result.collect())} rows")
        except Exception as error:  # noqa: BLE001
            problems = [f"{name}: {type(error).__name__}: {str(error)[:900]}"]
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - started:.1f}s")
        print("\n".join(problems), end="\n" if problems else "")
    print("failed:", failed)
    spark.stop()
