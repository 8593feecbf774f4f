"""Compare registered queries with their SQL on the same tables.

    python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import tempfile
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


def bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(cell(row[i]) for i in order) for row in rows)


def compare(df, con, statement: str) -> str | None:
    """None when equal, otherwise what differs."""
    result = con.execute(statement)
    expected_columns = [d[0] for d in result.description]
    expected = bag(expected_columns, result.fetchall())
    if sorted(df.columns) != sorted(expected_columns):
        return f"columns {sorted(df.columns)} != {sorted(expected_columns)}"
    got = bag(df.columns, [tuple(r) for r in df.collect()])
    if got == expected:
        return None
    missing, extra = expected - got, got - expected
    return (
        f"{sum(got.values())} rows, expected {sum(expected.values())}; "
        f"missing {sum(missing.values())} e.g. {list(missing)[:3]}; "
        f"extra {sum(extra.values())} e.g. {list(extra)[:3]}"
    )


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from tidegauge import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(
        "oracle-check",
        "local[8]",
        {"spark.checkpoint.dir": tempfile.mkdtemp(prefix="oracle-check-"), "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8",
         "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("FATAL")
    con = connect(sf_dir)
    oracles, bad = oracle_sql(), 0
    for name, run in queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        began = time.time()
        try:
            df = run(spark, sf_dir)
            problem = compare(df, con, oracles[name]) if name in oracles else None
            n = "" if name in oracles else f"(no SQL, {df.count()} rows)"
        except Exception as error:  # report and go on
            problem, n = f"{type(error).__name__}: {str(error)[:600]}", ""
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - began:.1f}s {n} {problem or ''}", flush=True)
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(main())
