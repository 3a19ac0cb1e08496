"""Compare queries with their SQL oracles.

    python -m tests.oracle [--sf 0.01] [name ...]
"""

from __future__ import annotations

import argparse
import sys
import time
import traceback
from decimal import Decimal

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return db


def _cell(value) -> str:
    if value is None or (isinstance(value, float) and value != value) or value is pd.NaT or value is pd.NA:
        return "null"
    if isinstance(value, Decimal):
        return f"decimal {value}"
    if isinstance(value, bool):
        return str(value)
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, float):
        return repr(value + 0.0)
    return str(value)


def table_rows(columns: list[str], rows: list) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def difference(spark_df, db: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when equal, else what differs first."""
    left_cols, left = table_rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    result = db.execute(sql)
    right_cols, right = table_rows([d[0] for d in result.description], result.fetchall())
    if left_cols != right_cols:
        return f"columns {left_cols} != {right_cols}"
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}"
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    import __spark_entry__ as entry
    from shopsight.session import build_session

    sf_dir = f"/root/testdata/sf{args.sf}"
    spark = build_session("oracle", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(sf_dir)
    oracles, failed = entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if args.names and not any(name.startswith(n) for n in args.names):
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            said = difference(df, db, oracles[name]) if name in oracles else f"rows only: {len(df.collect())}"
        except Exception:
            said = "ERROR " + " | ".join(traceback.format_exc().strip().splitlines()[-3:])[:900]
        bad = said is not None and not said.startswith("rows only")
        failed += bad
        print(f"{'FAIL' if bad else 'ok  '} {name} {time.time() - start:.1f}s {said or ''}"[:1200], flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main())
