"""Run the registered queries against DuckDB: python tests/compare.py [folder] [name ...]"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _cell(x):
    if isinstance(x, float) and math.isnan(x):
        return ("nan",)
    return (x is None, type(x).__name__, x if x is not None else 0)


def canonical(columns: list[str], rows: list[tuple]) -> list[tuple]:
    """Rows with columns in name order, sorted; values keep their Python types."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(spark_df, con, sql: str) -> str | None:
    """None if both sides agree exactly, else what differs."""
    con.execute(f"CREATE OR REPLACE VIEW checked AS {sql}")  # SQL that cannot be a view is no query
    result = con.execute("SELECT * FROM checked")
    names = [d[0] for d in result.description]
    theirs = result.fetchall()
    ours = [tuple(r) for r in spark_df.collect()]
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}"
    a, b = canonical(spark_df.columns, ours), canonical(names, theirs)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        x, y = bad[0]
        cells = [(n, p[1:], q[1:]) for n, p, q in zip(sorted(names), x, y) if p != q]
        return f"{len(bad)} of {len(a)} rows differ, first: {cells}"
    return None


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from tillwise.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session("compare")
    con = duck(folder)
    sql = oracle_sql()
    chosen = sys.argv[2:] or list(queries())
    failed = 0
    for name in chosen:
        start = time.time()
        try:
            df = queries()[name](spark, folder)
            outcome = differences(df, con, sql[name])
        except Exception as e:  # noqa: BLE001
            outcome = f"{type(e).__name__}: {str(e)[:600]}"
        failed += outcome is not None
        print(f"{name:32s} {time.time() - start:6.2f}s  {outcome or 'ok'}", flush=True)
    print("failed:", failed)
