"""Compare named queries with their SQL: ``python tests/oracle_check.py <dir> [name ...]``."""

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(d):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{d}/{t}.parquet')")
    return con


def _cell(v):
    if v is None or v is pd.NaT or (isinstance(v, float) and v != v) or v is pd.NA:
        return "null"
    if isinstance(v, bool) or type(v).__name__ == "bool_":
        return str(bool(v))
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, (int, float)):
        return repr(float(v) + 0.0)
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    return str(v)


def canonical(frame):
    frame = frame[sorted(frame.columns)]
    rows = [tuple(_cell(v) for v in row) for row in frame.astype(object).itertuples(index=False, name=None)]
    return list(frame.columns), sorted(rows)


def compare(spark_frame, sql_frame):
    """None if equal, else what differs."""
    a_cols, a = canonical(spark_frame)
    b_cols, b = canonical(sql_frame)
    if a_cols != b_cols:
        return f"columns {a_cols} vs {b_cols}"
    if len(a) != len(b):
        return f"rows {len(a)} vs {len(b)}"
    for x, y in zip(a, b, strict=True):
        if x != y:
            return f"{sum(x != y for x, y in zip(a, b, strict=True))} rows, first {x} vs {y}"
    return None


def main(d, names):
    from gridtide.catalog import ORACLES, QUERIES
    from gridtide.session import local_session

    spark, con, bad = local_session(8), connect(d), 0
    for name in names or QUERIES:
        start = time.time()
        try:
            got = QUERIES[name](spark, d).toPandas()
            spent = time.time() - start
            problem = compare(got, con.sql(ORACLES[name]).df()) if name in ORACLES else f"no SQL ({len(got)} rows)"
        except Exception as e:  # noqa: BLE001
            problem, spent = f"{type(e).__name__}: {str(e)[:600]}", time.time() - start
        bad += bool(problem) and name in ORACLES
        print(f"{name:32s} {spent:6.2f}s  {problem or 'ok'}", flush=True)
    print("differing:", bad)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
