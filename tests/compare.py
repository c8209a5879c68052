"""Run registered queries and their SQL side by side: python tests/compare.py [sf_dir] [name ...]."""

from __future__ import annotations

import glob
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        df[c] = df[c].map(_cell)
    return df.sort_values(list(df.columns), kind="stable").reset_index(drop=True)


def _cell(v) -> str:
    if v is None or v is pd.NaT or (isinstance(v, float) and v != v) or v is pd.NA:
        return "null"
    if isinstance(v, (pd.Timestamp,)) or hasattr(v, "isoformat"):
        return str(pd.Timestamp(v))
    if isinstance(v, bool) or type(v).__name__ == "bool_":
        return str(bool(v))
    if type(v).__name__.startswith(("int", "uint")):
        return str(int(v))
    if type(v).__name__.startswith("float"):
        return str(int(v)) if float(v).is_integer() else repr(float(v))
    return str(v)


def difference(spark_rows: pd.DataFrame, sql_rows: pd.DataFrame) -> str | None:
    if sorted(spark_rows.columns) != sorted(sql_rows.columns):
        return f"columns {sorted(spark_rows.columns)} != {sorted(sql_rows.columns)}"
    if len(spark_rows) != len(sql_rows):
        return f"rows {len(spark_rows)} != {len(sql_rows)}"
    a, b = canonical(spark_rows), canonical(sql_rows)
    bad = (a != b).any(axis=1)
    if bad.any():
        cols = [c for c in a.columns if (a[c] != b[c]).any()]
        i = bad.idxmax()
        return f"{int(bad.sum())} rows differ in {cols}; first: {a.loc[i, cols].to_dict()} vs {b.loc[i, cols].to_dict()}"
    return None


def main() -> int:
    import __spark_entry__ as entry
    from barlight.session import get_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session(**{"spark.master": "local[8]", "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, failed = connect(sf_dir), entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            rows = fn(spark, sf_dir).toPandas()
            took = time.time() - start
            sql = oracles.get(name)
            problem = None if sql is None else difference(rows, con.execute(sql).df())
        except Exception as error:
            took, problem, rows, sql = time.time() - start, f"{type(error).__name__}: {str(error)[:1500]}", [], ""
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name:28s} rows={len(rows):6d} {took:6.2f}s {'' if sql else '(rows only)'} {problem or ''}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    raise SystemExit(1 if main() else 0)
