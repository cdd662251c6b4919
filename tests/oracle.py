"""Runs queries beside their SQL: ``python tests/oracle.py sf0.01 [name...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

DATA = "/root/testdata"


def connect(directory: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for p in sorted(Path(directory).iterdir()):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p if p.is_file() else f'{p}/*.parquet'}'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=str)


def compare(spark, name, query, sql, directory):
    """(seconds, rows, None or the difference)."""
    began = time.time()
    df = query(spark, directory)
    got = rows_of(df.columns, df.collect())
    took = time.time() - began
    if sql is None:
        return took, len(got), None
    cur = connect(directory).execute(sql)
    names = [c[0] for c in cur.description]
    want = rows_of(names, cur.fetchall())
    if sorted(names) != sorted(df.columns):
        return took, len(got), f"columns {sorted(df.columns)} != {sorted(names)}"
    if got != want:
        a, b = set(map(str, got)), set(map(str, want))
        return took, len(got), f"{len(got)} rows, SQL {len(want)}; only here {sorted(a - b)[:3]}; only SQL {sorted(b - a)[:3]}"
    return took, len(got), None


def main() -> None:
    import __spark_entry__ as e
    from caseloom.session import get_spark

    spark = get_spark(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    qs, sqls = e.queries(), e.oracle_sql()
    wanted = sys.argv[2:] or list(qs)
    bad = 0
    for name in [q for w in wanted for q in qs if q == w or (w.endswith("*") and q.startswith(w[:-1]))]:
        try:
            took, n, diff = compare(spark, name, qs[name], sqls.get(name), f"{DATA}/{sys.argv[1]}")
        except Exception as x:  # noqa: BLE001
            took, n, diff = 0, 0, "\n".join(y for y in str(x).splitlines() if not y.strip().startswith("at "))[:1500]
        bad += diff is not None
        print(f"{'ok  ' if diff is None and name in sqls else 'rows' if diff is None else 'BAD '} {name} {took:.1f}s {n} rows {diff or ''}", flush=True)
    sys.exit(bad > 0)


if __name__ == "__main__":
    main()
