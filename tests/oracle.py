"""Spark-vs-DuckDB comparison used by the tests (and runnable as a script).

Both results are normalised the same way: columns sorted by name, values
converted to plain Python objects, rows sorted. Doubles must agree exactly
(the registered queries round where engines may differ).
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(base: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{base}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


def normalise(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    out.sort(key=_key)
    return cols, out


def spark_rows(df):
    return list(df.columns), [tuple(r) for r in df.collect()]


def duck_rows(con, sql):
    res = con.execute(sql)
    cols = [d[0] for d in res.description]
    return cols, res.fetchall()


SPARK_TO_DUCKDB = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
    "date": "DATE", "boolean": "BOOLEAN", "float": "FLOAT", "timestamp_ntz": "TIMESTAMP",
}


def type_differences(spark_df, con, sql) -> dict:
    spark_types = {c: SPARK_TO_DUCKDB.get(t, t) for c, t in spark_df.dtypes}
    rel = con.sql(sql)
    duck_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    return {c: (spark_types.get(c), duck_types.get(c))
            for c in set(spark_types) | set(duck_types) if spark_types.get(c) != duck_types.get(c)}


def compare(spark_df, con, sql) -> list[str]:
    """Empty list when equal, else human-readable differences."""
    types = type_differences(spark_df, con, sql)
    if types:
        return [f"column types differ (spark, duckdb): {types}"]
    sc, sr = normalise(*spark_rows(spark_df))
    dc, dr = normalise(*duck_rows(con, sql))
    problems = []
    if sc != dc:
        problems.append(f"columns differ: spark={sc} duckdb={dc}")
        return problems
    if len(sr) != len(dr):
        problems.append(f"row count differs: spark={len(sr)} duckdb={len(dr)}")
    bad = [(a, b) for a, b in zip(sr, dr) if a != b]
    if bad:
        problems.append(f"{len(bad)} rows differ, first: spark={bad[0][0]} duckdb={bad[0][1]}")
    return problems


if __name__ == "__main__":
    import os
    import time

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as E
    from tallycast import build_session

    base = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark = build_session()
    con = duck(base)
    sqls = E.oracle_sql()
    failed = 0
    for name, fn in E.queries().items():
        if only and name not in only:
            continue
        t = time.time()
        try:
            df = fn(spark, base)
            if name in sqls:
                probs = compare(df, con, sqls[name])
                status = "OK" if not probs else "FAIL " + "; ".join(probs)
            else:
                status = f"rows-only {df.count()}"
        except Exception as exc:  # noqa: BLE001
            status = f"ERROR {type(exc).__name__}: {str(exc)[:300]}"
        failed += status.startswith(("FAIL", "ERROR"))
        print(f"{name:28s} {time.time() - t:6.2f}s {status}", flush=True)
    print("failed:", failed)
