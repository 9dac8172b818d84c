"""Run a registered query in Spark and its oracle SQL in DuckDB; compare.

Columns are matched by name; rows are compared as an order-insensitive
multiset after normalising values (floats to 6 decimals, decimals to float,
dates/timestamps to ISO text, NaN to None).
"""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

from pitlane.sources.fixtures import BASE_TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    con.execute("SET TimeZone='UTC'")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return None
        r = round(v, 6)
        return 0.0 if r == 0 else r
    if isinstance(v, int):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "asDict"):
        return _norm(v.asDict(recursive=True))
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((str(k), _norm(x)) for k, x in v.items()))
    return v


def _coarse(v):
    if isinstance(v, float):
        return round(v, 3)
    if isinstance(v, tuple):
        return tuple(_coarse(x) for x in v)
    return v


def _close(x, y):
    if isinstance(x, float) and isinstance(y, float):
        return math.isclose(x, y, rel_tol=1e-9, abs_tol=2e-6)
    if isinstance(x, tuple) and isinstance(y, tuple):
        return len(x) == len(y) and all(_close(p, q) for p, q in zip(x, y))
    return x == y


def _approx_equal(a, b):
    """Rows equal up to float tolerance (last-bit differences around a rounding tie)."""
    ka = sorted(a, key=lambda r: _key(_coarse(r)))
    kb = sorted(b, key=lambda r: _key(_coarse(r)))
    return all(_close(x, y) for x, y in zip(ka, kb))


def _key(row):
    return tuple((x is None, repr(x)) for x in row)


def compare(spark_rows, spark_cols, duck_rows, duck_cols, max_show=5):
    problems = []
    sc = sorted(spark_cols)
    dc = sorted(duck_cols)
    if sc != dc:
        return [f"columns differ: spark-only {sorted(set(sc) - set(dc))}, oracle-only {sorted(set(dc) - set(sc))}"]
    si = [spark_cols.index(c) for c in sc]
    di = [duck_cols.index(c) for c in sc]
    a = sorted((tuple(_norm(r[i]) for i in si) for r in spark_rows), key=_key)
    b = sorted((tuple(_norm(r[i]) for i in di) for r in duck_rows), key=_key)
    if len(a) != len(b):
        problems.append(f"row count spark={len(a)} oracle={len(b)}")
    diff = 0
    sa, sb = set(map(repr, a)), set(map(repr, b))
    only_a = [r for r in a if repr(r) not in sb]
    only_b = [r for r in b if repr(r) not in sa]
    if (only_a or only_b) and len(a) == len(b) and _approx_equal(a, b):
        return problems
    if only_a or only_b or (a != b and not problems):
        diff = max(len(only_a), len(only_b))
        problems.append(f"{diff} differing rows; columns {sc}")
        for r in only_a[:max_show]:
            problems.append(f"  spark : {r}")
        for r in only_b[:max_show]:
            problems.append(f"  oracle: {r}")
    return problems


def run_pair(spark, con, name, fn, sql, sf_dir):
    df = fn(spark, sf_dir)
    cols = df.columns
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    return compare(rows, cols, drows, dcols), len(rows)
