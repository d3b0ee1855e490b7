"""Spark vs DuckDB oracle comparison (same contract as the driver's check).

CLI: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

import duckdb

RAW = ("region nation customer supplier part orders lineitem events documents "
       "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in RAW:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, (bytes, bytearray, memoryview)):
        return bytes(v).hex()
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def rows_of_spark(df):
    cols = sorted(df.columns)
    out = [tuple(_norm(r[c]) for c in cols) for r in df.select(*cols).collect()]
    return cols, out


def rows_of_duck(con, sql):
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    data = rel.fetchall()
    cols = sorted(names)
    idx = [names.index(c) for c in cols]
    return cols, [tuple(_norm(r[i]) for i in idx) for r in data]


def _key(t):
    return tuple((0, "") if x is None else (1, str(x)) for x in t)


def compare(spark, sf_dir, names=None, verbose=True):
    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as E

    qs, ora = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for n in (names or list(qs)):
        t0 = time.time()
        try:
            sc, sr = rows_of_spark(qs[n](spark, sf_dir))
        except Exception as e:  # noqa: BLE001
            results[n] = ("spark-error", str(e)[:300])
            if verbose:
                print(f"@@ {n:34s} SPARK ERROR {str(e)[:300]}")
            continue
        ts = time.time() - t0
        if n not in ora:
            results[n] = ("rows-only", len(sr))
            if verbose:
                print(f"@@ {n:34s} rows-only {len(sr)} ({ts:.1f}s)")
            continue
        try:
            dc, dr = rows_of_duck(con, ora[n])
        except Exception as e:  # noqa: BLE001
            results[n] = ("oracle-error", str(e)[:300])
            if verbose:
                print(f"@@ {n:34s} ORACLE ERROR {str(e)[:400]}")
            continue
        if sc != dc:
            results[n] = ("schema", (sc, dc))
            if verbose:
                print(f"@@ {n:34s} SCHEMA spark={sc} oracle={dc}")
            continue
        ss, ds = sorted(sr, key=_key), sorted(dr, key=_key)
        ok = ss == ds
        results[n] = ("ok" if ok else "mismatch", len(sr), len(dr))
        if verbose:
            print(f"@@ {n:34s} {'OK ' if ok else 'MISMATCH'} spark={len(sr)} oracle={len(dr)} ({ts:.1f}s)")
            if not ok:
                a, b = set(ss), set(ds)
                print("@@   spark-only:", sorted(a - b, key=_key)[:3])
                print("@@   oracle-only:", sorted(b - a, key=_key)[:3])
    return results


if __name__ == "__main__":
    sys.path.insert(0, "/root/repo")
    from dockyard.session import get_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = get_session()
    res = compare(spark, sf, names)
    bad = [k for k, v in res.items() if v[0] not in ("ok", "rows-only")]
    print("@@ FAILED:", bad)
