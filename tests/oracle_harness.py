"""Run named queries on Spark and their DuckDB twins; compare the results.

Comparison: columns sorted by name, rows sorted, values normalised (floats to
9 significant digits, arrays/maps element-wise).  Also reports whether the
results are *bit-identical* (no normalisation), which is what a strict value
hash needs.

    python tests/oracle_harness.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v, sig: int | None):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if sig is None or v == 0 or math.isinf(v):
            return v
        return float(f"{v:.{sig}g}")
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, sig) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x, sig)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return tuple(_norm(x, sig) for x in v)
    if isinstance(v, dt.datetime) and v.tzinfo is not None:
        return v.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return v


def _rows(names, rows, sig):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_norm(r[i], sig) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_names = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t_spark = time.time() - t0
    res = {"name": name, "rows": len(s_rows), "spark_s": round(t_spark, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    t0 = time.time()
    cur = con.execute(sql)
    d_names = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    res["duck_s"] = round(time.time() - t0, 2)
    res["duck_rows"] = len(d_rows)
    if sorted(s_names) != sorted(d_names):
        res["status"] = f"COLUMNS differ spark={sorted(s_names)} duck={sorted(d_names)}"
        return res
    exact = _rows(s_names, s_rows, None) == _rows(d_names, d_rows, None)
    close = exact or _rows(s_names, s_rows, 9) == _rows(d_names, d_rows, 9)
    res["status"] = "exact" if exact else ("close" if close else "MISMATCH")
    if not close:
        a, b = _rows(s_names, s_rows, 9), _rows(d_names, d_rows, 9)
        sa, sb = set(a), set(b)
        diff_a = [r for r in a if r not in sb][:3]
        diff_b = [r for r in b if r not in sa][:3]
        res["spark_only"] = diff_a
        res["duck_only"] = diff_b
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    wanted = [a for a in argv[1:] if not a.startswith("/")]
    from featflow.session import local_session
    import __spark_entry__ as E

    spark = local_session(8)
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if wanted and name not in wanted:
            continue
        try:
            r = compare(spark, con, name, fn, sqls.get(name), sf_dir)
        except Exception as e:  # report and continue
            r = {"name": name, "status": f"ERROR {type(e).__name__}: {str(e)[:300]}"}
        bad += r["status"] not in ("exact", "close", "rows-only")
        print(r, flush=True)
    print("FAILED" if bad else "ALL OK", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
