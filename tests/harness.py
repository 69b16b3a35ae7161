"""Spark-vs-DuckDB comparison used by the tests and by ``python -m tests.harness``."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time

import duckdb

from stakeflow.sources.fixtures import BASE_TABLES


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6) + 0.0
    if hasattr(v, "item") and not isinstance(v, (list, tuple)):
        try:
            return _norm(v.item())
        except Exception:
            pass
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr), [columns[i] for i in order]


def compare(spark, con, name, build, sql, sf_dir):
    t0 = time.time()
    sdf = build(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    s, scols = rows_of(sdf.columns, srows)
    if sql is None:
        return dict(name=name, ok=None, rows=len(s), spark_s=round(t1 - t0, 2))
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    d, dcols = rows_of(dcols, drows)
    ok = scols == dcols and s == d
    info = dict(name=name, ok=ok, rows=len(s), oracle_rows=len(d), spark_s=round(t1 - t0, 2))
    if not ok:
        info["cols"] = (scols, dcols) if scols != dcols else None
        ds, ss = set(d), set(s)
        diff = [x for x in s if x not in ds][:3]
        diff2 = [x for x in d if x not in ss][:3]
        info["spark_only"] = diff
        info["oracle_only"] = diff2
    return info


def main(argv):
    sf_dir = "/root/testdata/sf0.01"
    names = [a for a in argv if not a.startswith("--")]
    for a in argv:
        if a.startswith("--sf="):
            sf_dir = a.split("=", 1)[1]
    sys.path.insert(0, ".")
    import __spark_entry__ as E
    from stakeflow.session import get_spark
    spark = get_spark("local[8]")
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for n, fn in qs.items():
        if names and n not in names:
            continue
        try:
            info = compare(spark, con, n, fn, sqls.get(n), sf_dir)
        except Exception as exc:  # report and continue
            info = dict(name=n, ok=False, error=f"{type(exc).__name__}: {str(exc)[:400]}")
        bad += info.get("ok") is False
        print(info, flush=True)
    print("FAILED" if bad else "ALL OK", bad)


if __name__ == "__main__":
    main(sys.argv[1:])
