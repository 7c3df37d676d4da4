"""Run registered queries on Spark and their SQL on DuckDB and compare.

Usage: python tests/oracle_check.py [--sf DIR] [name ...]

Columns are compared by name, rows order-insensitively; doubles are
compared after rounding to 9 significant decimals and reported separately
when only they differ.
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events "
          "documents embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM "
                    f"read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, exact: bool):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return repr(v) if exact else f"{v:.9g}"
    if isinstance(v, pd.Timestamp):
        return v.isoformat()
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    if hasattr(v, "item"):
        return _norm(v.item(), exact)
    return str(v)


def rows(df: pd.DataFrame, exact: bool) -> list[tuple]:
    cols = sorted(df.columns)
    out = []
    for rec in df[cols].itertuples(index=False):
        out.append(tuple(_norm(None if (not isinstance(x, (list, dict))
                                        and pd.isna(x)) else x, exact)
                         for x in rec))
    return sorted(out, key=lambda r: tuple("" if x is None else str(x)
                                           for x in r))


def compare(spark, name, fn, sql, sf_dir, con) -> dict:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    spdf = sdf.toPandas()
    t1 = time.time()
    res = {"name": name, "spark_rows": len(spdf), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    opdf = con.execute(sql).df()
    res["oracle_rows"] = len(opdf)
    if sorted(spdf.columns) != sorted(opdf.columns):
        res["status"] = "COLUMNS"
        res["detail"] = (sorted(spdf.columns), sorted(opdf.columns))
        return res
    if len(spdf) != len(opdf):
        res["status"] = "ROWCOUNT"
        return res
    if rows(spdf, True) == rows(opdf, True):
        res["status"] = "ok"
    elif rows(spdf, False) == rows(opdf, False):
        res["status"] = "ok~float"
    else:
        a, b = rows(spdf, False), rows(opdf, False)
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        res["status"] = "VALUES"
        res["detail"] = {"cols": sorted(spdf.columns), "diff": diff}
    res["dtypes"] = {c: (str(spdf[c].dtype), str(opdf[c].dtype))
                     for c in sorted(spdf.columns)
                     if str(spdf[c].dtype) != str(opdf[c].dtype)}
    return res


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--driver-memory", default=None)
    ap.add_argument("--shuffle-partitions", type=int, default=8)
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    import __spark_entry__ as entry
    from runledger.session import build_session
    extra = ({"spark.driver.memory": args.driver_memory}
             if args.driver_memory else None)
    spark = build_session("local[8]", shuffle_partitions=args.shuffle_partitions,
                          extra=extra)
    spark.sparkContext.setLogLevel("ERROR")
    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duck(args.sf)
    names = args.names or list(qs)
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, qs[n], sqls.get(n), args.sf, con)
        except Exception as e:  # report and continue
            r = {"name": n, "status": "ERROR", "detail": repr(e)[:800]}
        if r["status"] not in ("ok", "rows-only"):
            bad += 1
        print(r, flush=True)
    print(f"{len(names) - bad}/{len(names)} clean")


if __name__ == "__main__":
    main()
