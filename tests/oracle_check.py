"""Run registered queries on Spark and their oracle SQL on DuckDB; compare.

Usage: python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, exact: bool):
    if v is None:
        return None
    if isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        v = v + 0.0
        return v if exact else float(f"{v:.9g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item(), exact)
    return v


def _rows(rows, cols, exact):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i], exact) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0)
                                           for x in t))


def compare(spark_df, con, sql: str):
    srows = [tuple(r) for r in spark_df.collect()]
    scols = spark_df.columns
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    if sorted(scols) != sorted(dcols):
        return "COLUMNS", f"spark={scols} duck={dcols}"
    if len(srows) != len(drows):
        return "ROWCOUNT", f"spark={len(srows)} duck={len(drows)}"
    if _rows(srows, scols, True) == _rows(drows, dcols, True):
        return "EXACT", ""
    a, b = _rows(srows, scols, False), _rows(drows, dcols, False)
    if a == b:
        return "APPROX", ""
    diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
    return "VALUES", f"{sorted(scols)} first diffs: {diff}"


def main(argv):
    sys.path.insert(0, ".")
    from __spark_entry__ import oracle_sql, queries
    from starforge.session import get_session
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    spark = get_session()
    con = duck(sf)
    qs, sqls = queries(), oracle_sql()
    summary = {}
    for name, fn in qs.items():
        if only and name not in only:
            continue
        if name not in sqls:
            summary[name] = "NO_SQL"
            print(f"NO_SQL {name}")
            continue
        try:
            status, info = compare(fn(spark, sf), con, sqls[name])
        except Exception as e:  # report and go on
            status, info = "ERROR", str(e)[:800]
        summary[name] = status
        print(f"{status} {name} {info}")
    bad = {k: v for k, v in summary.items() if v not in ("EXACT", "NO_SQL")}
    print("NOT EXACT:", bad)
    return 0 if not bad else 1


if __name__ == "__main__":
    sys.exit(main(sys.argv))
