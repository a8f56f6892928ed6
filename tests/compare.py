"""Spark-vs-DuckDB comparison in the manner of the driver's correctness gate:
row count, column names, order-insensitive values (doubles to 6 digits).

    python tests/compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
ROOT = os.path.dirname(HERE)
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 6) + 0.0)
    if isinstance(v, (list, tuple)):
        return repr([_norm(x) for x in v])
    if hasattr(v, "asDict"):
        return repr({k: _norm(x) for k, x in v.asDict().items()})
    if isinstance(v, dict):
        return repr({k: _norm(x) for k, x in v.items()})
    return repr(v)


def rows_key(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    import __spark_entry__ as E

    con = con or duck(sf_dir)
    t0 = time.time()
    df = E.queries()[name](spark, sf_dir)
    srows = df.collect()
    scols = df.columns
    t1 = time.time()
    sq = E.oracle_sql().get(name)
    res = {"name": name, "spark_rows": len(srows), "spark_sec": round(t1 - t0, 2)}
    if sq is None:
        res["oracle"] = "none"
        return res
    cur = con.execute(sq)
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    res.update(duck_rows=len(drows), duck_sec=round(time.time() - t1, 2),
               schema_ok=sorted(scols) == sorted(dcols))
    res["values_ok"] = res["schema_ok"] and rows_key(scols, srows) == rows_key(dcols, drows)
    if not res["schema_ok"]:
        res["cols"] = (scols, dcols)
    elif not res["values_ok"]:
        a, b = rows_key(scols, srows), rows_key(dcols, drows)
        sa, sb = set(a), set(b)
        res["only_spark"] = sorted(sa - sb)[:3]
        res["only_duck"] = sorted(sb - sa)[:3]
    return res


if __name__ == "__main__":
    from brandlink.session import get_spark

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = get_spark(extra={"spark.ui.showConsoleProgress": "false"})
    import __spark_entry__ as E

    con = duck(sf)
    for n in names or list(E.queries()):
        try:
            print(compare(spark, n, sf, con), flush=True)
        except Exception as exc:  # report and continue
            print({"name": n, "error": repr(exc)[:400]}, flush=True)
