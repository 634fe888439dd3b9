"""Side-by-side check of queries() against oracle_sql() (Spark vs DuckDB).

Usable from pytest and as a script:  python tests/oracle_compare.py [sf_dir] [key ...]
Compares row count, column names and an order-insensitive hash of the values.
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "float": "FLOAT"}


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, bool):
        return "b1" if v else "b0"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if v == int(v) and abs(v) < 2**53:
            return f"n{int(v)}"
        return f"f{v!r}"
    if isinstance(v, int):
        return f"n{v}"
    try:  # numpy scalars
        import numpy as np

        if isinstance(v, np.generic):
            return _norm(v.item())
    except ImportError:
        pass
    return f"s{v}"


def digest(columns: list[str], rows: list[tuple]) -> str:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def compare(spark, sf_dir: str, keys=None, con=None, verbose=True) -> dict[str, dict]:
    import __spark_entry__ as E

    qs, sql = E.queries(), E.oracle_sql()
    con = con or duck(sf_dir)
    out = {}
    for k in keys or list(sql):
        t0 = time.time()
        try:
            df = qs[k](spark, sf_dir)
            s_cols = df.columns
            s_rows = [tuple(r) for r in df.collect()]
            t1 = time.time()
            rel = con.sql(sql[k])
            d_cols = rel.columns
            d_rows = rel.fetchall()
            s_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
            d_types = {c: str(t) for c, t in zip(d_cols, rel.types)}
            res = {
                "rows": (len(s_rows), len(d_rows)),
                "cols_match": sorted(s_cols) == sorted(d_cols),
                "types_match": s_types == d_types,
                "hash_match": digest(s_cols, s_rows) == digest(d_cols, d_rows),
                "spark_s": round(t1 - t0, 2),
            }
            if not res["cols_match"]:
                res["col_diff"] = (sorted(set(s_cols) - set(d_cols)), sorted(set(d_cols) - set(s_cols)))
            elif not res["hash_match"]:
                order_s = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
                order_d = sorted(range(len(d_cols)), key=lambda i: d_cols[i])
                ss = sorted("|".join(_norm(r[i]) for i in order_s) for r in s_rows)
                dd = sorted("|".join(_norm(r[i]) for i in order_d) for r in d_rows)
                res["example"] = (sorted(set(ss) - set(dd))[:2], sorted(set(dd) - set(ss))[:2])
                res["cols"] = [s_cols[i] for i in order_s]
        except Exception as e:  # noqa: BLE001
            res = {"error": f"{type(e).__name__}: {str(e)[:400]}"}
        out[k] = res
        if verbose:
            ok = res.get("hash_match") and res.get("cols_match") and res.get("types_match") and res["rows"][0] == res["rows"][1]
            print(("OK  " if ok else "FAIL"), k, res, flush=True)
    return out


if __name__ == "__main__":
    from pickwise.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:] or None
    spark = local_session(8)
    r = compare(spark, sf, keys)
    bad = [k for k, v in r.items() if not (v.get("hash_match") and v.get("cols_match"))]
    print("FAILED:", bad)
