"""Run registered queries in Spark and their SQL twins in DuckDB; compare.

Comparison mirrors the driver: column names sorted, row count, column types
(integer width, float, string, bool, list) and an order-free multiset of
rows with floats rounded.

    python tests/oracle_harness.py [sf_dir] [key ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pyarrow as pa

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}")
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def _kind(t: pa.DataType) -> str:
    if pa.types.is_integer(t):
        return f"int{t.bit_width}"
    if pa.types.is_floating(t):
        return f"float{t.bit_width}"
    if pa.types.is_string(t) or pa.types.is_large_string(t) or pa.types.is_string_view(t):
        return "str"
    if pa.types.is_list(t) or pa.types.is_large_list(t) or pa.types.is_list_view(t):
        return f"list<{_kind(t.value_type)}>"
    return str(t)


def canon(table: pa.Table):
    cols = sorted(table.column_names)
    table = table.select(cols)
    kinds = [_kind(f.type) for f in table.schema]
    rows = [tuple(_norm(r[c]) for c in cols) for r in table.to_pylist()]
    rows.sort(key=repr)
    return cols, kinds, rows


def compare(spark, key: str, fn, sql: str, sf_dir: str, con=None) -> tuple[bool, str]:
    con = con or duck(sf_dir)
    t0 = time.time()
    s_tab = fn(spark, sf_dir).toArrow()
    t1 = time.time()
    d_tab = con.sql(sql).arrow()
    if hasattr(d_tab, "read_all"):
        d_tab = d_tab.read_all()
    sc, sk, sr = canon(s_tab)
    dc, dk, dr = canon(d_tab)
    msg = f"{key}: spark {len(sr)} rows {t1 - t0:.1f}s, duck {len(dr)} rows"
    if sc != dc:
        return False, msg + f" COLUMNS {sc} vs {dc}"
    if sk != dk:
        return False, msg + f" TYPES {list(zip(sc, sk, dk))}"
    if sr != dr:
        bad = next(((a, b) for a, b in zip(sr, dr) if a != b), None)
        return False, msg + f" VALUES differ; first: {str(bad)[:600]}"
    return True, msg


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    keys = [a for a in argv[1:] if not a.startswith("/")]
    import __spark_entry__ as E
    from corpusprep import get_spark

    spark = get_spark()
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for k in keys or list(qs):
        if k not in sqls:
            try:
                n = qs[k](spark, sf_dir).count()
                print(f"ROWS {k}: {n} rows (no SQL twin)", flush=True)
            except Exception as e:  # noqa: BLE001
                bad += 1
                print(f"FAIL {k}: {type(e).__name__}: {str(e)[:800]}", flush=True)
            continue
        try:
            ok, msg = compare(spark, k, qs[k], sqls[k], sf_dir, con)
        except Exception as e:  # noqa: BLE001
            ok, msg = False, f"{k}: {type(e).__name__}: {str(e)[:800]}"
        bad += not ok
        print(("OK   " if ok else "FAIL ") + msg, flush=True)
    print(f"{bad} failing")


if __name__ == "__main__":
    main(sys.argv)
