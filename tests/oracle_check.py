"""Run every registered query in Spark and its SQL in DuckDB, and compare.

    python tests/oracle_check.py [sf_dir] [name ...]

Compares column names, row counts and rows (order-insensitive, floats to
9 significant digits). Prints one line per query and a JSON summary.
"""

from __future__ import annotations

import json
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v, sig=None):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(f"{v:.{sig}g}") if sig else v
    if hasattr(v, "isoformat"):
        return str(v)[:10] if type(v).__name__ == "date" else str(v)
    return v


def key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


def main() -> int:
    import duckdb

    from __spark_entry__ import oracle_sql, queries
    from demand_engine.session import get_spark

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    if os.environ.get("PLAIN_SESSION"):  # as a caller with no engine settings would
        from pyspark.sql import SparkSession

        spark = SparkSession.builder.master("local[8]").getOrCreate()
        import __spark_entry__

        print("entry rows:", len(__spark_entry__.entry(spark).collect()))
    else:
        spark = get_spark("local[8]", shuffle_partitions=8)
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    qs, sq = queries(), oracle_sql()
    summary = {}
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t0 = time.time()
        try:
            sdf = fn(spark, sf_dir)
            cols = sdf.columns
            rows = [tuple(norm(v) for v in r) for r in sdf.collect()]
        except Exception as exc:  # noqa: BLE001
            summary[name] = {"status": "spark_error", "error": str(exc)[:300]}
            print(f"{name:28s} SPARK ERROR {str(exc)[:300]}")
            continue
        st = time.time() - t0
        if name not in sq:
            summary[name] = {"status": "rows_only", "rows": len(rows), "sec": round(st, 2)}
            print(f"{name:28s} rows-only  rows={len(rows)}  {st:.2f}s")
            continue
        try:
            res = con.execute(sq[name])
            dcols = [d[0] for d in res.description]
            drows = [tuple(norm(v) for v in r) for r in res.fetchall()]
        except Exception as exc:  # noqa: BLE001
            summary[name] = {"status": "sql_error", "error": str(exc)[:300]}
            print(f"{name:28s} SQL ERROR {str(exc)[:300]}")
            continue
        ok_cols = sorted(cols) == sorted(dcols)
        status = "match"
        detail = ""
        if not ok_cols:
            status, detail = "column_mismatch", f"spark={cols} sql={dcols}"
        elif len(rows) != len(drows):
            status, detail = "rowcount_mismatch", f"spark={len(rows)} sql={len(drows)}"
        else:
            order = [dcols.index(c) for c in cols]
            drows2 = [tuple(r[i] for i in order) for r in drows]
            a, b = sorted(rows, key=key), sorted(drows2, key=key)
            bad = [(x, y) for x, y in zip(a, b) if x != y]
            if bad:
                approx = lambda rs: sorted([tuple(norm(v, 9) for v in r) for r in rs], key=key)
                near = approx(rows) == approx(drows2)
                status = "approx_match" if near else "value_mismatch"
                detail = f"{len(bad)} rows differ, e.g. spark={bad[0][0]} sql={bad[0][1]}"
        summary[name] = {"status": status, "rows": len(rows), "sec": round(st, 2), "detail": detail}
        print(f"{name:28s} {status:18s} rows={len(rows)}  {st:.2f}s  {detail[:400]}")
    counts = {}
    for v in summary.values():
        counts[v["status"]] = counts.get(v["status"], 0) + 1
    print(json.dumps(counts))
    return 0 if all(v["status"] in ("match", "rows_only") for v in summary.values()) else 1


if __name__ == "__main__":
    sys.exit(main())
