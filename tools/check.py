"""Compare every named query with its SQL on the same tables: ``python tools/check.py [sf_dir] [key ...]``."""

from __future__ import annotations

import math
import os
import sys
import time
import traceback

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from millrace.plans.catalog import all_queries  # noqa: E402
from millrace.session import TABLES, build_session  # noqa: E402

TYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "FLOAT": "float", "VARCHAR": "string", "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz"}


def canonical(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def cell(v):
        if isinstance(v, float):
            return "NaN" if math.isnan(v) else repr(v + 0.0)
        return repr(v)

    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def main() -> int:
    args = sys.argv[1:]
    sf = args.pop(0) if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    spark = build_session("check", "local[8]", shuffle_partitions=8, spark__ui__enabled="false", spark__ui__showConsoleProgress="false", spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    bad = 0
    for key, q in all_queries().items():
        if args and not any(key == a or (a.endswith("*") and key.startswith(a[:-1])) for a in args):
            continue
        start = time.time()
        try:
            df = q(spark, sf)
            rows = [tuple(r) for r in df.collect()]
            took = time.time() - start
            if q.oracle is None:
                print(f"rows {key} {len(rows)} {took:.1f}s", flush=True)
                continue
            cur = con.execute(q.oracle)
            names, types = [d[0] for d in cur.description], [str(d[1]) for d in cur.description]
            expect = cur.fetchall()
            mine = {f.name: f.dataType.simpleString() for f in df.schema.fields}
            notes = []
            if sorted(mine) != sorted(names):
                notes.append(f"columns {sorted(mine)} vs {sorted(names)}")
            else:
                notes += [f"type {n}: {mine[n]} vs {t}" for n, t in zip(names, types) if TYPES.get(t) != mine[n]]
                a, b = canonical(rows, df.columns), canonical(expect, names)
                if len(a) != len(b):
                    notes.append(f"rows {len(a)} vs {len(b)}")
                if a != b:
                    only_a, only_b = sorted(set(a) - set(b))[:3], sorted(set(b) - set(a))[:3]
                    notes.append(f"values\n   spark {only_a}\n   duck  {only_b}")
            bad += bool(notes)
            print(("FAIL " if notes else "ok   ") + f"{key} {len(rows)} {took:.1f}s " + "; ".join(notes), flush=True)
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"ERR  {key}: {type(e).__name__} {str(e)[:700]}", flush=True)
            if os.environ.get("TRACE"):
                traceback.print_exc()
    print("problems:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
