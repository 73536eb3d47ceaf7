"""Run query keys in Spark and DuckDB at one scale factor and compare.

usage: python tools/try_keys.py [sf_dir] [key ...]
"""
import json
import sys
import time

sys.path.insert(0, "/root/repo")
from kpistar.session import build_session  # noqa: E402
from kpistar.registry import QUERIES  # noqa: E402
from kpistar.oracle.queries import ORACLE  # noqa: E402
from kpistar.oracle.check import compare, duck_connect  # noqa: E402

args = sys.argv[1:]
sf = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
keys = args or sorted(QUERIES)
spark = build_session("local[8]")
con = duck_connect(sf)
bad = []
for k in keys:
    t0 = time.time()
    try:
        df = QUERIES[k](spark, sf)
        if k not in ORACLE:
            n = df.count()
            print(f"{k:32s} rows={n} (no oracle) {time.time()-t0:.1f}s")
            continue
        r = compare(df, con, ORACLE[k])
    except Exception as e:  # noqa: BLE001
        print(f"{k:32s} ERROR {type(e).__name__}: {str(e)[:800]}")
        bad.append(k)
        continue
    ok = r["hash_match"] and r["spark_rows"] == r["oracle_rows"]
    if not ok:
        bad.append(k)
    print(f"{k:32s} {'OK ' if ok else 'BAD'} rows={r['spark_rows']}/{r['oracle_rows']} {time.time()-t0:.1f}s"
          + ("" if ok else "\n   " + json.dumps(r, default=str)[:3000]))
print("BAD:", bad)
