import json
import sys

sys.path.insert(0, "/root/repo")
from kpistar.session import build_session  # noqa: E402
from kpistar.sources.legacy import LegacyDomain  # noqa: E402
from kpistar.oracle import mapping  # noqa: E402
from kpistar.oracle.check import compare, duck_connect  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
spark = build_session("local[8]")
dom = LegacyDomain.from_sf(spark, sf)
con = duck_connect(sf)
w = mapping.with_clause(mapping.G1)
bad = 0
for t in LegacyDomain.TABLES:
    r = compare(dom.table(t), con, f"{w} SELECT * FROM g1_{t}")
    ok = r["hash_match"]
    bad += not ok
    print(t, "OK" if ok else json.dumps(r, default=str)[:1500])
print("bad", bad)
