"""Print the formatted physical plan of one query key .

usage: python tools/explain.py <key> [sf_dir] [--executed]

With --executed the query is run first (noop write) and the final adaptive plan is printed.
"""
import sys

sys.path.insert(0, "/root/repo")
from kpistar.session import build_session  # noqa: E402
from kpistar.registry import QUERIES  # noqa: E402

args = [a for a in sys.argv[1:] if not a.startswith("--")]
key = args[0]
sf = args[1] if len(args) > 1 else "/root/testdata/sf0.01"
spark = build_session("local[8]")
df = QUERIES[key](spark, sf)
if "--executed" in sys.argv:
    df.write.format("noop").mode("overwrite").save()
df.explain("formatted")
