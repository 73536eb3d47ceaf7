"""Source divergence against its definition in Python integers and against SQL."""

import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from kpistar.llm import divergence as dv
from kpistar.llm import textkit

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def brute(rows, min_docs=3, top=200):
    docs = [(r[0] or "", r[1] or "", Counter(TERM.findall((r[2] or "").translate(UPPER)))) for r in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        df = Counter(t for d in mine for t in d[2])
        kept = sorted((t for t in df if df[t] >= min_docs), key=lambda t: t.encode())
        counts = {s: Counter() for s in {d[1] for d in mine}}
        for _, s, c in mine:
            counts[s].update({t: n for t, n in c.items() if df[t] >= min_docs})
        counts[None] = sum((counts[s] for s in list(counts)), Counter())
        p = {s: {t: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept)) for t in kept} for s, c in counts.items()}
        f = lambda a, b: (a - b) ** 2 // b
        for s in counts:
            if s is None:
                continue
            terms = sorted(((-f(p[s][t], p[None][t]), t.encode(), t) for t in kept if counts[s][t] and p[s][t] > p[None][t]))[:top]
            out += [(lang, s, "term", t, -v, i + 1) for i, (v, _, t) in enumerate(terms)]
            pairs = sorted((-sum(f(p[s][t], p[o][t]) for t in kept), o.encode(), o) for o in counts if o not in (None, s))
            out += [(lang, s, "pair", o, -v, i + 1) for i, (v, _, o) in enumerate(pairs)]
    return sorted(out)


def audit(spark, rows, p=dv.Params()):
    docs = spark.createDataFrame([(*r, i // 2, "x", 1) for i, r in enumerate(rows)], "lang string, source string, text string, doc_id long, item string, rank int")
    terms, pairs = dv.audited(docs, p)
    cols = ["lang", "source", "item", "value", "rank"]
    return sorted([(r[0], r[1], "term", *r[2:]) for r in terms.select(*cols).collect()] + [(r[0], r[1], "pair", *r[2:]) for r in pairs.select(*cols).collect()])


def corpus(seed, n=60):
    rng = np.random.default_rng(seed)
    words = ["alpha", "Beta", "gamma", "ÄRGER", "ärger", "日本語", "don't", "x1y", "e", "Zebra", "émile", "ЁЖ", "q", "longer-word", "a_b", "😀s"]
    return [(str(rng.choice(["en", "de"])), f"s{rng.integers(4)}", " ".join(rng.choice(words, rng.integers(0, 30)))) for _ in range(n)]


@pytest.mark.parametrize("bits", [64, 3, 1])
def test_equals_definition(spark, bits):
    rows = corpus(bits)
    rows += [(None, "s1", "alpha alpha"), ("en", None, None), ("", "", "Beta beta\0beta"), ("fr", "s9", "only once"), ("fr", "s8", ""), ("xx", "s1", None)]
    rows += [("en", "s2", "Alpha " * 3000 + "w" * 50_000), ("en", "hot", "alpha beta"), ("en", "hot", "alpha beta"), ("en", "hot", "alpha beta")]
    assert audit(spark, rows, dv.Params(digest_bits=bits)) == brute(rows)


def test_ties_at_the_limit_go_by_text(spark):
    words = [a + b for a in "abcdefgh" for b in "stuvwxyzäñ"]
    rows = [("en", "s1", " ".join(words))] * 3 + [("en", "s2", "other words here")] * 3
    got = audit(spark, rows, dv.Params(top=7))
    assert got == brute(rows, top=7)
    assert [r[3] for r in sorted((r for r in got if r[1] == "s1" and r[2] == "term"), key=lambda r: r[5])] == sorted(words, key=str.encode)[:7]


def test_empty_table_and_no_kept_terms(spark):
    assert audit(spark, []) == []
    assert audit(spark, [("en", "a", "x"), ("en", "b", "y")]) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


def test_terms_with_equal_digests_are_told_apart():
    raw = np.frombuffer(b"ab cd ab ef cd abc", np.uint8)
    start, end, _, h = textkit.words(raw, np.array([0, len(raw)]), dv.NOT_LETTER)
    first, number = dv.distinct_terms(raw, start, end, h & np.uint64(0))
    spelled = [raw[start[first[i]]:end[first[i]]].tobytes() for i in number]
    assert spelled == [b"ab", b"cd", b"ab", b"ef", b"cd", b"abc"] and len(first) == 4


def test_rows_of_the_scan_hold_one_term_each(spark):
    b = pa.RecordBatch.from_pydict({"l": [7, 7], "g": [1, 2], "text": ["x y x z", "x"]})
    rows = [r for out in dv._counted(dv.Params(digest_bits=1))(iter([b])) for r in out.to_pylist()]
    assert sorted((r["l"], r["g"], r["term"], r["n"], r["docs"]) for r in rows) == [(7, 1, "x", 2, 1), (7, 1, "y", 1, 1), (7, 1, "z", 1, 1), (7, 2, "x", 1, 1)]


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '/root/testdata/{sf}/documents.parquet'")
    got = dv.op13_source_divergence(spark, f"/root/testdata/{sf}")
    want = con.execute(f"select {', '.join(got.columns)} from ({dv.ORACLE_SQL})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)
