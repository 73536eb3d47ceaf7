"""Packing: every id once, in place; the curve; documents of a sequence are neighbours."""

import zlib
from collections import Counter, defaultdict
from itertools import product

import duckdb
import numpy as np
import pytest
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from kpistar.llm import packing as pk

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids_of(text):
    return np.array([*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 0], "<u4")


def check(rows, texts, length=1024):
    """``texts``: (doc_id, text) of every row; ``rows``: the query's rows."""
    want = Counter((d, len(x), zlib.crc32(x.tobytes())) for d, t in texts for x in [ids_of(t)])
    ids = {(d, n, c): x for d, t in texts for x in [ids_of(t)] for n, c in [(len(x), zlib.crc32(x.tobytes()))]}
    # pieces tile documents: with repeated documents, every (start, length) boundary is covered as often as there are copies
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[(r["doc_id"], r["doc_tokens"])].append(r)
    for (d, n), mine in by_doc.items():
        copies = [k for k in want.elements() if k[:2] == (d, n)]
        covered = np.zeros(n, np.int64)
        for r in mine:
            covered[r["start"]:r["start"] + r["length"]] += 1
            cut = [zlib.crc32(ids[k][r["start"]:r["start"] + r["length"]].tobytes()) for k in set(copies)]
            assert r["ids_crc32"] in cut
        assert (covered == len(copies)).all()
    assert {k[:2] for k in want} == set(by_doc)
    by_seq = defaultdict(list)
    for r in rows:
        by_seq[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in by_seq.values():
        at = 0
        for offset, n in sorted(spans):
            assert offset == at
            at += n
        assert at <= length and (at == length or at & (at - 1) == 0)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_holds_every_id_once(spark, sf):
    rows = pk.op11_packing(spark, f"/root/testdata/{sf}").collect()
    check(rows, duckdb.sql(f"select doc_id, text from '/root/testdata/{sf}/documents.parquet'").fetchall())


def test_edges(spark):
    rng = np.random.default_rng(0)
    texts = [(1, None), (2, ""), (3, "<|endoftext|> inside"), (4, "العربية 😀 हिन्दी"), (4, "another text of the same id"), (None, "no id"),
             (5, " ".join(map(str, rng.integers(0, 10**6, 40_000)))), (6, "x" * 100_000), (7, " " * 5000)]
    texts += [(8, "the same row")] * 300
    docs = spark.createDataFrame([(*t, 1, "a", "b") for t in texts], "doc_id long, text string, start long, ids string, key string")
    pieces = pk.packed(docs)
    got = pieces.selectExpr("doc_id", "start", "length", "crc32(ids) ids_crc32", "doc_tokens", "sequence_id", "offset").collect()
    check(got, texts)
    assert pk.packed(docs.limit(0)).collect() == []


def test_sequences_are_the_pieces_in_order_with_padding(spark):
    docs = spark.createDataFrame([(i, "some words " * (7 * i)) for i in range(60)], "doc_id long, text string")
    p = pk.Params(length=100)
    pieces = pk.packed(docs, p)
    want = defaultdict(bytes)
    for r in sorted(pieces.collect(), key=lambda r: (r["sequence_id"], r["offset"])):
        want[r["sequence_id"]] += bytes(r["ids"])
    got = {r["sequence_id"]: bytes(r["ids"]) for r in pk.sequences(pieces, p, pad_id=9).collect()}
    for s, ids in got.items():
        n = len(want[s]) // 4
        assert ids == want[s] + (9).to_bytes(4, "little") * (0 if n & (n - 1) == 0 else 100 - n)
    odd = spark.createDataFrame([(1, 0, b"\1\0\0\0" * 3)], "sequence_id long, offset long, ids binary")
    assert len(pk.sequences(odd, p).first()["ids"]) == 400


@pytest.mark.parametrize("axes,bits", [(2, 4), (3, 3), (5, 2)])
def test_hilbert_curve_visits_every_cell_by_steps_of_one(axes, bits):
    cells = np.array(list(product(range(1 << bits), repeat=axes)))
    key = pk.hilbert(cells, bits)
    assert sorted(key) == list(range(len(cells)))
    walk = cells[np.argsort(key)]
    assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def test_sequences_hold_neighbours(spark):
    """Documents that share a sequence are of one language far more often than by chance."""
    d = "/root/testdata/sf0.01"
    lang = dict(duckdb.sql(f"select doc_id, coalesce(lang, '') from '{d}/documents.parquet'").fetchall())
    share = sum((n / len(lang)) ** 2 for n in Counter(lang.values()).values())
    seqs = defaultdict(list)
    for r in pk.op11_packing(spark, d).collect():
        seqs[r["sequence_id"]].append(r["doc_id"])
    same = [lang[a] == lang[b] for s in seqs.values() for a, b in zip(s, s[1:])]
    assert np.mean(same) > share + 0.15


IDS = pk.Ids(open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read(), open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb").read())


@settings(max_examples=300, deadline=None)
@given(st.text())
def test_ids_equal_the_library(text):
    assert IDS(text).tolist() == TOKENIZER.encode(text, add_special_tokens=False).ids


def test_other_ranks_are_refused():
    spec = open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read()
    with pytest.raises(ValueError):
        pk.Ids(spec, open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb").read())
