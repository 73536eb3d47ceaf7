"""Product codes through metric trees against plain k-means in Python integers."""

import hashlib

import duckdb
import numpy as np
import pytest

from kpistar.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<float>, label int, code string, of string, trees string"


def brute(rows, p):
    """(vec_id, code, error) and the codebooks, from the definition."""
    rows = sorted((r for r in rows if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])), key=lambda r: (r[0], r[1]))
    x = [[int(np.floor(np.float64(np.float32(c)) * p.scale)) for c in r[1]] for r in rows]
    d = len(x[0]) // p.parts
    cut = [[v[i * d:(i + 1) * d] for v in x] for i in range(p.parts)]
    books = [[list(v) for v in c[:p.entries]] for c in cut]

    def assign(i):
        dist = [[sum((a - b) ** 2 for a, b in zip(v, e)) for e in books[i]] for v in cut[i]]
        return [min(range(len(r)), key=lambda e: (r[e], e)) for r in dist], [min(r) for r in dist]

    for _ in range(p.rounds):
        for i in range(p.parts):
            code, _ = assign(i)
            for e in range(len(books[i])):
                own = [v for v, c in zip(cut[i], code) if c == e]
                if own:
                    books[i][e] = [sum(c) // len(own) for c in zip(*own)]
    found = [assign(i) for i in range(p.parts)]
    return [(r[0], bytes(found[i][0][k] for i in range(p.parts)).hex(), sum(found[i][1][k] for i in range(p.parts))) for k, r in enumerate(rows)], books


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)


def vectors(n, seed, spread=0.2):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, 32))
    return [(int(i), [float(np.float32(c)) for c in centres[i % 5] + spread * rng.normal(size=32)], int(i % 3)) for i in rng.permutation(n)]


@pytest.mark.parametrize("n,chunk,leaf", [(300, 64, 4), (300, 2048, 8), (40, 2048, 2)])
def test_equals_plain_kmeans(spark, n, chunk, leaf):
    rows = vectors(n, n + leaf)
    rows += [(1000 + i, rows[7][1], None) for i in range(200)]                    # copies, more than a leaf holds
    rows += [(2000, None, 1), (2001, [None] * 32, 1), (2002, [float("nan")] * 32, 1), (2003, [float("inf")] + [0.0] * 31, 1)]
    rows += [(2004, [0.0] * 32, 1), (2005, [0.5] * 16, 1)]
    p = vc.Params(chunk=chunk, leaf=leaf)
    want, books = brute([r for r in rows if r[1] is None or len(r[1]) == 32], p)
    coded, got = vc.compressed(table(spark, rows), p)
    assert got.tolist() == books
    out = vc.with_label_error(coded).collect()
    assert sorted((r["vec_id"], r["code"], r["error"]) for r in out) == sorted(want)
    label = {r[0]: r[2] for r in rows}
    sums = {}
    for i, _, e in want:
        sums[label[i]] = sums.get(label[i], 0) + e
    assert all(r["label_error"] == sums[label[r["vec_id"]]] for r in out)


def test_ties_go_to_the_lower_index(spark):
    rows = [(i, [float(v)] * 16, 0) for i, v in enumerate([0, 2, 1, 1, 1])]
    p = vc.Params(entries=2, rounds=0)
    coded, _ = vc.compressed(table(spark, rows), p)
    assert {r["vec_id"]: r["code"] for r in coded.collect()}[2] == "00" * 16


def test_repeated_ids_few_rows_and_empty_tables(spark):
    rows = [(5, [1.0] * 32, None), (5, [1.0] * 32, None), (5, [0.0] * 32, 2), (None, [0.25] * 32, 2)]
    coded, books = vc.compressed(table(spark, rows))
    assert books.shape == (16, 4, 2) and coded.count() == 4
    coded, books = vc.compressed(table(spark, [(1, None, 1)]))
    assert vc.with_label_error(coded).collect() == [] and books.size == 0


def test_too_large_and_uneven_vectors_raise(spark):
    with pytest.raises(ValueError):
        vc.compressed(table(spark, [(1, [0.0] * 20, 1)]))
    with pytest.raises(ValueError):
        vc.compressed(table(spark, [(1, [1e9] * 16, 1)]))


def test_balls_are_owned_without_their_points():
    """Far apart groups: each is settled as a ball, no point is compared."""
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.integers(0, 5, (200, 2)) + 10_000 * i for i in range(8)])
    t = vc.tree(x, 16)
    book = np.array([[10_000 * i, 10_000 * i] for i in range(8)])
    assert all(points is None for _, points, _ in vc.owned(t, book))
    total, count = vc.sums_of(t, book)
    assert count.tolist() == [200] * 8 and total.tolist() == [x[200 * i:200 * i + 200].sum(0).tolist() for i in range(8)]


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '/root/testdata/{sf}/embeddings.parquet'")
    got = vc.op12_vector_codes(spark, f"/root/testdata/{sf}")
    want = con.execute(f"select {', '.join(got.columns)} from ({vc.ORACLE_SQL})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_digest_is_of_the_codebooks(spark):
    row = vc.op12_vector_codes(spark, "/root/testdata/sf0.001").first()
    _, books = vc.compressed(spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet"))
    assert row["codebooks_sha256"] == hashlib.sha256(",".join(str(v) for part in books.tolist() for e in part for v in e).encode()).hexdigest()
