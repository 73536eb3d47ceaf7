"""MinHash and vector near-dedup against brute force, with edge rows and groups over many blocks."""

import random
import re

import numpy as np
import pytest

from kpistar.llm import minhash_dedup as mh
from kpistar.llm import vectors as vec
from kpistar.llm.shared import Scratch, components


def smallest_reachable(nodes, links):
    label = {n: n for n in nodes}
    while True:
        before = dict(label)
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
        if before == label:
            return label


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return frozenset()
    return frozenset([tuple(w)]) if len(w) < k else frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1))


def brute(rows, k=4, percent=80):
    sets = {d: shingles(t, k) for d, t in rows}
    ids = sorted(sets)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1:]
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    label = smallest_reachable(ids, links)
    return sorted((d, len(sets[d]), label[d], label[d] == d) for d in ids)


def corpus():
    rnd = random.Random(1)
    word = lambda: "".join(rnd.choice("abcdeé") for _ in range(rnd.randint(2, 6)))
    prose = lambda n: [word() for _ in range(n)]
    texts = []
    for _ in range(25):
        w = prose(rnd.randint(1, 80))
        texts.append(" ".join(w))
        for _ in range(rnd.randint(0, 3)):
            v = list(w)
            for _ in range(rnd.randint(0, 3)):
                v[rnd.randrange(len(v))] = word()
            texts.append("\n".join(v).upper() if rnd.random() < 0.2 else " ".join(v))
    base = prose(120)                       # one large group of near copies, some of them not linked with all others
    for _ in range(90):
        v = list(base)
        for _ in range(rnd.randint(0, 4)):
            v[rnd.randrange(len(v))] = word()
        texts.append("  ".join(v))
    boiler = prose(60)                      # much shared text, yet under the threshold
    texts += [" ".join(boiler + prose(30)) for _ in range(40)]
    texts += ["", "   \n\t", "one", "one", "one two three", "ONE two three", "x " * 5000, "  nbsp is a word", "a b c d", "a b c d e"]
    rnd.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("params", [mh.Params(), mh.Params(short_list=3, block_rows=16)], ids=["defaults", "small blocks"])
def test_minhash_equals_brute_force(spark, params):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sorted(map(tuple, mh.near_duplicates(df, params).collect()))
    assert got == brute(rows)


def copies_of(base, n, changed, rnd):
    """``n`` copies of ``base`` with the numbers of changed words, in turn, of ``changed``."""
    for i in range(n):
        v = list(base)
        for at in rnd.sample(range(len(v)), changed[i % len(changed)]):
            v[at] = f"x{rnd.random()}"
        yield " ".join(v)


@pytest.mark.parametrize("bases, apart", [(1, False), (2, True)])
def test_blocks_of_one_component_do_not_meet(spark, monkeypatch, bases, apart):
    rnd = random.Random(3)
    base = [f"w{i}" for i in range(150)]
    far = [f"y{w}" if i % 17 == 3 else w for i, w in enumerate(base)]       # shares long lists with base, but is no link
    texts = [*copies_of(base, 120, (0, 1, 2, 12), rnd), *(copies_of(far, 120, (0, 1, 2), rnd) if bases == 2 else ())]
    left = []
    led = mh._led
    monkeypatch.setattr(mh, "_led", lambda *a: left.append((out := led(*a))[1].count()) or out)
    rows = list(enumerate(texts, 1))
    got = mh.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), mh.Params(short_list=4, block_rows=8)).collect()
    assert sorted(map(tuple, got)) == brute(rows)
    assert (left[0] > 0) == apart


def test_minhash_edge_rows(spark):
    rows = [(1, None, "a"), (2, None, "b"), (3, "w x y z", "c"), (3, "w x y z", "d"), (None, "w x y z", "e"), (4, "W X y z", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, digest string")
    got = sorted(map(tuple, mh.near_duplicates(df).collect()), key=str)
    assert got == sorted([(1, 0, 1, True), (2, 0, 2, True), (3, 1, 3, True), (3, 1, 3, True), (None, 1, None, True), (4, 1, 3, False)], key=str)
    kept = mh.without_near_duplicates(df, mh.Params(k=5))
    assert kept.columns == df.columns
    assert sorted(x.doc_id or 0 for x in kept.collect()) == [0, 1, 2, 3]
    empty = df.where("doc_id > 99")
    assert mh.near_duplicates(empty).collect() == [] and mh.without_near_duplicates(empty).collect() == []


def test_block_intersections():
    rnd = np.random.default_rng(3)
    sets = [np.unique(rnd.integers(0, 9000, rnd.integers(0, 5000)).astype(np.uint64)) for _ in range(7)]
    got = mh.intersections(sets[:4], sets[3:])
    assert (got == [[len(np.intersect1d(a, b)) for b in sets[3:]] for a in sets[:4]]).all()


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(0, 40)]
    star = [(100, 100 + i) for i in range(1, 50)] + [(149, 160), (160, 155)]
    edges = spark.createDataFrame([(b, a) for a, b in path] + star + [(7, 7)], "u long, v long")
    got = {r.node: r.component for r in components(Scratch(spark, "t"), edges).collect()}
    assert got == smallest_reachable({x for e in path + star for x in e}, path + star)


def test_components_of_stars_need_no_round(spark):
    scratch = Scratch(spark, "t")
    edges = spark.createDataFrame([(1, 5), (6, 1), (2, 9), (9, 2)], "u long, v long")
    got = {r.node: r.component for r in components(scratch, edges).collect()}
    assert got == {1: 1, 5: 1, 6: 1, 2: 2, 9: 2}
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch.base)
    tables = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)
    assert [t.getPath().getName() for t in tables] == ["edges-0"]


def test_exchanges_of_the_minhash_tables(spark, monkeypatch):
    plans, put = {}, Scratch.put
    def recorded(self, df, name):
        plans[name] = df._jdf.queryExecution().sparkPlan().toString()
        return put(self, df, name)
    monkeypatch.setattr(Scratch, "put", recorded)
    words = [f"w{i}" for i in range(60)]
    df = spark.createDataFrame([(i, " ".join(words[:50 + i % 3])) for i in range(1, 40)], "doc_id long, text string")
    assert {r.component_id for r in mh.near_duplicates(df).collect()} == {1}
    assert plans["reps"].count("Join") == 0        # one grouping by digest gives the class and its signature
    assert "links" not in plans                    # links go straight to the edges of the components
    assert plans["edges-0"].count("FlatMapGroupsInPandas") == 1 and plans["edges-0"].count("Union") == 1


def vectors():
    rnd = np.random.default_rng(5)
    out = []
    for c in range(12):
        centre = rnd.normal(size=24)
        for _ in range(rnd.integers(1, 9)):
            out.append((centre + rnd.normal(size=24) * 0.25).tolist())
    centre = rnd.normal(size=24)
    out += [(centre * rnd.uniform(0.5, 4) + rnd.normal(size=24) * 0.2).tolist() for _ in range(150)]
    out += [rnd.normal(size=24).tolist() for _ in range(200)]
    out += [out[0]] * 5 + [out[70]] * 40
    out += [None, [], [0.0] * 24, [1.0, None] * 12, [float("nan")] * 24, [float("inf")] + [1.0] * 23, [1e-30] * 24, [1e30] * 24, [1.0] * 12, [1.0] * 11]
    return list(enumerate(out))


def brute_vectors(rows):
    ok = {}
    for i, v in rows:
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            w = np.zeros(24)
            w[:len(v)] = np.array(v) / np.abs(v).max()
            ok[i] = w / np.linalg.norm(w)
    links = [(a, b) for a in ok for b in ok if a < b and float(ok[a] @ ok[b]) >= 0.9]
    label = smallest_reachable([i for i, _ in rows], links)
    n = {i: sum(i in e for e in links) for i, _ in rows}
    return sorted((i, n[i], label[i], label[i] == i) for i, _ in rows)


@pytest.mark.parametrize("params", [vec.Params(), vec.Params(block_rows=16, stretch=8, fan_bits=1)], ids=["defaults", "small blocks"])
def test_vectors_equal_brute_force(spark, params):
    rows = vectors()
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, unit string").repartition(4)
    assert sorted(map(tuple, vec.near_duplicates(df, params).collect())) == brute_vectors(rows)


def test_distant_blocks_are_skipped(spark):
    """Clusters along few axes: most pairs of intervals are never joined."""
    rnd = np.random.default_rng(8)
    rows = [(i, (np.eye(8)[i % 8] * 10 + rnd.normal(size=8) * 0.1).tolist()) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    seen = {}
    keep = vec._interval_pairs
    try:
        vec._interval_pairs = lambda *a: seen.setdefault("pairs", keep(*a))
        got = vec.near_duplicates(df, vec.Params(block_rows=16)).collect()
    finally:
        vec._interval_pairs = keep
    blocks = {x for r in seen["pairs"].collect() for x in r}
    assert len(blocks) >= 16 and seen["pairs"].count() < len(blocks) * (len(blocks) + 1) / 4
    assert all(r.n_links == 49 and r.component_id == r.vec_id % 8 for r in got)


def test_blocks_are_not_moved_to_each_of_their_pairs(spark, monkeypatch):
    """Every pair of blocks meets, and what is written and shuffled stays near the size of the rows."""
    rnd = np.random.default_rng(9)
    x = rnd.normal(size=(640, 32)).astype(np.float32)
    x[600:] = x[:40] + rnd.normal(size=(40, 32)).astype(np.float32) * 0.01
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>").repartition(4)
    plans, put = [], Scratch.put
    monkeypatch.setattr(Scratch, "put", lambda self, d, name: plans.append((name, d._jdf.queryExecution().executedPlan().toString())) or put(self, d, name))
    got = {r.vec_id: (r.n_links, r.component_id) for r in vec.near_duplicates(df, vec.Params(block_rows=32)).collect()}
    assert got == {i: (int(i < 40 or i >= 600), i - 600 if i >= 600 else i) for i in range(640)}
    met = dict(plans)["met"]
    assert "CartesianProduct" in met and "Exchange hashpartitioning" not in met


def test_vector_edge_tables(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert vec.near_duplicates(empty).collect() == []
    rows = spark.createDataFrame([(None, [1.0, 0.0]), (1, None), (2, [1.0, 0.0])], "vec_id long, embedding array<float>")
    assert sorted(map(tuple, vec.near_duplicates(rows).collect()), key=str) == sorted([(None, 0, None, True), (1, 0, 1, True), (2, 0, 2, True)], key=str)


def test_rows_that_share_a_doc_id_are_told_apart_by_text(spark):
    rnd = random.Random(12)
    a, b, c, d = (" ".join(f"w{rnd.randrange(10**6)}" for _ in range(120)) for _ in range(4))
    near = b.rsplit(" ", 1)[0] + " changed"
    rows = [(1, a), (3, a), (3, b), (4, near), (3, b), (5, c), (5, d), (6, d), (7, c), (None, c), (8, None), (8, "")]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, text_hash string, row int").repartition(4)
    got = {(r.doc_id, r.component_id, r.n_shingles) for r in mh.near_duplicates(df).collect()}
    assert got == {(1, 1, 117), (3, 1, 117), (3, 3, 117), (4, 3, 117), (5, 5, 117), (6, 5, 117), (7, 5, 117), (None, None, 117), (8, 8, 0)}
    kept = mh.without_near_duplicates(df)
    assert kept.columns == df.columns
    assert sorted(map(str, kept.select("doc_id", "text").collect())) == sorted(str(r) for r in df.select("doc_id", "text").distinct().collect() if (r.doc_id, r.text) in [
        (1, a), (3, b), (5, c), (5, d), (None, c), (8, None), (8, "")])
