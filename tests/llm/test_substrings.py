"""Substring dedup: the Cartesian tree against its definition, planted passages, edge rows."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kpistar.llm import substrings


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 12), max_size=25), min_size=1, max_size=4), st.integers(1, 6))
def test_compact_windows_by_definition(texts, width):
    flat = np.array([x for t in texts for x in t], np.uint64) << np.uint64(40)
    bounds = np.cumsum([0, *map(len, texts)])
    got = set(zip(*(x.tolist() for x in substrings.compact_windows(flat, bounds, width))))
    want = set()
    for t, lo in zip(texts, bounds.tolist()):
        for c in range(len(t)):
            left = max((j + 1 for j in range(c) if t[j] <= t[c]), default=0)
            end = min((j for j in range(c + 1, len(t)) if t[j] < t[c]), default=len(t))
            if end - left >= width:
                want.add((lo + left, lo + c, lo + end))
    assert got == want


def prose(rnd, n):
    return ["".join(rnd.choice("aeioulmnrst") for _ in range(rnd.randint(2, 8))) for _ in range(n)]


def planted(seed=1):
    """Texts, and the documents that hold one of the passages (some with a changed word every 60 words)."""
    rnd = random.Random(seed)
    texts, holds = [], {}
    for i in range(12):
        passage = prose(rnd, rnd.choice([50, 55, 70, 120, 400]))
        for copy in range(rnd.randint(2, 6)):
            p = list(passage)
            if i % 3 == 2 and copy:
                for at in range(30, len(p) - 20, 60):
                    p[at] = prose(rnd, 1)[0] + "x"
            if copy % 2:
                p = [w.upper() for w in p]
            holds[len(texts)] = (i, len(p))
            texts.append(" ".join(prose(rnd, rnd.randint(0, 300)) + p + prose(rnd, rnd.randint(0, 300))))
    line = " ".join(prose(rnd, 30))                       # common, yet too short for a passage
    texts += [" ".join(prose(rnd, 100)) + "\n" + line + "\n" + " ".join(prose(rnd, 100)) for _ in range(40)]
    period = " ".join(prose(rnd, 31))
    holds[len(texts)] = holds[len(texts) + 1] = (99, 93)
    texts += [" ".join([period] * 3), " ".join([period] * 3) + " end"]
    texts += ["", "   ", "one", " ".join(["same"] * 4000), " ".join(["same"] * 4000), " ".join(prose(rnd, 49))]
    return texts, holds


def test_planted_passages_are_found_and_clean_texts_left_alone(spark):
    texts, holds = planted()
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, sig int").repartition(3)
    got = {r.doc_id: r for r in substrings.repeated(df).collect()}
    assert set(got) == set(holds)
    for i in {x for x, _ in holds.values()}:
        group = [d for d, x in holds.items() if x[0] == i]
        assert len({got[d].component_id for d in group}) == 1 and got[group[0]].component_id == min(group)
    for d, (i, n) in holds.items():
        ranges = [tuple(map(int, x.split(":"))) for x in got[d].passages.split(",")]
        assert got[d].n_words == sum(e - s for s, e in ranges)
        if i % 3 != 2:
            words, length = texts[d].split(), n
            assert all(e <= len(words) for _, e in ranges) and n <= max(e - s for s, e in ranges) <= length + 2


def test_a_very_common_passage_stays_linear(spark):
    rnd = random.Random(2)
    passage = " ".join(prose(rnd, 80))
    texts = [" ".join(prose(rnd, rnd.randint(0, 20))) + " " + passage + " " + " ".join(prose(rnd, rnd.randint(0, 20))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    found = substrings.shared_passages(df).collect()
    assert {r.b for r in found} == {0} and len({r.a for r in found}) == 299 and len(found) < 2 * 299


def test_edge_rows(spark):
    rnd = random.Random(3)
    p, long = " ".join(prose(rnd, 60)), " ".join(prose(rnd, 40000))
    rows = [(None, p), (None, p), (1, None), (2, ""), (3, p), (3, p), (4, long), (5, long + " z"), (6, p + " " + p)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.component_id, r.n_words, r.passages) for r in substrings.repeated(df).collect()}
    assert got == {3: (3, 60, "0:60"), 6: (3, 120, "0:60,60:120") if got[6][2] != "0:120" else (3, 120, "0:120"), 4: (4, 40000, "0:40000"), 5: (4, 40000, "0:40000")}
    assert substrings.repeated(df.where("doc_id = 3")).collect() == []          # one document repeats within itself only
    assert substrings.repeated(df.where("doc_id > 99")).collect() == []


@pytest.mark.parametrize("offset", [0, 7, -5])
def test_diagonals(offset):
    a = np.arange(100, 130, dtype=np.uint64)
    b = np.concatenate([np.full(max(0, -offset), 1, np.uint64), a[max(0, offset):]])
    match, place = substrings.diagonal(a, b, offset)
    assert (a[match] == b[place]).all() and len(match) == 30 - max(0, offset)


@pytest.mark.parametrize("seed", range(3))
def test_a_cut_off_copy_in_the_smallest_document_hides_no_passage(spark, seed):
    rnd = random.Random(seed)
    rows, holds = [], []
    for n in range(0, 400, 4):                             # the cut-off copies, then two or three whole ones
        p = prose(rnd, 52 if n % 8 else 60)
        copies = [p[:48], p, p] if n % 8 else [p[:48], p[-48:], p, p]
        holds.append(tuple(n + i for i, c in enumerate(copies) if c == p))
        rows += [(n + i, " ".join(prose(rnd, 100) + c + prose(rnd, 100))) for i, c in enumerate(copies)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in substrings.repeated(df).collect()}
    assert got == {d: min(pair) for pair in holds for d in pair}


def test_rounds_end_in_every_pair_that_is_left(spark):
    rnd = random.Random(5)
    line, whole = prose(rnd, 40), prose(rnd, 20)
    rows = [(n, " ".join(prose(rnd, 80) + line + prose(rnd, 80))) for n in range(30)]
    rows += [(n, " ".join(prose(rnd, 80) + line + whole + prose(rnd, 80))) for n in (30, 31)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for rounds in (0, 3):
        got = {r.doc_id: r.component_id for r in substrings.repeated(df, substrings.Params(rounds=rounds)).collect()}
        assert got == {30: 30, 31: 30}


def test_passages_of_two_families_are_compared(spark):
    """Two documents share 60 words, and each lies with them in a passage of a smaller document of its own."""
    rnd, rows = random.Random(11), []
    for n in range(0, 160, 4):
        p, q, s = prose(rnd, 30), prose(rnd, 30), prose(rnd, 60)
        rows += [(n + i, " ".join(prose(rnd, 40) + x + prose(rnd, 40))) for i, x in enumerate((p + s[:48], q + s[:48], p + s, q + s))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in substrings.repeated(df).collect()}
    assert got == {d: d - d % 4 for d, _ in rows}


@pytest.mark.parametrize("length, at", [(150, 120), (100, 60), (90, 55)])
def test_a_passage_with_an_inserted_word_is_found_in_full(spark, length, at):
    rnd = random.Random(length)
    rows = []
    for n in range(0, 40, 2):
        p = prose(rnd, length)
        rows += [(n + i, " ".join(prose(rnd, 100) + q + prose(rnd, 100))) for i, q in enumerate((p, p[:at] + ["inserted"] + p[at:]))]
    got = {r.doc_id: r.passages for r in substrings.repeated(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {n: f"100:{100 + length + n % 2}" for n in range(40)}


def test_the_smallest_document_reports_all_its_copies(spark):
    rnd = random.Random(7)
    p, q = prose(rnd, 60), prose(rnd, 80)
    edited = q[:40] + ["inserted"] + q[40:]
    sep = [prose(rnd, 70) for _ in range(4)]
    first = p + sep[0] + p + sep[1] + p[:30] + sep[2] + p                # the third copy is cut off
    rows = [(1, " ".join(first)), (2, " ".join(prose(rnd, 90) + p + prose(rnd, 90))), (3, " ".join(p)),
            (4, " ".join(q + sep[3] + edited)), (5, " ".join(prose(rnd, 90) + q + prose(rnd, 90)))]
    got = {r.doc_id: (r.component_id, r.passages) for r in substrings.repeated(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (1, "0:60,130:190,360:420"), 2: (1, "90:150"), 3: (1, "0:60"), 4: (4, "0:80,150:231"), 5: (4, "90:170")}


def test_steps_run_in_small_tasks_and_leave_the_session_as_it_was(spark, monkeypatch):
    """Every written step of the passages has small batches and small tasks; other queries keep their settings."""
    seen = []
    put = substrings.Scratch.put

    def spy(self, df, name):
        if "/substrings-" in self.base:
            seen.append((name, *[spark.conf.get(k) for k in substrings.SMALL]))
        return put(self, df, name)

    monkeypatch.setattr(substrings.Scratch, "put", spy)
    before = {k: spark.conf.get(k, None) for k in substrings.SMALL}
    same = " ".join(f"w{i}" for i in range(90))
    docs = spark.createDataFrame([(1, same), (2, f"x y z {same}"), (3, "short")], "doc_id long, text string")
    assert sorted((r.a, r.b) for r in substrings.shared_passages(docs).collect()) == [(2, 1)]
    assert len(seen) > 3 and {x[1:] for x in seen} == {tuple(substrings.SMALL.values())}
    assert {k: spark.conf.get(k, None) for k in substrings.SMALL} == before


def test_hopeful_windows_match_a_plain_count(spark):
    """Places as bits give the windows that sorted lists of places gave, and no table of objects is built."""
    from kpistar.llm.shared import Scratch, ship
    rng, p = random.Random(5), substrings.Params()
    line = [f"c{i}" for i in range(160)]
    texts = []
    for n in range(40):
        keep = rng.randrange(8, 160)
        body = [w if abs(i - 80) * 2 < keep and (n % 3 or rng.random() < 0.97) else f"r{n}-{i}" for i, w in enumerate(line)]
        texts.append(" ".join(body[rng.randrange(0, 30):rng.randrange(100, 160)]))
    ship(spark)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    words = [t.split() for t in texts]
    members = [(7, n, w.index("c80") << 30, n % 4 > 0) for n, w in enumerate(words) if "c80" in w and w.index("c80") + p.k <= len(w)]
    got = substrings._hopeful(Scratch(spark, "hopeful"), docs, spark.createDataFrame(members, "sig long, doc_id long, at long, open boolean"), "t", p)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "collect_set" not in plan
    near = {n: {tuple(words[n][i:i + p.k]): i - (at >> 30) for i in range(len(words[n]) - p.k + 1)} for _, n, at, _ in members}
    reach, want = p.width + 3 * p.gap, set()
    near = {n: {s: i for s, i in x.items() if abs(i) <= reach} for n, x in near.items()}
    for _, n, _, is_open in members:
        at = sorted(i for s, i in near[n].items() if abs(i) <= p.width + p.gap and any(s in y for m, y in near.items() if m != n))
        e = s = 0
        for x in at:
            e = x if x > e and x - e <= p.gap else e
        for x in reversed(at):
            s = x if x < s and s - x <= p.gap else s
        if is_open and at and e - s + 1 >= p.width:
            want.add(n)
    assert {r.doc_id for r in got.collect()} == want and 0 < len(want) < sum(m[3] for m in members)
