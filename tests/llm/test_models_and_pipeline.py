"""Quality classifier, language ID, the pipeline and the registered queries."""

import os
import random
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from kpistar.llm import language, quality
from kpistar.llm.registry import QUERIES
from kpistar.llm.shared import documents

SF = "/root/testdata/sf0.001"
MID = "/root/testdata/sf0.01"


def crc(i, n):
    return zlib.crc32(str(i).encode()) % n


def test_statistics_of_known_texts():
    x = quality.statistics(pa.array(["Ab c1, $$\nAb c1, $$", "", "  \n "], pa.string()).cast(pa.large_binary()))
    row = dict(zip(quality.STATISTICS, x[0]))
    assert row["log_words"] == pytest.approx(np.log(7)) and row["distinct"] == pytest.approx(0.5) and row["repeated_lines"] == pytest.approx(0.5)
    assert row["symbol_words"] == pytest.approx(1 / 3) and row["bare_symbols"] == pytest.approx(1 / 3) and row["ends_punctuated"] == pytest.approx(1 / 3)
    assert not x[1].any() and x[2][0] > 0 and np.isfinite(x).all()


def test_isotonic_pools_adjacent_violators():
    x, y = quality.isotonic(np.array([0.0, 1, 2, 3]), np.array([1.0, 0, 3, 1]), np.array([2.0, 2, 4, 2]))
    assert y.tolist() == pytest.approx([0.25, 4 / 6]) and (np.diff(x) > 0).all()


def test_random_features_approximate_a_gaussian_kernel():
    p = quality.Params(features=6000)
    m = quality.Model(p, np.zeros(5), np.ones(5))
    a = np.random.default_rng(0).normal(size=(6, 5))
    z = m.lift(a)[:, :-1]
    exact = np.exp(-((a[:, None] - a[None]) ** 2).sum(2) / (2 * p.width**2))
    assert np.abs(z @ z.T - exact).max() < 0.06


def test_quality_on_held_out_documents(spark):
    got = {r.doc_id: r for r in QUERIES["op6_quality"](spark, MID).collect()}
    con = duckdb.connect()
    assert len(got) == con.execute(f"select count(*) from '{MID}/documents.parquet'").fetchall()[0][0]
    assert all(r.held_out == (crc(i, 5) == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for i, r in got.items())
    labels = [(got[i], q) for i, q in con.execute(f"select doc_id, quality from '{MID}/labels.parquet'").fetchall() if i in got]
    held = [(r.predicted, q) for r, q in labels if r.held_out]
    assert len(held) > 40 and sum(a == b for a, b in held) >= 0.9 * len(held)
    assert sum(a == 0 for a, q in held if q == 1) <= 0.03 * len(held)


def test_held_out_labels_are_never_learned_from(spark):
    docs = documents(spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    turned = labels.selectExpr("doc_id", "if(crc32(cast(doc_id as string)) % 5 = 0, 1 - quality, quality) as quality", "1 as score")
    a, b = (sorted(map(tuple, quality.scores(docs, x).collect())) for x in (labels, turned))
    assert [x[:2] for x in a] == [x[:2] for x in b] and max(abs(x[2] - y[2]) for x, y in zip(a, b)) < 1e-5


def test_quality_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, "word " * 60000), (3, "word"), (None, "a null id")]
    docs = spark.createDataFrame([(i, t, 0.5) for i, t in rows], "doc_id long, text string, score double")
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = quality.scores(docs, none).collect()
    assert len(got) == 5 and all(r.score == 0.5 and r.predicted == 1 for r in got)
    assert quality.accepted(docs, none).columns == docs.columns and quality.accepted(docs, none).count() == 5
    some = spark.createDataFrame([(1, None), (2, 0), (2, 1), (3, 1), (None, 0), (77, 1)], "doc_id long, quality int")
    assert all(0 <= r.score <= 1 for r in quality.scores(docs, some).collect())
    assert quality.scores(docs.where("doc_id > 99"), some).collect() == []


def test_language_on_held_out_documents(spark):
    got = {r.doc_id: r for r in QUERIES["op9_language"](spark, MID).collect()}
    truth = duckdb.connect().execute(f"select doc_id, lang from '{MID}/documents.parquet' where lang is not null").fetchall()
    assert all(got[i].held_out == (crc(i, 4) == 2) for i, _ in truth)
    held = [(got[i].lang_pred, lang, got[i].rejected) for i, lang in truth if got[i].held_out]
    assert sum(a == b for a, b, _ in held) >= 0.97 * len(held)
    sure = [(a, b) for a, b, rejected in held if not rejected]
    assert len(sure) >= 0.9 * len(held) and sum(a == b for a, b in sure) >= 0.98 * len(sure)


def test_language_edge_rows(spark):
    rnd = random.Random(1)
    rows = [(i, " ".join(rnd.choice(["ka", "lo", "mi"] if i % 2 else ["zu", "xe", "vo"]) for _ in range(30)), "aa" if i % 2 else "bb") for i in range(80)]
    odd = [(100, None, "aa"), (101, "", "aa"), (102, "123 !? ٣", None), (103, "zu xe " * 50000, None), (104, "é", None), (None, "ka lo", "bb"), (105, "漢字", None), (1, "zu vo", None)]
    docs = spark.createDataFrame([(*r, 1.0) for r in rows + odd], "doc_id long, text string, lang string, score double")
    model = language.fit(docs)
    got = language.predicted(docs, model).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(rows) + len(odd) and model.languages == ["aa", "bb"]
    assert all(by[i].lang_pred == "und" and by[i].score == 0 and by[i].rejected for i in (100, 101, 102))
    assert by[103].lang_pred == "bb" and by[105].lang_pred in ("aa", "bb") and all(0 <= r.score <= 1 for r in got)
    assert all(by[i].lang_pred == lang for i, _, lang in rows if i != 1)
    nothing = language.fit(docs.where("lang is null"))
    assert {r.lang_pred for r in language.predicted(docs, nothing).collect()} == {"und"}
    assert language.predicted(docs.where("doc_id > 999"), model).collect() == []


def test_held_out_languages_are_never_learned_from(spark):
    docs = documents(spark, SF)
    turned = docs.selectExpr("doc_id", "text", "if(crc32(cast(doc_id as string)) % 4 = 2, 'xx', lang) as lang")
    a, b = language.fit(docs), language.fit(turned)
    assert a.languages == b.languages and np.allclose(a.logits, b.logits)


def test_pipeline_stages(spark):
    docs = documents(spark, SF)
    rows = docs.collect()
    odd = spark.createDataFrame([(None, None, None, None, None), (9001, "", "en", "s", 0), (9002, None, None, None, None), (9003, "x " * 40000, "en", "s", 80000),
                                 (rows[0].doc_id, rows[0].text, rows[0].lang, rows[0].source, rows[0].n_chars)], docs.schema)
    kept = docs.unionByName(odd).cache()
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, kept, SF)
        assert out.schema.names == docs.schema.names
        before, after = kept.count(), out.count()
        assert after == before if name == "secrets" else 0 < after <= before
        kept = out
    last = corpus_pipeline.STAGES[-1][1](spark, kept, SF)
    assert last.count() == kept.count() and all(r.n_tokens == len(r.ids) for r in last.collect())
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.where("doc_id < 0"), SF).collect() == []


def test_pipeline_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "n_tokens", "ids"]
    first = {r.doc_id for r in out.collect()}
    found = {r.doc_id for r in QUERIES["op3_decontaminate"](spark, SF).collect()}
    assert first and not first & found


def test_every_operator_has_its_query():
    assert [sum(q.startswith(f"op{n}_") for q in QUERIES) for n in range(1, 11)] == [1] * 10


def test_nothing_else_imports_the_subpackage():
    package = os.path.dirname(os.path.dirname(os.path.abspath(quality.__file__)))
    for folder, _, names in os.walk(package):
        if os.path.basename(folder) != "llm":
            for name in names:
                if name.endswith(".py"):
                    with open(os.path.join(folder, name)) as f:
                        assert "kpistar.llm" not in f.read(), name
