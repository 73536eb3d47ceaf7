"""Language identification: averaged hashed subword embeddings and a linear softmax, by SGD in numpy.

Subwords are the byte 2- and 3-grams of the text, lower-cased, with every ASCII byte
that is no letter read as a space; each is hashed to one of ``buckets`` embeddings.  A
text's vector is the mean of its subwords' embeddings, its logits are linear in that.  The
model is fitted on at most about ``rows_per_language`` documents of each language, chosen
by hash: executors send their hashed subword counts, the driver runs SGD.  Every fifth of
them is kept out of SGD and sets the softmax temperature and the confidence below which
a prediction is marked ``rejected`` (the least that leaves ``precision`` correct).
Embeddings and softmax are folded into one table of logits per bucket for prediction.

Learning uses only text and non-null lang of documents whose crc32(doc_id as text) mod 4
is not 2; lang, source and doc_id are never inputs of a prediction.  Edge cases: a null
text, or one without any letter, is ``und`` with score 0; so is every text if nothing could
be learned; ties go to the first language in order of name; a null doc_id is not learned
from and not held out.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpistar.llm import textkit
from kpistar.llm.shared import documents, ship


@dataclass(frozen=True)
class Params:
    bits: int = 15                # 2 ** bits buckets
    size: int = 16                # of an embedding
    rows_per_language: int = 600
    epochs: int = 12
    rate: float = 0.5
    precision: float = 0.99
    folds: int = 4
    held_fold: int = 2
    seed: int = 3


_FOLDED = np.full(256, 32, np.uint8)
_FOLDED[97:123] = _FOLDED[65:91] = np.arange(97, 123)
_FOLDED[128:] = np.arange(128, 256)


def subwords(buf: np.ndarray, offs: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, bucket) of every 2- and 3-gram of a slice, by document."""
    x = _FOLDED[buf].astype(np.uint32)
    owner = np.repeat(np.arange(len(offs) - 1, dtype=np.int32), np.diff(offs))
    docs, codes = [owner[:0]], [x[:0]]
    for n in (2, 3):
        if len(x) < n:
            continue
        code = x[:len(x) - n + 1].copy()
        for j in range(1, n):
            code = (code << np.uint32(8)) | x[j:len(x) - n + 1 + j]
        code = ((code + np.uint32(n << 24)) * np.uint32(2654435761)) >> np.uint32(32 - bits)
        whole = owner[:len(code)] == owner[n - 1:]
        docs.append(owner[:len(code)][whole])
        codes.append(code[whole])
    return np.concatenate(docs), np.concatenate(codes)


def _bags(p: Params):
    """(lang, buckets, counts) of each document."""
    def run(batches):
        for b in batches:
            texts = textkit.column(b, "text")
            keys, weights = [], []
            for lo, hi, buf, offs in textkit.pieces(texts):
                doc, code = subwords(buf, offs, p.bits)
                both, n = np.unique(doc.astype(np.int64) << 32 | code, return_counts=True)
                cuts = np.searchsorted(both >> 32, np.arange(hi - lo + 1))
                for i in range(hi - lo):
                    keys.append((both[cuts[i]:cuts[i + 1]] & 0xFFFFFFFF).astype(np.int32))
                    weights.append(n[cuts[i]:cuts[i + 1]].astype(np.float32))
            yield pa.RecordBatch.from_arrays(
                [b.column(b.schema.get_field_index("lang")), pa.array(keys, pa.list_(pa.int32())), pa.array(weights, pa.list_(pa.float32()))],
                names=["lang", "buckets", "counts"])
    return run


@dataclass
class Model:
    languages: list[str]
    logits: np.ndarray            # bucket x language
    bias: np.ndarray
    temperature: float
    accept: float                 # least confidence of a prediction that is not rejected

    def probabilities(self, mean_logits: np.ndarray) -> np.ndarray:
        z = (mean_logits + self.bias) / self.temperature
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)


def train(rows: list[tuple[str, np.ndarray, np.ndarray]], p: Params) -> Model:
    """SGD on (language, buckets, counts) rows."""
    rows = [r for r in rows if len(r[1])]
    languages = sorted({r[0] for r in rows})
    if not languages:
        return Model([], np.zeros((1 << p.bits, 0), np.float32), np.zeros(0), 1.0, 1.0)
    rng = np.random.default_rng(p.seed)
    rows = sorted(rows, key=lambda r: (r[0], len(r[1]), r[1].tobytes(), r[2].tobytes()))
    y = np.array([languages.index(r[0]) for r in rows])
    emb = rng.normal(0, 0.1, (1 << p.bits, p.size))
    out, bias = np.zeros((p.size, len(languages))), np.zeros(len(languages))
    fit, kept = [i for i in range(len(rows)) if i % 5], [i for i in range(len(rows)) if not i % 5]
    share = [r[2] / r[2].sum() for r in rows]
    for epoch in range(p.epochs):
        rate = p.rate * (1 - epoch / p.epochs)
        for i in rng.permutation(fit):
            at, w = rows[i][1], share[i]
            h = w @ emb[at]
            z = h @ out + bias
            g = np.exp(z - z.max())
            g /= g.sum()
            g[y[i]] -= 1
            back = out @ g
            out -= rate * np.outer(h, g)
            bias -= rate * g
            emb[at] -= np.outer(w * (rate * len(at) ** 0.5), back)
    logits = (emb @ out).astype(np.float32)
    model = Model(languages, logits, bias, 1.0, 0.0)
    mean = np.array([share[i] @ logits[rows[i][1]] for i in kept])
    truth = y[kept]

    def loss(t):
        model.temperature = t
        return -np.log(model.probabilities(mean)[np.arange(len(kept)), truth] + 1e-12).mean()

    model.temperature = min((2.0 ** e for e in range(-3, 5)), key=loss)
    found = model.probabilities(mean)
    sure, right = found.max(1), found.argmax(1) == truth
    order = np.argsort(-sure, kind="stable")
    good = np.cumsum(right[order]) / np.arange(1, len(order) + 1) >= p.precision
    model.accept = float(sure[order][np.flatnonzero(good)[-1]]) if good.any() else 1.0
    return model


def fit(docs: DataFrame, p: Params = Params()) -> Model:
    """A model from ``docs`` (doc_id, text, lang) outside the held-out fold."""
    ship(docs.sparkSession)
    rows = docs.where(F.crc32(F.col("doc_id").cast("string")) % p.folds != p.held_fold).where("lang is not null and text is not null").select("doc_id", "text", "lang")
    many = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not many:
        return train([], p)
    of = F.create_map(*[F.lit(x) for pair in sorted(many.items()) for x in pair])
    some = rows.where(F.pmod(F.xxhash64("doc_id"), of[F.col("lang")]) < p.rows_per_language)
    bags = some.select("lang", "text").mapInArrow(_bags(p), "lang string, buckets array<int>, counts array<float>").toArrow()
    return train([(lang, np.array(a, np.int32), np.array(c, np.float32)) for lang, a, c in zip(*(bags.column(i).to_pylist() for i in range(3)))], p)


def _predicted(source, p: Params):
    def run(batches):
        model = source.value
        for b in batches:
            texts = textkit.column(b, "text")
            n = len(texts)
            total = np.zeros((n, len(model.languages)))
            for lo, hi, buf, offs in textkit.pieces(texts):
                if not model.languages:
                    break
                for i, j in _runs(offs):
                    part, o = buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
                    doc, code = subwords(part, o, p.bits)
                    count = np.bincount(doc, minlength=j - i)
                    for k in range(len(model.languages)):
                        total[lo + i:lo + j, k] = np.bincount(doc, model.logits[code, k], minlength=j - i) / np.maximum(count, 1)
            letters = pc.match_substring_regex(b.column(b.schema.get_field_index("text")).cast(pa.large_string()).fill_null(""), r"\p{L}").to_numpy(zero_copy_only=False)
            known = letters & bool(model.languages)
            if model.languages:
                prob = model.probabilities(total)
                best, sure = prob.argmax(1), np.round(prob.max(1), 6)
            else:
                best, sure = np.zeros(n, int), np.zeros(n)
            names = [model.languages[k] if ok else "und" for k, ok in zip(best, known)]
            sure = np.where(known, sure, 0.0)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(names, pa.string()), pa.array(sure), pa.array(~known | (sure < model.accept))],
                                             names=["doc_id", "lang_pred", "score", "rejected"])
    return run


def _runs(offs: np.ndarray, size: int = 1 << 19):
    """Stretches of documents of about so many bytes."""
    i = 0
    while i < len(offs) - 1:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + size, "right")) - 1)
        yield i, j
        i = j


def predicted(docs: DataFrame, model: Model, p: Params = Params()) -> DataFrame:
    """doc_id, lang_pred, score, rejected of every row of ``docs`` (doc_id, text)."""
    ship(docs.sparkSession)
    source = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select("doc_id", "text").mapInArrow(_predicted(source, p), "doc_id long, lang_pred string, score double, rejected boolean")


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, p = documents(spark, sf_dir), Params()
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % p.folds == p.held_fold, F.lit(False))
    return predicted(docs, fit(docs, p), p).select("doc_id", held.alias("held_out"), "lang_pred", "score", "rejected")
