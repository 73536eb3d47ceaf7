"""Quality classifier: random Fourier features over document statistics, ridge scores, isotonic calibration.

Every text becomes ``STATISTICS`` (shares of byte classes, word and line shapes,
repetition).  They are standardised, mapped by ``features`` random Fourier features
(cosines whose inner products approximate a Gaussian kernel of width ``width``), and a
ridge regression on the labels is solved from normal equations that Spark sums over
the partitions; the driver sees one matrix of fixed size.  A fold of the training rows
that the fit leaves out gives counts by rounded raw score, from which pooled adjacent
violators make the raw score a probability.

Learning uses only rows whose crc32(doc_id as text) mod 5 is not 0 (mod 4 is the
calibration fold); labels, lang, source and doc_id are never inputs of a score.
Edge cases: a null or empty text has all statistics 0 and is scored like any text;
documents without a label, and null labels, are not learned from; several labels of a
document count as their mean; with no labels at all every score is 0.5; a null doc_id
is not held out and never learned from.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpistar.llm import textkit
from kpistar.llm.shared import Scratch, documents, ship


@dataclass(frozen=True)
class Params:
    features: int = 160
    width: float = 4.0
    ridge: float = 1e-3
    bins: int = 400          # of the raw score, for calibration
    threshold: float = 0.3
    folds: int = 5
    seed: int = 11


#: Byte classes: lower case, upper case, digit, white space, end punctuation, other ASCII, other bytes.
_CLASS = np.full(256, 6)
_CLASS[:128] = 5
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 0, 1, 2
_CLASS[[9, 10, 11, 12, 13, 32]] = 3
_CLASS[[33, 44, 46, 58, 59, 63]] = 4

STATISTICS = ["log_bytes", "log_words", "upper", "digit", "space", "punctuation", "symbol", "high", "symbol_per_word",
              "mean_word", "sd_word", "short_words", "long_words", "symbol_words", "ends_punctuated", "distinct", "upper_words",
              "words_per_line", "repeated_lines", "bare_symbols", "repeated_next", "exclaimed"]


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of STATISTICS for each text."""
    out = np.zeros((len(texts), len(STATISTICS)))
    for lo, hi, buf, offs in textkit.pieces(texts):
        n = hi - lo
        size = np.diff(offs).astype(float)
        owner = np.repeat(np.arange(n), np.diff(offs))
        kind = _CLASS[buf]
        by = np.bincount(owner * 7 + kind, minlength=7 * n).reshape(n, 7)
        start, end, doc, h = textkit.words(buf, offs)
        count = np.bincount(doc, minlength=n).astype(float)
        length = (end - start).astype(float)
        per = lambda x: np.bincount(doc, x, minlength=n) / np.maximum(count, 1)
        mean = per(length)
        symbols = np.concatenate([[0], np.cumsum(kind >= 5)]) - np.concatenate([[0], np.cumsum(kind == 6)])
        caps = np.concatenate([[0], np.cumsum(kind == 1)])
        in_word = (symbols[end] - symbols[start]).astype(float) if len(start) else length
        capital = (caps[end] - caps[start]).astype(float) if len(start) else length
        key = textkit.mix(h + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        order = np.argsort(key)
        fresh = np.ones(len(order), bool)
        fresh[1:] = key[order][1:] != key[order][:-1]
        distinct = np.bincount(doc[order][fresh], minlength=n)
        # lines: runs of words without a line break between them
        breaks = np.concatenate([[0], np.cumsum(buf == 10)])
        line = breaks[start] + doc if len(start) else doc        # a document border ends a line
        head = np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]])) if len(line) else line
        lines = np.bincount(doc[head], minlength=n).astype(float) if len(line) else np.zeros(n)
        if len(line):
            sums = np.add.reduceat(h, head)
            lkey = textkit.mix(sums + doc[head].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            lorder = np.argsort(lkey)
            same = np.zeros(len(lorder), bool)
            same[1:] = lkey[lorder][1:] == lkey[lorder][:-1]
            repeated = np.bincount(doc[head][lorder][same], minlength=n)
        else:
            repeated = np.zeros(n)
        same_next = np.zeros(len(h))
        same_next[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
        last = buf[end - 1] if len(end) else buf[:0]
        one = np.maximum(size, 1)
        out[lo:hi] = np.stack([
            np.log1p(size), np.log1p(count), by[:, 1] / one, by[:, 2] / one, by[:, 3] / one, by[:, 4] / one, by[:, 5] / one, by[:, 6] / one,
            by[:, 5] / np.maximum(count, 1), mean, np.sqrt(np.maximum(per(length**2) - mean**2, 0)), per(length <= 3), per(length >= 15),
            per(in_word > 0), per(_CLASS[last] == 4), distinct / np.maximum(count, 1), per((capital == length) & (length > 1)),
            np.log1p(count / np.maximum(lines, 1)), repeated / np.maximum(lines, 1), per((in_word == length) & (length > 0)),
            per(same_next), per(last == 33)], 1)
    return out


def _stats(batches):
    for b in batches:
        x = statistics(textkit.column(b, "text"))
        ends = np.arange(len(x) + 1, dtype=np.int32) * len(STATISTICS)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(ends, x.ravel())], names=["doc_id", "stats"])


def _fold(n: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % n


class Model:
    """Standardisation, random features, weights and calibration steps; a few hundred kilobytes."""

    def __init__(self, p: Params, mean: np.ndarray, scale: np.ndarray):
        rng = np.random.default_rng(p.seed)
        self.mean, self.scale = mean, scale
        self.directions = rng.normal(0, 1 / p.width, (len(mean), p.features))
        self.phase = rng.uniform(0, 2 * np.pi, p.features)
        self.weights = np.zeros(p.features + 1)
        self.steps = (np.array([0.0]), np.array([0.5]))

    def lift(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.mean) / self.scale, -8, 8)
        z = np.cos(x @ self.directions + self.phase) * np.sqrt(2 / len(self.phase))
        return np.concatenate([z, np.ones((len(z), 1))], 1)

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.lift(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.round(np.interp(self.raw(stats), *self.steps), 6)


def isotonic(x: np.ndarray, total: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pooled adjacent violators: the places and the non-decreasing means of label sums by place."""
    blocks: list[list[float]] = []                                   # label sum, rows, weighted place
    for a, t, c in zip(x, total, count):
        blocks.append([t, c, a * c])
        while len(blocks) > 1 and blocks[-2][0] / blocks[-2][1] >= blocks[-1][0] / blocks[-1][1]:
            last = blocks.pop()
            blocks[-1] = [u + v for u, v in zip(blocks[-1], last)]
    b = np.array(blocks)
    return b[:, 2] / b[:, 1], b[:, 0] / b[:, 1]


def _stats_of(batch: pa.RecordBatch) -> np.ndarray:
    a = batch.column(batch.schema.get_field_index("stats"))
    return a.flatten().to_numpy(zero_copy_only=False).reshape(len(a), len(STATISTICS))


def _normal_equations(model: Model):
    """Sums over a partition of z z' (upper triangle) and z y."""
    def run(batches):
        d = len(model.weights)
        gram, right = np.zeros((d, d)), np.zeros(d)
        for b in batches:
            z, y = model.lift(_stats_of(b)), b.column(b.schema.get_field_index("y")).to_numpy()
            gram += z.T @ z
            right += z.T @ y
        i, j = np.triu_indices(d)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([i, np.arange(d)]), pa.int32()), pa.array(np.concatenate([j, np.full(d, d)]), pa.int32()),
             pa.array(np.concatenate([gram[i, j], right]))], names=["i", "j", "v"])
    return run


def _raw(model: Model):
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(model.raw(_stats_of(b))), b.column(b.schema.get_field_index("y"))], names=["raw", "y"])
    return run


def fit(stats: DataFrame, labels: DataFrame, p: Params = Params()) -> Model:
    """A model from (doc_id, stats) rows and (doc_id, quality) labels; held-out rows are left out here."""
    y = labels.where("quality is not null").groupBy("doc_id").agg(F.avg("quality").alias("y"))
    fold = _fold(p.folds)
    train = stats.where(fold != 0).join(y, "doc_id").withColumn("calibrate", _fold(p.folds) == p.folds - 1)
    scratch = Scratch(stats.sparkSession, "quality-fit")
    train = scratch.put(train.select("stats", "y", "calibrate"), "train")
    n = len(STATISTICS)
    row = train.agg(*[F.avg(F.col("stats")[i]) for i in range(n)], *[F.stddev_pop(F.col("stats")[i]) for i in range(n)]).first()
    if row[0] is None:
        return Model(p, np.zeros(n), np.ones(n))
    model = Model(p, np.array(row[:n]), np.maximum(np.array(row[n:]), 1e-6))
    sums = (train.where("not calibrate").mapInArrow(_normal_equations(model), "i int, j int, v double")
            .groupBy("i", "j").agg(F.sum("v").alias("v")).toPandas())
    d = len(model.weights)
    full = np.zeros((d, d + 1))
    full[sums["i"], sums["j"]] = sums["v"]
    gram, right = full[:, :d], full[:, d]
    rows = gram[-1, -1]                                              # the constant feature
    if rows > 0:
        gram = np.triu(gram) + np.triu(gram, 1).T
        model.weights = np.linalg.solve(gram + p.ridge * rows * np.eye(d), right)
    bins = (train.where("calibrate").mapInArrow(_raw(model), "raw double, y double")
            .groupBy(F.round(F.greatest(F.lit(-1.0), F.least(F.lit(2.0), F.col("raw"))) * p.bins).alias("bin"))
            .agg(F.sum("y").alias("y"), F.count(F.lit(1)).alias("n")).toPandas().sort_values("bin"))
    if len(bins):
        model.steps = isotonic(bins["bin"].to_numpy() / p.bins, bins["y"].to_numpy(float), bins["n"].to_numpy(float))
    scratch.drop("train")
    return model


def _scored(model: Model):
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.score(_stats_of(b)))], names=["doc_id", "score"])
    return run


def _accepted(model: Model, threshold: float):
    def run(batches):
        for b in batches:
            yield b.filter(pa.array(model.score(statistics(textkit.column(b, "text"))) >= threshold))
    return run


def document_statistics(docs: DataFrame) -> DataFrame:
    ship(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(_stats, "doc_id long, stats array<double>")


def scores(docs: DataFrame, labels: DataFrame, p: Params = Params()) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs`` (doc_id, text)."""
    scratch = Scratch(docs.sparkSession, "quality")
    stats = scratch.put(document_statistics(docs), "stats")
    model = fit(stats, labels, p)
    held = F.coalesce(_fold(p.folds) == 0, F.lit(False))
    return stats.mapInArrow(_scored(model), "doc_id long, score double").select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= p.threshold).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, p: Params = Params()) -> DataFrame:
    """The rows of ``docs``, all columns, that the classifier scores at the threshold or above."""
    model = fit(document_statistics(docs.where(_fold(p.folds) != 0)), labels, p)
    return docs.mapInArrow(_accepted(model, p.threshold), docs.schema)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
