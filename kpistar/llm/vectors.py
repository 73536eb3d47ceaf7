"""Embedding near-dedup by an epsilon grid order join.

Vectors are scaled to length 1, so a cosine of at least c is a distance of at most
``eps = sqrt(2 - 2c)``.  They are rotated to their principal axes (Spark sums the
covariance; the driver sees one matrix of the vectors' width), and sorted by the cells of
a grid of width eps on the leading axes.  The sequence is cut into blocks of about
``block_rows``; blocks are leaves of a tree of intervals with bounding boxes.  The join starts
with the root and itself and goes down a level at a time: pairs of intervals whose boxes
are further apart than eps are left out, the others become pairs of their children.  Blocks are
written once, a row each, with their components as they were read; a task reads two parts of them and
compares the pairs of leaves that are left, where it again skips distant stretches, computes cosines in
double precision, and returns link counts and a spanning forest of the links, never the
pairs.  So disk grows with the rows, though pairs may with their square.  Equal vectors are one class
beforehand, so copies do not multiply.

Edge cases: vectors that are null, empty, zero or hold null or non-finite components link
with nothing; vectors of different length compare as if the shorter ended in zeros; a null
vec_id links with nothing and is kept; rows that share a vec_id are counted one by one.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpistar.llm.shared import Scratch, components, ship
from kpistar.operators.joins import bounded_broadcast


@dataclass(frozen=True)
class Params:
    cosine: float = 0.9
    block_rows: int = 2048
    stretch: int = 256         # rows skipped or compared at once within a pair of blocks
    grid_axes: int = 8
    fan_bits: int = 4          # 2 ** fan_bits children of an interval

    @property
    def reach(self) -> float:
        """eps squared, with room for rounding."""
        return 2 - 2 * self.cosine + 1e-9


def unit(v: np.ndarray | None) -> np.ndarray | None:
    """The vector scaled to length 1 in double precision; None if it links with nothing."""
    if v is None or not len(v):
        return None
    v = np.asarray(v, np.float64)
    top = np.abs(v).max()
    if not np.isfinite(top) or top == 0:
        return None
    v = v / top
    return v / np.sqrt((v * v).sum())


def _units(kind: str):
    """(vec_id, key, raw) rows: the class of a vector, and its components as numbers of ``kind``."""
    def run(batches):
        yield from _keyed(batches, kind)
    return run


def _keyed(batches, kind: str):
    for b in batches:
        ids, keys, vecs = [], [], []
        a = b.column(b.schema.get_field_index("embedding"))
        flat = a.flatten()
        values = flat.to_numpy(zero_copy_only=False).astype(np.float64)       # nulls become NaN
        ends = np.concatenate([[0], np.cumsum(a.value_lengths().fill_null(0).to_numpy())])
        for i in range(len(a)):
            u = unit(values[ends[i]:ends[i + 1]])
            raw = values[ends[i]:ends[i + 1]]
            keys.append(None if u is None else hashlib.md5((np.trim_zeros(raw, "b") + 0.0).tobytes()).digest())
            vecs.append(None if u is None else raw.astype(kind).tobytes())
        yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index("vec_id")), pa.array(keys, pa.binary()), pa.array(vecs, pa.binary())],
                                         names=["vec_id", "key", "raw"])


def _matrix(raws: list[bytes], width: int, kind: str) -> np.ndarray:
    """The vectors scaled to length 1 in double precision, as rows; shorter ones end in zeros."""
    size = np.dtype(kind).itemsize
    if all(len(r) == size * width for r in raws):
        out = np.frombuffer(b"".join(raws), kind).reshape(len(raws), width).astype(np.float64)
    else:
        out = np.zeros((len(raws), width))
        for i, r in enumerate(raws):
            out[i, :len(r) // size] = np.frombuffer(r, kind)
    out /= np.abs(out).max(1, keepdims=True)
    return out / np.sqrt((out * out).sum(1, keepdims=True))


def _moments(width: int, kind: str):
    """Sums of x x' (upper triangle), of x (column ``width``) and the rows (at width, width) of a partition."""
    def run(batches):
        total = np.zeros((width + 1, width + 1))
        for b in batches:
            x = _matrix(b.column(b.schema.get_field_index("raw")).to_pylist(), width, kind)
            x = np.concatenate([x, np.ones((len(x), 1))], 1)
            total += x.T @ x
        i, j = np.triu_indices(width + 1)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], names=["i", "j", "v"])
    return run


def principal_axes(classes: DataFrame, width: int, kind: str) -> np.ndarray:
    sums = classes.select("raw").mapInArrow(_moments(width, kind), "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).toPandas()
    m = np.zeros((width + 1, width + 1))
    m[sums["i"], sums["j"]] = sums["v"]
    n = max(m[-1, -1], 1)
    mean = m[:width, -1] / n
    cov = (np.triu(m) + np.triu(m, 1).T)[:width, :width] / n - np.outer(mean, mean)
    return np.linalg.eigh(cov)[1][:, ::-1]


def _cells(axes: np.ndarray, p: Params, kind: str):
    def run(batches):
        for b in batches:
            x = _matrix(b.column(b.schema.get_field_index("raw")).to_pylist(), len(axes), kind) @ axes[:, :p.grid_axes]
            cells = np.floor(x / np.sqrt(p.reach)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.ListArray.from_arrays(
                np.arange(len(x) + 1, dtype=np.int32) * cells.shape[1], cells.ravel())], names=[*b.schema.names, "cells"])
    return run


def _blocks(axes: np.ndarray, p: Params, kind: str):
    """Consecutive rows of a sorted partition as blocks, one row each, with their box."""
    def run(batches):
        part, chunk = TaskContext.get().partitionId(), 0
        for b in batches:
            raws = b.column(b.schema.get_field_index("raw"))
            for at in range(0, len(raws), p.block_rows):
                own = raws.slice(at, p.block_rows)
                y = _matrix(own.to_pylist(), len(axes), kind) @ axes
                one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part], pa.int64()), pa.array([chunk], pa.int64()), *(one(b.column(b.schema.get_field_index(c)).slice(at, p.block_rows)) for c in ("cls", "n")),
                     one(own), pa.array([y.min(0)], pa.list_(pa.float64())), pa.array([y.max(0)], pa.list_(pa.float64()))], names=["part", "chunk", "cls", "n", "raw", "lo", "hi"])
                chunk += 1
    return run


def _boxes(blocks: DataFrame, node: Column) -> DataFrame:
    """(node, box: array<struct<lo,hi>>), the union of the boxes of each node."""
    axis = blocks.select(node.alias("node"), F.posexplode(F.arrays_zip("lo", "hi")).alias("k", "x"))
    return (axis.groupBy("node", "k").agg(F.min("x.lo").alias("lo"), F.max("x.hi").alias("hi"))
            .groupBy("node").agg(F.sort_array(F.collect_list(F.struct("k", "lo", "hi"))).alias("box")))


def _interval_pairs(scratch: Scratch, blocks: DataFrame, bits: int, p: Params) -> DataFrame:
    """Pairs (a, b), a <= b, of block codes whose boxes are within reach of each other."""
    gap = F.expr("aggregate(zip_with(box_a, box_b, (x, y) -> pow(greatest(0D, x.lo - y.hi, y.lo - x.hi), 2)), 0D, (s, d) -> s + d)")
    pairs = scratch.spark.range(1).select(F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"))
    for shift in range((max(bits, 1) - 1) // p.fan_bits * p.fan_bits, -1, -p.fan_bits):
        level = scratch.put(_boxes(blocks, F.shiftright("code", shift)), f"boxes-{shift}").withColumn("up", F.shiftright("node", p.fan_bits))
        level = bounded_broadcast(level)                       # boxes are not moved with every pair
        left = level.select(F.col("up").alias("a"), F.col("node").alias("na"), F.col("box").alias("box_a"))
        right = level.select(F.col("up").alias("b"), F.col("node").alias("nb"), F.col("box").alias("box_b"))
        down = pairs.join(left, "a").join(right, "b").where("na <= nb").where(gap <= p.reach)
        pairs = scratch.put(down.select(F.col("na").alias("a"), F.col("nb").alias("b")), f"pairs-{shift}")
    return pairs


def merge_links(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels (each node's least known reachable node) after the links i - j."""
    while len(i):
        a, b = label[i], label[j]
        low, high = np.minimum(a, b), np.maximum(a, b)
        if (low == high).all():
            break
        new = label.copy()
        np.minimum.at(new, high, low)
        while (new[new] != new).any():
            new = new[new]
        label = new[label]
    return label


def _meet(axes: np.ndarray, p: Params, kind: str):
    """Link counts (u, null, n) and forest edges (u, v, null) of each pair of blocks, a row each."""
    def met(row: dict):
        same = row["a"] == row["b"]
        first, ids, n, raws = len(row["cls_a"]), row["cls_a"], row["n_a"], row["raw_a"]
        if not same:
            ids, n, raws = ids + row["cls_b"], n + row["n_b"], raws + row["raw_b"]
        ids, n, x = np.array(ids, np.int64), np.array(n, np.int64), _matrix(raws, len(axes), kind)
        y = x @ axes
        cuts = [np.arange(at, min(at + p.stretch, end)) for start, end in ((0, first), (first, len(ids))) for at in range(start, end, p.stretch)]
        box = [(y[c].min(0), y[c].max(0)) for c in cuts]
        own = sum(c[0] < first for c in cuts)
        links, label = np.zeros(len(ids), np.int64), np.arange(len(ids))
        for a in range(own):
            for b in range(a, own) if same else range(own, len(cuts)):
                apart = np.maximum(0, np.maximum(box[a][0] - box[b][1], box[b][0] - box[a][1]))
                if (apart * apart).sum() > p.reach:
                    continue
                cos = x[cuts[a]] @ x[cuts[b]].T
                hit = cos >= p.cosine
                if a == b:
                    np.fill_diagonal(hit, False)
                if not hit.any():
                    continue
                links[cuts[a]] += hit @ n[cuts[b]]
                if a != b:
                    links[cuts[b]] += n[cuts[a]] @ hit
                i, j = np.nonzero(hit)
                label = merge_links(label, cuts[a][i], cuts[b][j])
        linked, child = np.flatnonzero(links), np.flatnonzero(label != np.arange(len(ids)))
        return [np.concatenate(c) for c in ((ids[linked], ids[child]), (np.zeros(len(linked), np.int64), ids[label[child]]), (links[linked], np.zeros(len(child), np.int64)))], len(linked)

    def run(batches):
        for b in batches:
            for k in range(len(b)):
                (u, v, n), links = met(b.slice(k, 1).to_pylist()[0])
                edge = np.arange(len(u)) >= links
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v, mask=~edge), pa.array(n, mask=edge)], names=["u", "v", "n"])
    return run


#: Pairs of blocks in one batch, and parts of the sequence: the pairs of parts are the tasks in which blocks meet.
BATCH, MOST_PARTS = "4", 256


def _met(scratch: Scratch, blocks: DataFrame, pairs: DataFrame, axes: np.ndarray, p: Params, kind: str) -> DataFrame:
    """What the pairs of blocks give.  A task reads two parts of the written blocks and compares their
    pairs: a block meets many others, so moving it to each would write the square of the rows to disk."""
    lists = scratch.put(pairs.groupBy("a").agg(F.collect_list("b").alias("partners")), "partners")
    left = blocks.select(F.col("code").alias("_a"), *[F.col(c).alias(f"{c}_a") for c in ("cls", "n", "raw")]).join(bounded_broadcast(lists), F.col("_a") == F.col("a")).drop("_a")
    right = blocks.select(F.col("code").alias("b"), *[F.col(c).alias(f"{c}_b") for c in ("cls", "n", "raw")])
    sides = left.join(right.hint("shuffle_replicate_nl"), F.array_contains("partners", F.col("b"))).drop("partners")
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = scratch.spark.conf.get(key, None)
    scratch.spark.conf.set(key, BATCH)
    try:
        return scratch.put(sides.mapInArrow(_meet(axes, p, kind), "u long, v long, n long"), "met")
    finally:
        scratch.spark.conf.unset(key) if before is None else scratch.spark.conf.set(key, before)


def near_duplicates(vectors: DataFrame, p: Params = Params()) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of ``vectors`` (vec_id, embedding)."""
    spark = vectors.sparkSession
    ship(spark)
    scratch = Scratch(spark, "vectors")
    kind, of = ("<f4", "array<float>") if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else ("<f8", "array<double>")
    units = vectors.select("vec_id", F.col("embedding").cast(of).alias("embedding")).mapInArrow(_units(kind), "vec_id long, key binary, raw binary")
    rows = scratch.put(units.select("vec_id", "key"), "rows")
    classes = scratch.put(units.where("vec_id is not null and key is not null").groupBy("key").agg(
        F.min("vec_id").alias("cls"), F.count(F.lit(1)).alias("n"), F.min("raw").alias("raw")), "classes")
    names = scratch.put(classes.select("key", "cls", "n"), "names")
    scratch.release()
    total, width = classes.agg(F.count(F.lit(1)), F.max(F.octet_length("raw") / np.dtype(kind).itemsize)).first()
    counts = edges = None
    if total:
        axes = principal_axes(classes, int(width), kind)
        cells = classes.mapInArrow(_cells(axes, p, kind), "key binary, cls long, n long, raw binary, cells array<int>")
        ordered = cells.repartitionByRange(max(1, min(MOST_PARTS, total // (4 * p.block_rows))), "cells", "key").sortWithinPartitions("cells", "key")
        blocks = scratch.put(ordered.mapInArrow(_blocks(axes, p, kind), "part long, chunk long, cls array<long>, n array<long>, raw array<binary>, lo array<double>, hi array<double>"), "blocks")
        scratch.drop("classes")
        scratch.release()
        parts, chunks = blocks.agg(F.max("part") + 1, F.max("chunk") + 1).first()
        chunk_bits = int(chunks - 1).bit_length()
        blocks = blocks.withColumn("code", F.shiftleft("part", chunk_bits) + F.col("chunk"))
        pairs = _interval_pairs(scratch, blocks.select("code", "lo", "hi"), max(1, int((int(parts) << chunk_bits) - 1).bit_length()), p)
        met = _met(scratch, blocks, pairs, axes, p, kind)
        scratch.drop("blocks")
        counts = met.where("v is null").groupBy("u").agg(F.sum("n").alias("links"))
        edges = components(scratch, met.where("v is not null").select("u", "v"))
    else:
        counts = spark.createDataFrame([], "u long, links long")
        edges = spark.createDataFrame([], "node long, component long")
    of_class = (names.join(counts, F.col("cls") == F.col("u"), "left").join(edges, F.col("cls") == F.col("node"), "left")
                .select("key", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "cls").alias("component")))
    alone = F.col("vec_id").isNull()
    out = rows.select("vec_id", "key").join(of_class, "key", "left")
    component = F.when(~alone, F.coalesce("component", "vec_id"))
    return out.select("vec_id", F.when(alone, 0).otherwise(F.coalesce("n_links", F.lit(0))).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"))


def op1_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


ORACLE_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
                     WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                       AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.9),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
comp AS (SELECT a, min(b) AS c FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS k FROM links GROUP BY a)
SELECT vec_id, coalesce(k, 0) AS n_links, c AS component_id, vec_id = c AS kept
FROM embeddings JOIN comp ON comp.a = vec_id LEFT JOIN n ON n.a = vec_id
"""
