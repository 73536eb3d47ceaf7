"""Vector code compression: product codes fitted exactly through anchors-hierarchy metric trees.

Vectors become integers floor(scale * x) and are cut into ``parts`` equal parts.  Each task
takes its rows in chunks and builds, for every part position of a chunk, a metric tree by
the anchors hierarchy (Moore 2000): about sqrt(n) anchors are set, each at the point
furthest from its owner and taking only points that half the distance between anchors does
not rule out; anchors are merged upwards by the least enclosing ball and divided downwards
in the same way (middle out).  Balls cache count, sum, centre and radius.  The trees are
written once; rounds read them again.

A round walks all trees from their roots, level by level.  A ball inherits its parent's
list of candidate entries and strikes an entry off when another is strictly nearer for
every point that the ball could hold; once one entry is left, the ball is wholly owned and
its cached sum and count are added without looking at its points.  Leaves with several
candidates compare those by exact integer distances (ties to the lower index).  A task
hands on one row per part, entry and component; the sums of all tasks are codebook-sized.

What the driver and the broadcasts hold is bounded by entries x vector length.  Copies of
one vector are one ball of radius 0, however many there are.

Edge cases: rows whose vector is null or has a null or non-finite component are dropped; so
are those of another length than the first kept one (which must divide into the parts).  A
null vec_id is kept as a row and comes last; equal vec_ids are separate rows, in order of
their vectors.  Fewer kept rows than entries give a smaller codebook, none an empty result.
An integer component beyond +-2**26 raises (squares are 64-bit).  Further columns are ignored.
"""

from __future__ import annotations

import hashlib
import io
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpistar.llm.shared import Scratch, ship

WIDEST = 1 << 26


@dataclass(frozen=True)
class Params:
    parts: int = 16
    entries: int = 64
    rounds: int = 2
    scale: int = 256
    chunk: int = 2048        # vectors of one set of trees
    leaf: int = 32           # a ball of so many points is not divided


# ---------------------------------------------------------------- trees

def owners(x: np.ndarray, k: int) -> np.ndarray:
    """The anchor (0, 1, ...) that owns each point, with k anchors, fewer if points coincide."""
    owner, anchors = np.zeros(len(x), np.int64), [x[0]]
    far = np.sqrt(((x - x[0]) ** 2).sum(1))
    for a in range(1, k):
        new = int(far.argmax())
        if far[new] == 0:
            break
        apart = np.sqrt(((np.asarray(anchors) - x[new]) ** 2).sum(1))
        near = np.flatnonzero(far > apart[owner] / 2)     # others cannot be nearer to the new anchor
        d = np.sqrt(((x[near] - x[new]) ** 2).sum(1))
        taken = d < far[near]
        owner[near[taken]], far[near[taken]] = a, d[taken]
        anchors.append(x[new])
    return owner


def merges(centre: np.ndarray, radius: np.ndarray) -> Iterator[tuple[int, int]]:
    """Pairs (i, j) in order of merging: j goes into i, by the least ball around both."""
    n = len(centre)
    centre, radius = centre.copy(), radius.copy()

    def cost(i: int) -> np.ndarray:
        d = np.sqrt(((centre - centre[i]) ** 2).sum(1))
        return np.maximum((d + radius + radius[i]) / 2, np.maximum(radius, radius[i]))

    table = np.array([cost(i) for i in range(n)])
    np.fill_diagonal(table, np.inf)
    for _ in range(n - 1):
        i, j = divmod(int(table.argmin()), n)
        yield i, j
        d = math.sqrt(((centre[i] - centre[j]) ** 2).sum())
        whole = max((d + radius[i] + radius[j]) / 2, radius[i], radius[j])
        if d > 0:
            centre[i] = centre[i] + (centre[j] - centre[i]) * min(1.0, max(0.0, (whole - radius[i]) / d))
        radius[i] = whole
        table[j], table[:, j] = np.inf, np.inf
        row = cost(i)
        row[np.isinf(table[i])] = np.inf
        row[i] = np.inf
        table[i], table[:, i] = row, row


def tree(x: np.ndarray, leaf: int) -> dict[str, np.ndarray]:
    """The tree of points x (n, d): points in tree order, nodes (lo, hi, left, right), balls, sums."""
    points = x.astype(np.float64)
    left, right, held = [], [], []

    def node(a: int, b: int, rows: np.ndarray | None) -> int:
        left.append(a)
        right.append(b)
        held.append(rows)
        return len(left) - 1

    def build(rows: np.ndarray) -> int:
        own = owners(points[rows], max(2, math.isqrt(len(rows)))) if len(rows) > leaf else None
        if own is None or not own.any():
            return node(-1, -1, rows)
        groups = [rows[own == a] for a in range(own.max() + 1)]
        groups = [g for g in groups if len(g)]
        centre = np.array([points[g].mean(0) for g in groups])
        radius = np.array([np.sqrt(((points[g] - c) ** 2).sum(1).max()) for g, c in zip(groups, centre)])
        made = [build(g) for g in groups]
        for i, j in merges(centre, radius):
            made[i] = node(made[i], made[j], None)
        return made[i] if len(made) > 1 else made[0]

    root = build(np.arange(len(x)))
    order, lo, hi = [], np.zeros(len(left), np.int32), np.zeros(len(left), np.int32)
    at, todo = 0, [(root, False)]
    while todo:
        v, done = todo.pop()
        if done:
            hi[v] = at
            continue
        lo[v] = at
        todo.append((v, True))
        if left[v] < 0:
            order.append(held[v])
            at += len(held[v])
        else:
            todo += [(right[v], False), (left[v], False)]
    order = np.concatenate(order)
    sums = np.concatenate([np.zeros((1, x.shape[1]), np.int64), np.cumsum(x[order], 0, dtype=np.int64)])
    sums = sums[hi] - sums[lo]
    centre = sums / (hi - lo)[:, None]
    ranked = points[order]
    radius = np.array([np.sqrt(((ranked[a:b] - c) ** 2).sum(1).max()) for a, b, c in zip(lo, hi, centre)])
    return {"order": order.astype(np.int32), "points": x[order].astype(np.int32), "sums": sums, "root": np.array([root]),
            "nodes": np.column_stack([lo, hi, left, right]).astype(np.int32), "balls": np.column_stack([centre, radius])}


def owned(t: dict[str, np.ndarray], book: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray | None, np.ndarray]]:
    """Walks a tree: (nodes, None, entries) of wholly owned balls, (points, points, entries) of open leaves."""
    nodes, centre, radius = t["nodes"], t["balls"][:, :-1], t["balls"][:, -1]
    apart = np.sqrt(((book[:, None].astype(np.float64) - book[None]) ** 2).sum(2))
    level, open_ = t["root"].astype(np.int64), np.ones((1, len(book)), bool)
    while len(level):
        d = ((centre[level][:, None] - book[None]) ** 2).sum(2)
        best = np.where(open_, d, np.inf).argmin(1)
        nearest = d[np.arange(len(level)), best][:, None]
        # over a ball, the difference of two squared distances changes by at most 2 r |c - c'|
        margin = 1e-9 * (nearest + d) + 1e-6
        open_ = open_ & ~(nearest - d + 2 * radius[level][:, None] * apart[best] + margin < 0)
        single = open_.sum(1) == 1
        if single.any():
            yield level[single], None, best[single]
        leaf = ~single & (nodes[level, 2] < 0)
        if leaf.any():
            at = np.flatnonzero(leaf)
            lo, hi = nodes[level[at], 0].astype(np.int64), nodes[level[at], 1].astype(np.int64)
            which = np.repeat(at, hi - lo)
            rows = np.arange((hi - lo).sum()) + np.repeat(lo - np.concatenate([[0], np.cumsum(hi - lo)[:-1]]), hi - lo)
            for a in range(0, len(rows), 4096):
                r, w = rows[a:a + 4096], which[a:a + 4096]
                exact = ((t["points"][r][:, None].astype(np.int64) - book[None]) ** 2).sum(2)
                yield r, r, np.where(open_[w], exact, np.iinfo(np.int64).max).argmin(1)
        further = ~single & ~leaf
        level, open_ = nodes[level[further]][:, 2:].reshape(-1).astype(np.int64), np.repeat(open_[further], 2, 0)


def sums_of(t: dict[str, np.ndarray], book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entries, d) sums and (entries,) counts of the points that each entry owns."""
    total, count = np.zeros(book.shape, np.int64), np.zeros(len(book), np.int64)
    size = t["nodes"][:, 1] - t["nodes"][:, 0]
    for at, points, entry in owned(t, book):
        np.add.at(total, entry, t["sums"][at] if points is None else t["points"][at])
        np.add.at(count, entry, size[at] if points is None else 1)
    return total, count


def codes_of(t: dict[str, np.ndarray], book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) of every point, in the order of the chunk's rows."""
    code = np.zeros(len(t["order"]), np.int64)
    for at, points, entry in owned(t, book):
        if points is not None:
            code[points] = entry
            continue
        lo, n = t["nodes"][at, 0].astype(np.int64), (t["nodes"][at, 1] - t["nodes"][at, 0]).astype(np.int64)
        code[np.arange(n.sum()) + np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n)] = np.repeat(entry, n)
    error = ((t["points"].astype(np.int64) - book[code]) ** 2).sum(1)
    back = np.empty(len(code), np.int64)
    back[t["order"]] = np.arange(len(code))
    return code[back], error[back]


# ---------------------------------------------------------------- Spark

def _packed(trees: list[dict[str, np.ndarray]]) -> bytes:
    out = io.BytesIO()
    np.savez(out, **{f"{name}{p}": a for p, t in enumerate(trees) for name, a in t.items()})
    return out.getvalue()


def _unpacked(blob: bytes, parts: int) -> list[dict[str, np.ndarray]]:
    with np.load(io.BytesIO(blob)) as z:
        return [{name: z[f"{name}{p}"] for name in ("order", "points", "sums", "root", "nodes", "balls")} for p in range(parts)]


def _integers(values: np.ndarray, p: Params) -> np.ndarray:
    x = np.floor(values.astype(np.float64) * p.scale)
    if len(x) and np.abs(x).max() > WIDEST:
        raise ValueError("an integer component is beyond 2**26; the squares would not fit 64 bits")
    return x.astype(np.int64)


def _planted(length: int, p: Params):
    """Chunks of vectors as rows of trees."""
    def run(batches):
        schema = None
        for b in batches:
            schema = pa.schema([("vec_id", pa.list_(b.schema.field(0).type)), ("label", pa.list_(b.schema.field(1).type)), ("trees", pa.binary())])
            for a in range(0, len(b), p.chunk):
                part = b.slice(a, p.chunk)
                x = _integers(part.column(2).flatten().to_numpy(zero_copy_only=False).reshape(len(part), length), p)
                trees = [tree(c, p.leaf) for c in np.split(x, p.parts, 1)]
                yield pa.RecordBatch.from_pydict({"vec_id": [part.column(0).to_pylist()], "label": [part.column(1).to_pylist()], "trees": [_packed(trees)]}, schema=schema)
    return run


def _partial(books, p: Params):
    """part, entry, component, total of a task's trees; component -1 holds the count."""
    def run(batches):
        total = count = None
        for b in batches:
            for blob in b.column(0):
                for part, t in enumerate(_unpacked(blob.as_py(), p.parts)):
                    s, n = sums_of(t, books.value[part])
                    if total is None:
                        total, count = np.zeros((p.parts, *s.shape), np.int64), np.zeros((p.parts, len(n)), np.int64)
                    total[part] += s
                    count[part] += n
        if total is None:
            return
        both = np.concatenate([count[:, :, None], total], 2)
        part, entry, pos = np.indices(both.shape).reshape(3, -1)
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(pos - 1, pa.int32()), pa.array(both.reshape(-1))],
                                         names=["part", "entry", "pos", "total"])
    return run


def _coded(books, p: Params):
    def run(batches):
        for b in batches:
            for i in range(len(b)):
                found = [codes_of(t, books.value[part]) for part, t in enumerate(_unpacked(b.column(2)[i].as_py(), p.parts))]
                code = np.column_stack([c for c, _ in found]).astype(np.uint8)
                error = np.sum([e for _, e in found], 0)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0)[i].values, b.column(1)[i].values, pa.array([c.tobytes().hex() for c in code], pa.string()), pa.array(error, pa.int64())],
                    names=["vec_id", "label", "code", "error"])
    return run


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, label, embedding of the rows whose vector is whole and finite."""
    return vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding")).where(
        "embedding is not null and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('Infinity'))")


def compressed(vectors: DataFrame, p: Params = Params()) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error) of every kept row, and the codebooks (parts, entries, components)."""
    if not 0 < p.entries <= 256:
        raise ValueError("a code holds entries from 0 to 255")
    spark = vectors.sparkSession
    ship(spark)
    scratch, kept = Scratch(spark, "vector-codes"), usable(vectors)
    schema = f"vec_id {kept.schema['vec_id'].dataType.simpleString()}, label {kept.schema['label'].dataType.simpleString()}, code string, error bigint"
    order = [F.col("vec_id").asc_nulls_last(), "embedding"]
    head = kept.orderBy(*order).select("embedding").first()
    if head is None:
        return spark.createDataFrame([], schema), np.zeros((p.parts, 0, 0), np.int64)
    length = len(head[0])
    if length % p.parts:
        raise ValueError(f"vectors of {length} components cannot be cut into {p.parts} equal parts")
    kept = kept.where(F.size("embedding") == length)
    first = _integers(np.array([r[0] for r in kept.orderBy(*order).select("embedding").limit(p.entries).collect()]).reshape(-1, length), p)
    books = np.stack(np.split(first, p.parts, 1))
    typed = kept.schema
    chunks = scratch.put(kept.mapInArrow(_planted(length, p), f"vec_id array<{typed['vec_id'].dataType.simpleString()}>, "
                                         f"label array<{typed['label'].dataType.simpleString()}>, trees binary"), "trees")
    for _ in range(p.rounds):
        sent = spark.sparkContext.broadcast(books)
        rows = (chunks.select("trees").mapInArrow(_partial(sent, p), "part int, entry int, pos int, total long")
                .groupBy("part", "entry").pivot("pos", [*range(-1, length // p.parts)]).agg(F.sum(F.col("total").cast("decimal(38,0)"))).collect())
        books = books.copy()
        for part, entry, n, *totals in rows:
            if n:
                books[part, entry] = [int(s) // int(n) for s in totals]
    out = chunks.mapInArrow(_coded(spark.sparkContext.broadcast(books), p), schema)
    return scratch.put(out, "codes"), books


def with_label_error(coded: DataFrame) -> DataFrame:
    """The sum of error over the rows of equal labels (nulls together), as a further column.

    The sums are a written table: a join straight on the grouping would keep a label that
    most rows share in one task."""
    sums = Scratch(coded.sparkSession, "label-errors").put(coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")), "sums")
    return coded.join(sums, coded["label"].eqNullSafe(sums["of"]), "left").drop("of")


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = compressed(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    digest = hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()
    return with_label_error(coded).select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def _round(i: int) -> str:
    """The assignment to codebook ``book{i}`` and, from it, ``book{i + 1}``."""
    return f"""
near{i} AS MATERIALIZED (
  SELECT r, p, e, d FROM (
    SELECT x.r, x.p, b.e, list_sum(list_transform(list_zip(x.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
    FROM cut x JOIN book{i} b ON b.p = x.p)
  QUALIFY row_number() OVER (PARTITION BY r, p ORDER BY d, e) = 1),
mean{i} AS (
  SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY k) AS v FROM (
    SELECT p, e, k, sum(c)::BIGINT AS s, count(*) AS n
    FROM (SELECT a.p, a.e, unnest(x.v) AS c, unnest(range(len(x.v))) AS k FROM near{i} a JOIN cut x ON x.r = a.r AND x.p = a.p) GROUP BY p, e, k)
  GROUP BY p, e),
book{i + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(m.v, b.v) AS v FROM book{i} b LEFT JOIN mean{i} m ON m.p = b.p AND m.e = b.e)"""


ORACLE_SQL = f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cut AS MATERIALIZED (
  SELECT r, p, v[p * (len(v) // 16) + 1:(p + 1) * (len(v) // 16)] AS v FROM kept, (SELECT unnest(range(16)) AS p)),
book0 AS MATERIALIZED (SELECT p, r - 1 AS e, v FROM cut WHERE r <= 64),
{_round(0)},
{_round(1)},
{_round(2)},
coded AS (
  SELECT k.vec_id, k.label, c.code, c.error
  FROM (SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM near2 GROUP BY r) c JOIN kept k ON k.r = c.r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) FROM book2) AS codebooks_sha256
FROM coded
"""
