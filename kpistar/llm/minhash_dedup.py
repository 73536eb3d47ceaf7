"""MinHash near-dedup by a signature-coordinate inverted join.

Documents with equal shingle sets are one class.  Each class has a signature of
``coordinates`` minima; it is posted under its (coordinate, value) pairs.  Two sets of
Jaccard similarity J agree on about J * coordinates of them, so pairs with fewer than
``matches`` agreements are dropped and the rest confirmed on the full sets.  With the
defaults (64, 36) a pair at exactly 0.8 is missed with probability 5e-7.

* Prefix: values are ordered by how many classes have them, rarest first.  Two
  signatures that agree ``matches`` times must share one of their first
  ``coordinates - matches + 1`` values, so only those are posted; values that one class
  alone has are counted, not posted.
* Short lists (up to ``short_list`` classes) yield their pairs; collisions are counted
  on the signatures, and pairs of fewer than ``matches`` skipped.
* Longer lists never yield pairs.  A class leaves them if too many of its shingles are in
  no other class for any link.  Every list takes a leader (the class whose lists are the
  longest), its other classes are confirmed against it, and a list whose classes are all
  linked through one leader is done: a group of copies of one text takes rows in
  proportion to its size.
* What is left are lists that hold several components.  Their classes are dealt into
  blocks by the leaders they share; two blocks that share a list are intersected in one
  task (at most ``2 * block_rows`` sets), which returns a spanning forest of its links.
  Classes that are in the largest component of each of their lists need not meet each
  other.  This is exact and needs no cap.

Edge cases: a null or blank text has an empty set and links with nothing; a text of
fewer words than ``k`` has its whole word sequence as its one shingle; rows that share
a doc_id count as one document; a row with a null doc_id has a null component and is
kept.  Shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpistar.llm import textkit
from kpistar.llm.shared import Scratch, components, documents, ship


@dataclass(frozen=True)
class Params:
    k: int = 4               # words in a shingle
    percent: int = 80        # link at 100 * intersection >= percent * union
    coordinates: int = 64
    matches: int = 36
    short_list: int = 16
    block_rows: int = 256


def _multipliers(n: int) -> np.ndarray:
    return np.random.default_rng(7).integers(1, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signature(shingles: np.ndarray, mult: np.ndarray) -> np.ndarray:
    """The minimum of each hash function over the set, as int32."""
    low = np.full(len(mult), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 4096):
        x = textkit.mix(shingles[at:at + 4096])
        np.minimum(low, (x[:, None] * mult).min(0), out=low)
    return (low >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _features(p: Params):
    def run(batches):
        mult = _multipliers(p.coordinates)
        for b in batches:
            counts, digests, sigs = [], [], []
            for s in textkit.shingle_sets(textkit.column(b, "text"), p.k):
                counts.append(len(s))
                digests.append(hashlib.md5(s.tobytes()).digest() if len(s) else None)
                sigs.append(signature(s, mult) if len(s) else np.zeros(0, np.int32))
            ends = np.cumsum([0, *map(len, sigs)]).astype(np.int32)
            values = np.concatenate([np.zeros(0, np.int32), *sigs])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()), pa.ListArray.from_arrays(ends, values)],
                names=["doc_id", "text_hash", "n", "digest", "sig"])
    return run


def _sets(p: Params):
    def run(batches):
        for b in batches:
            sets = list(textkit.shingle_sets(textkit.column(b, "text"), p.k))
            ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            values = np.concatenate([np.zeros(0, np.uint64), *sets]).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(ends, values)], names=["cls", "shingles"])
    return run


def intersections(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """The size of the intersection of each set of a with each of b, by products of incidence blocks."""
    av, bv = np.concatenate(a), np.concatenate(b)
    ar, br = np.repeat(np.arange(len(a)), [len(x) for x in a]), np.repeat(np.arange(len(b)), [len(x) for x in b])
    both = np.intersect1d(av, bv)
    out = np.zeros((len(a), len(b)), np.float64)
    if not len(both):
        return out
    def places(v, r):
        at = np.minimum(np.searchsorted(both, v), len(both) - 1)
        hit = both[at] == v
        at, r = at[hit], r[hit]
        order = np.argsort(at, kind="stable")
        return at[order], r[order]
    (ac, ar), (bc, br) = places(av, ar), places(bv, br)
    for lo in range(0, len(both), 4096):
        m = []
        for c, r, n in ((ac, ar, len(a)), (bc, br, len(b))):
            i, j = np.searchsorted(c, [lo, lo + 4096])
            x = np.zeros((n, 4096), np.float32)
            x[r[i:j], c[i:j] - lo] = 1
            m.append(x)
        out += m[0] @ m[1].T
    return out


def forest(linked: np.ndarray) -> np.ndarray:
    """For a symmetric link matrix, each node's least reachable node."""
    n = len(linked)
    label = np.arange(n)
    while True:
        low = np.where(linked, label[None, :], n).min(1, initial=n)
        new = np.minimum(label, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _block_links(percent: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        ids, sets, left = rows["cls"].to_numpy(), list(rows["shingles"]), rows["side"].to_numpy() == 0
        a = np.flatnonzero(left)
        b = a if left.all() else np.flatnonzero(~left)
        size = np.array([len(s) for s in sets], np.float64)
        inter = intersections([sets[i] for i in a], [sets[i] for i in b])
        hit = 100 * inter >= percent * (size[a][:, None] + size[b][None, :] - inter)
        linked = np.zeros((len(ids), len(ids)), bool)
        linked[np.ix_(a, b)] = hit
        linked |= linked.T
        np.fill_diagonal(linked, False)
        label = forest(linked)
        keep = label != np.arange(len(ids))
        return pd.DataFrame({"u": ids[keep], "v": ids[label[keep]]})
    return run


def _agreeing(pairs: DataFrame, sigs: DataFrame, p: Params) -> DataFrame:
    """The pairs (a, b) whose signatures, of ``sigs`` (cls, sig), agree often enough."""
    agree = F.expr("aggregate(zip_with(sig_a, sig_b, (x, y) -> if(x = y, 1, 0)), 0, (s, x) -> s + x)")
    return (pairs.join(sigs.select(F.col("cls").alias("a"), F.col("sig").alias("sig_a")), "a")
            .join(sigs.select(F.col("cls").alias("b"), F.col("sig").alias("sig_b")), "b")
            .where(agree >= p.matches).select("a", "b"))


def _confirmed(pairs: DataFrame, sets: DataFrame, p: Params) -> DataFrame:
    """The pairs (a, b) that are links on their full sets, of ``sets`` (cls, shingles), as u, v."""
    both = F.size(F.array_intersect("set_a", "set_b"))
    return (pairs.join(sets.select(F.col("cls").alias("a"), F.col("shingles").alias("set_a")), "a")
            .join(sets.select(F.col("cls").alias("b"), F.col("shingles").alias("set_b")), "b")
            .where(100 * both >= p.percent * (F.size("set_a") + F.size("set_b") - both))
            .select(F.col("a").alias("u"), F.col("b").alias("v")))


def _undecided(members: DataFrame, sets: DataFrame, p: Params) -> DataFrame:
    """The members of lists that hold several components, without the classes that have too many shingles of their
    own for any link: a link shares ``percent`` of the shingles of either side."""
    of = sets.join(members.select("cls").distinct(), "cls", "left_semi")
    lonely = (of.select("cls", F.explode("shingles").alias("s")).groupBy("s").agg(F.min("cls").alias("cls"), F.max("cls").alias("last"))
              .where("cls = last").groupBy("cls").agg(F.count(F.lit(1)).alias("lonely")))
    # rows of several texts that share a doc_id are one class: any of its sets may have the link
    size = of.groupBy("cls").agg(F.sum(F.size("shingles")).alias("total"), F.min(F.size("shingles")).alias("least"))
    able = (size.join(lonely, "cls", "left").where(100 * F.coalesce("lonely", F.lit(0)) <= 100 * F.col("total") - p.percent * F.col("least")).select("cls"))
    left = members.join(able, "cls", "left_semi")
    several = left.groupBy("token").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("token")
    return left.join(several, "token", "left_semi")


def _led(scratch: Scratch, hot: DataFrame, reps: DataFrame, sets: DataFrame, links: DataFrame, p: Params) -> tuple[DataFrame, DataFrame]:
    """``links`` (u, v) with those to the leaders of the long lists, and the (token, cls, weight, component) of the lists
    that are not known to lie in one component then; classes of one ``component`` are linked through its leader."""
    members = hot.join(hot.groupBy("cls").agg(F.sum("len").alias("weight")), "cls").select("token", "cls", "weight", F.col("cls").alias("component"))
    members = scratch.put(_undecided(members, sets, p), "members")
    if members.isEmpty():
        return links, members
    lead = members.groupBy("token").agg(F.max(F.struct("weight", "cls"))["cls"].alias("b"))
    pairs = members.join(lead, "token").where("cls <> b").select(F.col("cls").alias("a"), "b").distinct()
    new = scratch.put(_confirmed(_agreeing(pairs, reps, p), sets, p), "led")
    # of the leaders that a class is linked with, itself among them, the one with the most links
    most = new.groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    of = (new.join(most, "v").select("u", "n", "v").union(most.select("v", "n", "v"))
          .groupBy("u").agg(F.max(F.struct("n", "v"))["v"].alias("led")).withColumnRenamed("u", "cls"))
    members = members.join(of, "cls", "left").select("token", "cls", "weight", F.coalesce("led", "cls").alias("component"))
    return links.unionByName(new), scratch.put(_undecided(members, sets, p), "members-led")


def _blocks(members: DataFrame, p: Params) -> DataFrame:
    """(cls, blk) of every class; blk is the best leader of its lists, whether it is outside the largest component
    of one of its lists (``rest``), and a part of at most about ``block_rows`` classes."""
    size = members.select("cls", "component").distinct().groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    top = (members.join(size, "component").groupBy("token")
           .agg(F.max(F.struct("weight", "cls")).alias("home"), F.max(F.struct("size", "component"))["component"].alias("top")))
    home = (members.join(top, "token").groupBy("cls").agg(F.max("home")["cls"].alias("home"), F.max(F.col("component") != F.col("top")).alias("rest")))
    dealt = home.groupBy("home", "rest").agg(F.ceil(F.count(F.lit(1)) / p.block_rows).alias("blocks"))
    return home.join(dealt, ["home", "rest"]).select("cls", F.struct("home", "rest", F.expr("pmod(xxhash64(cls), blocks)").alias("part")).alias("blk"))


def _long_lists(scratch: Scratch, hot: DataFrame, reps: DataFrame, sets: DataFrame, links: DataFrame, p: Params) -> DataFrame:
    """Links (u, v) of the same components as ``links`` and all links between classes that share a long list.

    ``hot`` has token, cls and len; ``reps`` (cls, sig) and ``sets`` (cls, shingles) have those of its classes."""
    links, members = _led(scratch, hot, reps, sets, links, p)
    block = scratch.put(_blocks(members, p), "blocks")
    on = members.select("token", "cls").join(block, "cls").select("token", "blk").distinct()
    meet = (on.withColumnRenamed("blk", "x").join(on.withColumnRenamed("blk", "y"), "token").where("x <= y and (x.rest or y.rest)")
            .select("x", "y").distinct().withColumn("meet", F.xxhash64("x", "y")))
    sides = meet.select("meet", "x", "y", F.posexplode(F.expr("if(x = y, array(x), array(x, y))")).alias("side", "blk"))
    parts = sides.join(block.join(sets, "cls"), "blk").select("meet", "x", "y", "side", "cls", "shingles")
    return links.unionByName(parts.groupBy("meet", "x", "y").applyInPandas(_block_links(p.percent), "u long, v long"))


def near_duplicates(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of ``docs`` (doc_id, text)."""
    return _grouped(docs, p).drop("text_hash")


def _grouped(docs: DataFrame, p: Params) -> DataFrame:
    """``near_duplicates`` with the ``text_hash`` that tells rows of one doc_id apart."""
    spark = docs.sparkSession
    ship(spark)
    scratch = Scratch(spark, "minhash")
    docs = docs.select("doc_id", "text")
    feats = scratch.put(docs.withColumn("text_hash", F.xxhash64("text")).mapInArrow(_features(p), "doc_id long, text_hash long, n long, digest binary, sig array<int>"), "features")
    # rows of one digest have one set, so one signature
    reps = scratch.put(feats.where("digest is not null and doc_id is not null").groupBy("digest")
                       .agg(F.min("doc_id").alias("cls"), F.first("sig").alias("sig")), "reps")
    classes = reps.select("digest", "cls")

    # prefix: the rarest values of each signature
    token = F.expr("transform(sig, (x, i) -> shiftleft(cast(i as bigint), 32) | (cast(x as bigint) & 4294967295))")
    posts = reps.select("cls", F.explode(token).alias("token"))
    shared = posts.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    length = p.coordinates - p.matches + 1
    prefix = (posts.join(shared, "token").groupBy("cls").agg(F.sort_array(F.collect_list(F.struct("n", "token"))).alias("t"))
              .select("cls", F.explode(F.expr(f"slice(t, 1, greatest(0, {length - p.coordinates} + size(t)))")).alias("t")).select("cls", "t.token"))
    prefix = scratch.put(prefix, "prefix")
    lists = prefix.groupBy("token").agg(F.count(F.lit(1)).alias("len")).where("len > 1")
    posted = scratch.put(prefix.join(lists, "token"), "posted")

    # short lists: pairs, counted and completed on the signatures; a class has at most ``short_list`` a token
    short = posted.where(F.col("len") <= p.short_list).select("token", "cls")
    pairs = (short.select("token", F.col("cls").alias("a")).join(short.select("token", F.col("cls").alias("b")), "token").where("a < b")
             .groupBy("a").agg(F.collect_set("b").alias("b")).select("a", F.explode("b").alias("b")))
    pairs = scratch.put(_agreeing(pairs, reps, p), "pairs")

    hot = posted.where(F.col("len") > p.short_list)
    wanted = pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).union(hot.select("cls")).distinct()
    # the ids grow with the corpus: a shuffle at every size, never a broadcast
    sets = scratch.put(docs.join(wanted.withColumnRenamed("cls", "doc_id").hint("merge"), "doc_id", "left_semi")
                       .mapInArrow(_sets(p), "cls long, shingles array<bigint>").where("size(shingles) > 0"), "sets")
    long = hot.select("cls").distinct()
    hot_sets = scratch.put(sets.join(long, "cls", "left_semi"), "hot-sets")
    comp = components(scratch, _long_lists(scratch, hot, reps, hot_sets, _confirmed(pairs, sets, p), p))
    scratch.drop("sets", "hot-sets", "prefix", "posted", "pairs", "members", "members-led", "blocks")

    of_class = classes.join(comp.withColumnRenamed("node", "cls"), "cls", "left").select("digest", F.coalesce("component", "cls").alias("component"))
    row = feats.select("doc_id", "text_hash", F.col("n").alias("n_shingles"), "digest").join(of_class, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return row.select("doc_id", "text_hash", "n_shingles", component.alias("component_id"),
                      F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def without_near_duplicates(docs: DataFrame, p: Params = Params(k=5)) -> DataFrame:
    """One document, all columns, of each group of near-duplicates; rows without a doc_id stay as they are."""
    keep = _grouped(docs, p).where("kept and doc_id is not null").select("doc_id", "text_hash").distinct()
    rows = docs.where("doc_id is not null").select(F.struct("*").alias("row"), "doc_id", F.xxhash64("text").alias("text_hash"))
    # most ids are kept, so they grow with the corpus: a shuffle at every size
    one = rows.join(keep.hint("merge"), ["doc_id", "text_hash"], "left_semi").dropDuplicates(["doc_id", "text_hash"]).select("row.*")
    return one.unionByName(docs.where("doc_id is null"))


def op10_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))


ORACLE_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS x FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * k >= 80 * (na.n + nb.n - k)),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a, min(b) AS c FROM r GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c AS component_id, d.doc_id = c AS kept
FROM documents d JOIN c ON c.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""
