"""Source divergence audit: term distributions of sources compared, with late string materialization.

Terms are runs of A-Z, a-z and characters beyond ASCII, A-Z lower-cased.  The scan counts
them batch by batch and writes rows (l, g, digest, n, docs, term), one per distinct term of a
batch and group; equal digests are compared byte by byte there, so a row never mixes two
terms.  Languages and (language, source) groups go by digests, too (l and g, under the first
seed that gives them all different ones).  All counting after that reads and shuffles rows
of fixed width: the column of strings stays in the files.

Strings come back twice.  The least and the greatest string of each digest that some
language keeps tell whether two terms share it; such digests are counted again by
(digest, string), each string under a number of its own (``spelling``, 0 if alone).  A
collision among digests that nothing keeps does no harm: their joint count of documents is
already under the limit.  At the end, strings are joined to the rows that can reach the
report: those of a group's ``top`` greatest values and their ties.

Probabilities are integers, p = 1 + floor(10**9 (n + 1) / (N + V)), and a term's value is
floor((p - q)**2 / q).  The sum over all V terms for two sources needs only the terms that
one of them has: sum f(p, q) = V f(p0, q0) + [terms of the first: f(p, q0) - f(p0, q0)]
+ [terms of the second: f(p0, q) - f(p0, q0)] + [common terms: f(p, q) - f(p, q0) -
f(p0, q) + f(p0, q0)], p0 and q0 being the values at n = 0.  The first two sums go by
histograms of p, the last by a join on the digest that is summed before it is shuffled.

Edge cases: null text, lang and source are ''; empty texts have no terms, their groups are
reported all the same; every row is a document, repeated ids and rows included; a term of any
length is one row of the written table; an empty table gives no rows; further columns are
ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kpistar.llm import textkit
from kpistar.llm.shared import Scratch, documents, ship

NOT_LETTER = np.array([b < 128 and not chr(b).isalpha() for b in range(256)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
ONE = 1_000_000_000
#: Rows of a batch that goes back to Spark: the JVM holds a few such batches beside its heap.
ROWS_OUT = 16_384


@dataclass(frozen=True)
class Params:
    min_docs: int = 3
    top: int = 200
    digest_bits: int = 64


# ---------------------------------------------------------------- the scan

def _gather(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Positions start[i], start[i] + 1, ... of all runs, one after another."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - ends + size, size)


def distinct_terms(buf: np.ndarray, start: np.ndarray, end: np.ndarray, digest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(an occurrence of each distinct term, the number of each occurrence's term), told apart by bytes."""
    _, first, number = np.unique(digest, return_index=True, return_inverse=True)
    other = np.flatnonzero(first[number] != np.arange(len(digest)))
    size, model = (end - start)[other], first[number[other]]
    differs = size != (end - start)[model]
    same = np.flatnonzero(~differs)
    if len(same):
        unequal = buf[_gather(start[other[same]], size[same])] != buf[_gather(start[model[same]], size[same])]
        if unequal.any():
            differs[same[np.repeat(np.arange(len(same)), size[same])[unequal]]] = True
    if differs.any():
        extra: dict[tuple, int] = {}
        found = list(first)
        for i in other[differs]:
            key = (digest[i], buf[start[i]:end[i]].tobytes())
            if key not in extra:
                extra[key] = len(found)
                found.append(i)
            number[i] = extra[key]
        first = np.array(found)
    return first, number


def _strings(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(buf[_gather(start, end - start)])])


def _counted(p: Params):
    mask = np.uint64((1 << p.digest_bits) - 1)

    def run(batches):
        for b in batches:
            # a group has one language: its digest is looked up by the group's
            coded = b.column(1).dictionary_encode()
            group = coded.indices.to_numpy().astype(np.int64)
            lang = np.zeros(len(coded.dictionary), np.int64)
            lang[group] = b.column(0).to_numpy()
            found = []
            for lo, hi, raw, offs in textkit.pieces(textkit.column(b, "text")):
                buf = LOWER[raw]
                start, end, doc, h = textkit.words(buf, offs, NOT_LETTER)
                if not len(h):
                    continue
                digest = h & mask
                first, number = distinct_terms(buf, start, end, digest)
                # per document, then per group
                pair, n = np.unique(doc * len(first) + number, return_counts=True)
                of, term = group[lo + pair // len(first)], pair % len(first)
                _, at, inv = np.unique(of * len(first) + term, return_index=True, return_inverse=True)
                rep = first[term[at]]
                found.append(pa.table({"g": of[at], "digest": digest[rep].view(np.int64), "term": _strings(buf, start[rep], end[rep]),
                                       "n": np.bincount(inv, n).astype(np.int64), "docs": np.bincount(inv)}))
            if not found:
                continue
            t, found = pa.concat_tables(found), None
            t = t.group_by(["g", "digest", "term"]).aggregate([("n", "sum"), ("docs", "sum")])
            g = t["g"].to_numpy()
            yield from pa.table({
                "l": lang[g], "g": coded.dictionary.take(pa.array(g)), "digest": t["digest"],
                "n": t["n_sum"], "docs": t["docs_sum"].cast(pa.int64()), "term": t["term"].cast(pa.binary()).cast(pa.string())}).to_batches(max_chunksize=ROWS_OUT)
            # what this batch took goes back before the next one comes
            t = None
            pa.default_memory_pool().release_unused()
    return run


# ---------------------------------------------------------------- counts

KEY = ["digest", "spelling"]


def _kept(counts: DataFrame, p: Params) -> DataFrame:
    return (counts.groupBy("l", *KEY).agg(F.sum("n").alias("n_lang"), F.sum("docs").alias("docs"))
            .where(F.col("docs") >= p.min_docs).drop("docs"))


def counted_terms(docs: DataFrame, scratch: Scratch, p: Params) -> tuple[DataFrame, DataFrame, DataFrame]:
    """counts (l, g, digest, spelling, n, docs), kept (l, digest, spelling, n_lang) and texts (digest, spelling, term)
    of ``docs`` (l, g, text)."""
    rows = scratch.put(docs.mapInArrow(_counted(p), "l long, g long, digest long, n long, docs long, term string"), "terms")
    sums = [F.sum("n").alias("n"), F.sum("docs").alias("docs")]
    counts = scratch.put(rows.groupBy("l", "g", "digest").agg(*sums).withColumn("spelling", F.lit(0)), "counts")
    kept = scratch.put(_kept(counts, p), "kept")
    span = rows.groupBy("digest").agg(F.min("term").alias("least"), F.max("term").alias("greatest"))
    texts = scratch.put(span.join(kept.select("digest").distinct(), "digest", "left_semi"), "texts")
    shared = texts.where("least <> greatest").select("digest")
    alone = texts.where("least = greatest").select("digest", F.lit(0).alias("spelling"), F.col("least").alias("term"))
    if shared.isEmpty():
        return counts, kept, alone
    spelled = (rows.join(shared, "digest", "left_semi").select("digest", "term").distinct()
               .withColumn("spelling", F.row_number().over(W.partitionBy("digest").orderBy("term"))))
    spelled = scratch.put(spelled, "spelled")
    again = rows.join(spelled, ["digest", "term"]).groupBy("l", "g", *KEY).agg(*sums)
    counts = scratch.put(counts.join(shared, "digest", "left_anti").unionByName(again), "counts-split")
    return counts, scratch.put(_kept(counts, p), "kept-split"), alone.unionByName(spelled)


def probability(n: Column | str, total: str, terms: str) -> Column:
    """1 + floor(10**9 (n + 1) / (total + terms)), exact for any long."""
    top = f"cast({ONE} as decimal(10,0)) * cast({n} + 1 as decimal(20,0))"
    return F.expr(f"if({total} + {terms} = 0, 0, 1 + ({top}) div cast(nullif({total} + {terms}, 0) as decimal(20,0)))").cast("long")


def excess(p: str, q: str) -> str:
    return f"((({p}) - ({q})) * (({p}) - ({q})) div ({q}))"


def numbered(groups: DataFrame) -> tuple[DataFrame, int]:
    """The groups (lang, source) with digests l and g that tell them apart, and the seed of these."""
    seed = 0
    while True:
        out = groups.select("lang", "source", *digests_of(seed))
        langs, ls, n, gs = out.agg(F.countDistinct("lang"), F.countDistinct("l"), F.count(F.lit(1)), F.countDistinct("g")).first()
        if langs == ls and n == gs:
            return out, seed
        seed += 1


def digests_of(seed: int) -> list[Column]:
    return [F.xxhash64(F.lit(seed), "lang").alias("l"), F.xxhash64(F.lit(seed), "lang", "source").alias("g")]


def audited(docs: DataFrame, p: Params = Params()) -> tuple[DataFrame, DataFrame]:
    """Divergent terms (lang, source, item, value, rank) of each source, and its other sources likewise."""
    spark = docs.sparkSession
    ship(spark)
    scratch = Scratch(spark, "divergence")
    docs = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    groups, seed = numbered(scratch.put(docs.select("lang", "source").distinct(), "groups"))
    counts, kept, texts = counted_terms(docs.select(*digests_of(seed), "text"), scratch, p)

    of_source = scratch.put(counts.join(kept, ["l", *KEY]).select("l", "g", *KEY, "n", "n_lang"), "kept-counts")
    of_lang = kept.groupBy("l").agg(F.count(F.lit(1)).alias("terms"), F.sum("n_lang").alias("lang_total"))
    totals = (groups.join(of_source.groupBy("g").agg(F.sum("n").alias("total")), "g", "left").join(of_lang, "l", "left")
              .na.fill(0, ["total", "terms", "lang_total"]).withColumn("p0", probability("0L", "total", "terms")))
    totals = scratch.put(totals, "totals")
    scored = scratch.put(of_source.join(totals.drop("l"), "g").select(
        "l", "g", *KEY, probability("n", "total", "terms").alias("p"), probability("n_lang", "lang_total", "terms").alias("q"), "p0"), "scored")
    return _divergent_terms(scored, totals, texts, scratch, p), _divergent_sources(scored, totals)


def _divergent_terms(scored: DataFrame, totals: DataFrame, texts: DataFrame, scratch: Scratch, p: Params) -> DataFrame:
    own = scored.where("p > q").select("g", *KEY, F.expr(excess("p", "q")).alias("value"))
    # the least value that can be reported, without strings; rows cut off before the shuffle by the limit on the row number
    least = scratch.put(own.withColumn("at", F.row_number().over(W.partitionBy("g").orderBy(F.desc("value")))).where(F.col("at") <= p.top)
                        .groupBy("g").agg(F.min("value").alias("least")), "least")
    reach = own.join(least, "g").where("value >= least").join(texts, KEY).select("g", F.col("term").alias("item"), "value")
    ranked = (reach.withColumn("rank", F.row_number().over(W.partitionBy("g").orderBy(F.desc("value"), "item")))
              .where(F.col("rank") <= p.top))
    return ranked.join(totals.select("g", "lang", "source"), "g").select("lang", "source", "item", "value", "rank")


def _divergent_sources(scored: DataFrame, totals: DataFrame) -> DataFrame:
    def side(name: str) -> DataFrame:
        return totals.select("l", F.col("g").alias(name), F.col("p0").alias(f"{name}0"), F.col("source").alias(f"{name}_source"), "lang", "terms")

    every = side("a").join(side("b").drop("lang", "terms"), "l").where("a <> b")
    bins = scored.groupBy("l", "g", "p", "p0").agg(F.count(F.lit(1)).alias("k"))
    met = bins.join(totals.select("l", F.col("g").alias("other"), F.col("p0").alias("other0")), "l").where("g <> other")
    f = excess
    single = met.select(F.inline(F.array(
        F.struct(F.col("g").alias("a"), F.col("other").alias("b"), F.expr(f"k * ({f('p', 'other0')} - {f('p0', 'other0')})").alias("v")),
        F.struct(F.col("other").alias("a"), F.col("g").alias("b"), F.expr(f"k * ({f('other0', 'p')} - {f('other0', 'p0')})").alias("v")))))
    one = scored.select("l", *KEY, F.col("g").alias("a"), F.col("p").alias("pa"), F.col("p0").alias("a0"))
    two = scored.select("l", *KEY, F.col("g").alias("b"), F.col("p").alias("pb"), F.col("p0").alias("b0"))
    both = one.join(two, ["l", *KEY]).where("a < b").groupBy("a", "b").agg(
        F.sum(F.expr(f"{f('pa', 'pb')} - {f('pa', 'b0')} - {f('a0', 'pb')} + {f('a0', 'b0')}")).alias("v"),
        F.sum(F.expr(f"{f('pb', 'pa')} - {f('pb', 'a0')} - {f('b0', 'pa')} + {f('b0', 'a0')}")).alias("w"))
    common = both.select(F.inline(F.array(F.struct("a", "b", "v"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"), F.col("w").alias("v")))))
    rest = single.groupBy("a", "b").agg(F.sum("v").alias("v")).unionByName(common).groupBy("a", "b").agg(F.sum("v").alias("v"))
    value = F.expr(f"if(terms = 0, 0, terms * {f('a0', 'greatest(b0, 1)')}) + coalesce(v, 0)").cast("long")
    pairs = every.join(rest, ["a", "b"], "left").select("lang", F.col("a_source").alias("source"), F.col("b_source").alias("item"), value.alias("value"))
    return pairs.withColumn("rank", F.row_number().over(W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    terms, sources = audited(documents(spark, sf_dir))
    return terms.withColumn("part", F.lit("term")).unionByName(sources.withColumn("part", F.lit("pair"))).select(
        "lang", "source", "part", "item", "value", "rank")


ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
o AS MATERIALIZED (SELECT id, lang, source, unnest(w) AS t FROM d),
g AS MATERIALIZED (SELECT DISTINCT lang, source FROM d),
kept AS MATERIALIZED (SELECT lang, t, count(*) AS n FROM o GROUP BY lang, t HAVING count(DISTINCT id) >= 3),
c AS MATERIALIZED (
  SELECT g.lang, g.source, k.t, k.n AS nl, coalesce(x.n, 0) AS n
  FROM g JOIN kept k ON k.lang = g.lang
  LEFT JOIN (SELECT lang, source, t, count(*) AS n FROM o GROUP BY ALL) x ON x.lang = g.lang AND x.source = g.source AND x.t = k.t),
pq AS MATERIALIZED (
  SELECT lang, source, t, n,
    1 + (1000000000::HUGEINT * (n + 1)) // (sum(n) OVER (PARTITION BY lang, source) + count(*) OVER (PARTITION BY lang, source)) AS p,
    1 + (1000000000::HUGEINT * (nl + 1)) // (sum(nl) OVER (PARTITION BY lang, source) + count(*) OVER (PARTITION BY lang, source)) AS q
  FROM c),
term AS (
  SELECT lang, source, 'term' AS part, t AS item, ((p - q) * (p - q)) // q AS value,
    row_number() OVER (PARTITION BY lang, source ORDER BY ((p - q) * (p - q)) // q DESC, t) AS rank
  FROM pq WHERE n > 0 AND p > q QUALIFY rank <= 200),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM pq a JOIN pq b ON b.lang = a.lang AND b.t = a.t AND b.source <> a.source GROUP BY ALL),
pair AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value,
    row_number() OVER (PARTITION BY a.lang, a.source ORDER BY coalesce(s.value, 0) DESC, b.source) AS rank
  FROM g a JOIN g b ON b.lang = a.lang AND b.source <> a.source LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM (SELECT * FROM term UNION ALL SELECT * FROM pair)
"""
