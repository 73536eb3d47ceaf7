"""Benchmark decontamination: a BM25 index of the test items, searched by block-max WAND.

Words are lower-cased runs of letters and digits.  A test item is its question and its
answer (the last sentence; an item of one sentence is all question).  Items of more
than ``passage`` words are indexed in parts of that many.  A document is read as
passages of ``2 * passage`` words, one starting every ``passage`` words, so whatever
has up to ``passage`` words lies whole in some passage.  Every passage is a query.

Scores are BM25 with each part's weights divided by its own full score, so a passage
that holds the whole part scores 1 and one threshold fits all parts.  A passage is
dropped when the sum of its words' largest weights, and then the sum of their largest
weights within every block of parts, stay below the threshold; block-max WAND searches
the rest and returns every part at or above it.  A hit counts when at least ``overlap``
of the five-word shingles of the whole item occur in the passage, or of those of the
question and of the answer.  A side of under 29 words is measured by shorter shingles, too,
down to words, so short that one changed word spoils no more than a fifth of them (a side
of two to four words may lack one word); its overlap is the larger of the two.

The index goes to the executors only in shards of about ``shard_bytes`` of item text.  Postings and
block maxima are flat arrays with an entry only where a part or block holds the term, so an index
takes at most some tens of bytes a word of its items (and 1 MB), whatever its vocabulary; each
shard is one pass over the documents.
Edge cases: null or blank texts have no passage; a null or blank item matches nothing;
equal items match alike; repeated documents are one (doc_id, item_id) row, with their
best passage; a null doc_id or item_id is kept as a null.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
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
    passage: int = 64
    threshold: float = 0.6
    overlap: float = 0.8
    k: int = 5
    k1: float = 1.2
    b: float = 0.75
    block: int = 4                # parts in a block of the index
    shard_bytes: int = 4 << 20    # of item text broadcast at once


_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")


def question_answer(text: str) -> tuple[str, str]:
    """The item's text before its last sentence, and that sentence (empty if there is one only)."""
    sentences = [s for s in _SENTENCE.split(text) if any(c.isalnum() for c in s)]
    return (" ".join(sentences[:-1]), sentences[-1]) if len(sentences) > 1 else (" ".join(sentences), "")


def _lower(texts: pa.Array) -> pa.Array:
    return pc.utf8_lower(texts.cast(pa.large_string()).fill_null("")).cast(pa.large_binary())


def _word_hashes(text: str) -> np.ndarray:
    a = _lower(pa.array([text]))
    return np.concatenate([np.zeros(0, np.uint64), *(textkit.words(buf, offs, textkit.NOT_ALNUM)[3] for _, _, buf, offs in textkit.pieces(a))])


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k-word shingles of a word sequence."""
    return textkit.shingles(np.zeros(len(h), np.int64), h, 1, k)[1] if len(h) >= k else h[:0]


@dataclass
class Postings:
    """(place, weight) entries by term, each term's in order of place."""
    start: np.ndarray                       # of each term's entries, and the end of the last
    at: np.ndarray
    weight: np.ndarray

    def __getitem__(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        lo, hi = self.start[term], self.start[term + 1]
        return self.at[lo:hi], self.weight[lo:hi]

    def find(self, term: int, place: int, lo: int) -> int:
        """The first entry of ``term`` from ``lo`` on that is not before ``place``."""
        return bisect_left(self.at, place, lo, int(self.start[term + 1]))

    def weight_at(self, term: int, place: int) -> float:
        i = self.find(term, place, int(self.start[term]))
        return float(self.weight[i]) if i < self.start[term + 1] and self.at[i] == place else 0.0


@dataclass
class Index:
    """Postings by term in part order, with the largest weight of each term and of each block of parts that holds it."""
    vocab: np.ndarray                       # sorted word hashes
    seen: np.ndarray                        # bitmap over the top bits of a hash
    posts: Postings                         # by part
    top: np.ndarray                         # of each term
    block_top: Postings                     # by block
    item: np.ndarray                        # of each part
    parts: np.ndarray                       # number of each item's
    whole: list[tuple[int, np.ndarray]]         # of each item: shingle length and hashes
    sides: list[list[tuple[float, list[tuple[int, np.ndarray]]]]]   # of each item: for question and answer the share needed, and their measures
    block: int


def build_index(items: list[tuple[int, str | None]], p: Params) -> Index:
    parts, part_item, whole, sides = [], [], [], []
    for n, (_, text) in enumerate(items):
        text = text or ""
        h = _word_hashes(text)
        for at in range(0, len(h), p.passage):
            parts.append(h[at:at + p.passage])
            part_item.append(n)
        whole.append((min(p.k, len(h)), np.unique(grams(h, min(p.k, len(h))))) if len(h) else (p.k, h))
        own = []
        for side in question_answer(text):
            w = _word_hashes(side)
            if len(w):
                # a changed word spoils k of the n - k + 1 shingles
                few = max(1, min(p.k, int((len(w) + 1) * (1 - p.overlap) / (2 - p.overlap) + 1e-9)))
                need = min(p.overlap, 1 - 1 / len(w)) if len(w) > 1 else p.overlap
                own.append((need, [(k, np.unique(grams(w, k))) for k in sorted({few, min(p.k, len(w))})]))
        sides.append(own)
    vocab = np.unique(np.concatenate([np.zeros(0, np.uint64), *parts]))
    mean = sum(map(len, parts)) / max(1, len(parts))
    tf = [np.unique(np.searchsorted(vocab, x), return_counts=True) for x in parts]
    df = np.bincount(np.concatenate([np.zeros(0, np.int64), *(t for t, _ in tf)]), minlength=len(vocab))
    idf = np.log(1 + (len(parts) - df + 0.5) / (df + 0.5))
    lengths = np.array([len(t) for t, _ in tf], np.int64)
    part = np.repeat(np.arange(len(parts)), lengths)
    term, c = (np.concatenate([np.zeros(0, np.int64), *(x[i] for x in tf)]) for i in (0, 1))
    w = idf[term] * c * (p.k1 + 1) / (c + p.k1 * (1 - p.b + p.b * np.array([len(x) for x in parts])[part] / mean)) if len(part) else np.zeros(0)
    w = w / np.bincount(part, w, len(parts))[part]          # a part's own words score 1
    order = np.argsort(term, kind="stable")                 # parts stay in order within a term
    term, part, w = term[order], part[order], w[order]
    posts = Postings(np.searchsorted(term, np.arange(len(vocab) + 1)), part.astype(np.int32), w)
    block = part // p.block
    first = np.flatnonzero(np.r_[True, (term[1:] != term[:-1]) | (block[1:] != block[:-1])][:len(term)])
    # rounded up, so that a bound stays one
    block_top = np.nextafter(np.maximum.reduceat(w, first).astype(np.float32), np.float32(2)) if len(first) else np.zeros(0, np.float32)
    blocks = Postings(np.searchsorted(term[first], np.arange(len(vocab) + 1)), block[first].astype(np.int32), block_top)
    top = np.maximum.reduceat(block_top, blocks.start[:-1]) if len(vocab) else np.zeros(0, np.float32)
    seen = np.zeros(1 << 20, bool)
    seen[(vocab >> np.uint64(44)).astype(np.int64)] = True
    item = np.array(part_item, np.int32)
    return Index(vocab, seen, posts, top, blocks, item, np.bincount(item, minlength=len(items)), whole, sides, p.block)


def block_max_wand(ix: Index, terms: list[int], threshold: float) -> list[tuple[int, float]]:
    """Every (part, score) of at least the threshold, for the distinct terms of a passage."""
    end = len(ix.item)
    posts, ends = ix.posts, ix.posts.start
    cursors = [[int(posts.at[ends[t]]), int(ends[t]), t] for t in terms]      # part, entry in the postings, term
    out = []

    def advance(c, part):
        c[1] = posts.find(c[2], part, c[1])
        c[0] = int(posts.at[c[1]]) if c[1] < ends[c[2] + 1] else end

    while True:
        cursors.sort()
        bound, pivot = 0.0, -1
        for i, c in enumerate(cursors):
            if c[0] == end:
                break
            bound += float(ix.top[c[2]])
            if bound >= threshold:
                pivot = i
                break
        if pivot < 0:
            return out
        part = cursors[pivot][0]
        while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == part:
            pivot += 1
        block = part // ix.block
        if sum(ix.block_top.weight_at(c[2], block) for c in cursors[:pivot + 1]) < threshold:
            # no part of this block up to the next cursor can reach it
            past = (block + 1) * ix.block
            if pivot + 1 < len(cursors):
                past = min(past, cursors[pivot + 1][0])
            for c in cursors[:pivot + 1]:
                advance(c, max(past, part + 1))
        elif cursors[0][0] == part:
            score = sum(float(posts.weight[c[1]]) for c in cursors[:pivot + 1])
            if score >= threshold:
                out.append((part, score))
            for c in cursors[:pivot + 1]:
                advance(c, part + 1)
        else:
            for c in cursors[:pivot]:
                if c[0] < part:
                    advance(c, part)


def block_reach(ix: Index, passages: list[np.ndarray], threshold: float, room: int = 1 << 20) -> np.ndarray:
    """Of each passage (its distinct terms): whether the largest weights within some block of parts sum to the
    threshold.  Only entries of the passages' own terms are read, about ``room`` at a time."""
    blocks = -(-len(ix.item) // ix.block)
    size = ix.block_top.start[1:] - ix.block_top.start[:-1]
    out = np.zeros(len(passages), bool)
    lo = 0
    while lo < len(passages):
        hi, entries = lo, 0
        while hi < len(passages) and (hi == lo or (entries < room and (hi - lo) * blocks < room)):
            entries += int(size[passages[hi]].sum())
            hi += 1
        terms = np.concatenate(passages[lo:hi])
        n = size[terms]
        entry = np.arange(n.sum()) + np.repeat(ix.block_top.start[terms] - (np.cumsum(n) - n), n)
        row = np.repeat(np.repeat(np.arange(hi - lo), [len(t) for t in passages[lo:hi]]), n)
        sums = np.bincount(row * blocks + ix.block_top.at[entry], ix.block_top.weight[entry], (hi - lo) * blocks)
        out[lo:hi] = sums.reshape(hi - lo, blocks).max(1) >= threshold
        lo = hi
    return out


def _share(measure: tuple[int, np.ndarray], window: np.ndarray) -> float:
    k, own = measure
    return float(np.isin(own, grams(window, k)).mean())


def _slice_hits(ix: Index, p: Params, buf: np.ndarray, offs: np.ndarray):
    """(document, item, score, question overlap, answer overlap) of each confirmed passage of a slice."""
    _, _, doc, h = textkit.words(buf, offs, textkit.NOT_ALNUM)
    if not len(h) or not len(ix.vocab):
        return
    first = np.searchsorted(doc, doc)                      # of the word's document
    place = np.arange(len(doc)) - first
    # half-passages are numbered through the slice, with a gap after each document
    half = place // p.passage + np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(offs) - 1) // p.passage + 2)])[doc]
    known = np.flatnonzero(ix.seen[(h >> np.uint64(44)).astype(np.int64)])
    term = np.searchsorted(ix.vocab, h[known])
    ok = ix.vocab[np.minimum(term, len(ix.vocab) - 1)] == h[known]
    known, term = known[ok], term[ok]
    pair = np.unique(half[known] * np.int64(len(ix.vocab)) + term)
    at, term = pair // len(ix.vocab), pair % len(ix.vocab)
    n_half = int(half[-1]) + 2
    starts = np.searchsorted(half, np.arange(n_half + 1))
    cuts = np.searchsorted(at, np.arange(n_half + 1))
    again = np.zeros(len(pair), bool)                      # the word is in the next half, too
    again[np.searchsorted(pair, np.intersect1d(pair + len(ix.vocab), pair, assume_unique=True) - len(ix.vocab))] = True

    eps = 1e-4
    if not len(pair):
        return
    weights = ix.top[term]
    sums = np.bincount(at, weights, n_half + 1)
    # of each passage, two halves: the sum over its distinct words
    bound = sums[:-1] + sums[1:] - np.bincount(at[again], weights[again], n_half + 1)[:-1]
    reach = np.flatnonzero((bound >= p.threshold - eps) & (np.diff(starts) > 0))
    asked = [np.unique(term[cuts[a]:cuts[a + 2]]) for a in reach.tolist()]
    near = block_reach(ix, asked, p.threshold - eps)
    for a, terms in ((a, t) for a, t, ok in zip(reach.tolist(), asked, near.tolist()) if ok):
        best = {}
        for part, score in block_max_wand(ix, terms.tolist(), p.threshold - eps):
            n = int(ix.item[part])
            best[n] = max(score, best.get(n, 0.0))
        if not best:
            continue
        lo = int(starts[a])
        d = int(doc[lo])
        last = int(np.searchsorted(doc, d, "right"))
        for n, score in best.items():
            # a cut item is looked for around its part, any other in the passage
            longest = p.passage * int(ix.parts[n])
            window = h[max(int(first[lo]), lo - longest + p.passage):min(last, lo + p.passage + longest)]
            share = [max(_share(m, window) for m in measures) for _, measures in ix.sides[n]]
            if share and (all(s >= need - 1e-9 for s, (need, _) in zip(share, ix.sides[n])) or _share(ix.whole[n], window) >= p.overlap):
                yield d, n, score, share[0], share[1] if len(share) > 1 else None


def _shards(items: DataFrame, p: Params) -> list[list[tuple[int, str | None]]]:
    """The items in shards of about ``shard_bytes`` of text, fetched one shard at a time."""
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(total / p.shard_bytes))
    for i in range(n):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i).select("item_id", "text").collect()
        yield sorted(map(tuple, rows), key=lambda x: (x[0] is None, x[0] or 0, x[1] or ""))


def _searched(index, ids, p: Params, keep_clean: bool):
    def run(batches):
        ix = index.value
        for b in batches:
            low = _lower(b.column(b.schema.get_field_index("text")))
            found = [(lo + d, *rest) for lo, _, buf, offs in textkit.pieces(low) for d, *rest in _slice_hits(ix, p, buf, offs)]
            if keep_clean:
                clean = np.ones(b.num_rows, bool)
                clean[[f[0] for f in found]] = False
                yield b.filter(pa.array(clean))
            else:
                rows = [f[0] for f in found]
                yield pa.RecordBatch.from_arrays(
                    [b.column(b.schema.get_field_index("doc_id")).take(pa.array(rows, pa.int64())), pa.array([ids[f[1]] for f in found], pa.int64()),
                     *(pa.array([f[i] for f in found], pa.float64()) for i in (2, 3, 4))],
                    names=["doc_id", "item_id", "score", "question_overlap", "answer_overlap"])
    return run


def leaks(docs: DataFrame, items: DataFrame, p: Params = Params()) -> DataFrame:
    """doc_id, item_id, score, question_overlap, answer_overlap of every document that holds a test item."""
    spark = docs.sparkSession
    ship(spark)
    out = None
    for shard in _shards(items, p):
        index = spark.sparkContext.broadcast(build_index(shard, p))
        found = docs.select("doc_id", "text").mapInArrow(
            _searched(index, [i for i, _ in shard], p, False), "doc_id long, item_id long, score double, question_overlap double, answer_overlap double")
        out = found if out is None else out.unionByName(found)
    best = out.groupBy("doc_id", "item_id").agg(F.max(F.struct("score", "question_overlap", "answer_overlap")).alias("m"))
    return best.select("doc_id", "item_id", F.round("m.score", 6).alias("score"), "m.question_overlap", "m.answer_overlap")


def without_leaks(docs: DataFrame, items: DataFrame, p: Params = Params()) -> DataFrame:
    """The rows of ``docs``, all columns, whose text holds no test item."""
    spark = docs.sparkSession
    ship(spark)
    for shard in _shards(items, p):
        index = spark.sparkContext.broadcast(build_index(shard, p))
        docs = docs.mapInArrow(_searched(index, None, p, True), docs.schema)
    return docs


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
