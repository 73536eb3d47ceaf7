"""Substring dedup by compact windows.

A text is the sequence of its five-word shingles.  For a hash function, the compact window
of position c is the stretch around c in which c has the least hash: every subsequence
that lies in it and holds c has c's shingle as its min-hash.  The windows are the nodes of
the Cartesian tree over the hashes; it is grown level by level for all texts of a slice at
once (segment minima, then the two segments beside each), and only down to windows of
``min_words`` words, about 2n / min_words of n.

Windows of ``hashes`` functions are grouped by signature: function, shingle and the
``around`` shingles on either side of it (clipped at the ends of the text).  A signature
of any number of windows stays linear: each window meets the signature's representative
(of the smallest doc_id, so that the functions agree on it), found by a combined minimum
and a join that adaptive execution may split.  Windows that the comparison finds in one passage with
the representative's are its family; the others of the signature, whether or not they lie in passages
found elsewhere, meet in further rounds, each with the next representative of another family; a
window goes when the shingles around it that occur around the signature elsewhere are too
few for any passage, so that a common line ends there.  Windows that lie in passages already found with
one representative, at the same place of it, are of one family without another comparison.  After ``rounds`` such rounds
every window meets every other of its signature that is of another family or of none, which is
quadratic in those that are left.  For a pair of documents the windows are then joined as intervals:
where the windows of at least ``agree`` functions overlap in both texts, the texts are
compared, and stretches of ``min_words`` words or more whose shingle sets have a Jaccard
similarity of at least ``similarity`` are passages.  Links are between a passage and its
representative; documents linked through passages have one component_id.

A passage copied word by word is missed only if all functions but one have their least position
within ``around`` shingles of its ends: about 0.001 for 50 words, less for longer ones.
Edge cases: null and blank texts, and texts of under ``min_words`` words, have no
passage; a shingle that follows itself (one word over and over) counts once; repeats within
one document are no link, but each is a passage if another document holds it, too; rows that share a doc_id are one
document; a null doc_id links with nothing; words are as in ``textkit``.
"""

from __future__ import annotations

from collections import defaultdict
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpistar.llm import textkit
from kpistar.llm.shared import Scratch, components, documents, ship


@dataclass(frozen=True)
class Params:
    k: int = 5                 # words in a shingle
    min_words: int = 50
    similarity: float = 0.8
    hashes: int = 6
    agree: int = 2
    around: int = 4
    gap: int = 10              # shingles that differ within a passage (two changed words)
    rounds: int = 3            # further rounds with one representative, then every pair left

    @property
    def width(self) -> int:
        return self.min_words - self.k + 1


def compact_windows(order: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(left, centre, end) of the Cartesian tree nodes of at least ``width`` positions.

    ``order`` holds the hashes of several texts, text d at bounds[d]:bounds[d + 1]; equal
    hashes go by position.
    """
    bits = np.uint64(max(1, int(len(order)).bit_length()))
    packed = (order >> bits << bits) | np.arange(len(order), dtype=np.uint64)
    left, end = bounds[:-1].astype(np.int64), bounds[1:].astype(np.int64)
    found = []
    while True:
        wide = end - left >= width
        left, end = left[wide], end[wide]
        if not len(left):
            break
        cuts = np.empty(2 * len(left), np.int64)
        cuts[0::2], cuts[1::2] = left, end
        if cuts[-1] == len(packed):
            cuts = cuts[:-1]
        least = np.minimum.reduceat(packed, cuts)[0::2]
        centre = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        found.append((left, centre, end))
        sides = np.empty(2 * len(left), np.int64), np.empty(2 * len(left), np.int64)
        sides[0][0::2], sides[1][0::2] = left, centre
        sides[0][1::2], sides[1][1::2] = centre + 1, end
        left, end = sides
    if not found:
        e = np.zeros(0, np.int64)
        return e, e, e
    return tuple(np.concatenate(x) for x in zip(*found))


def _sequences(texts: pa.Array, k: int):
    """(first row, end row, shingle hashes, word of each, bounds of the rows) of each slice; a
    shingle equal to the one before it (a word said over and over) is left out."""
    for lo, hi, buf, offs in textkit.pieces(texts):
        _, _, doc, h = textkit.words(buf, offs)
        whole = np.bincount(doc, minlength=hi - lo) >= k
        keep = whole[doc] if len(doc) else np.zeros(0, bool)
        d, s = textkit.shingles(doc[keep], h[keep], hi - lo, k)
        place = np.arange(len(d)) - np.searchsorted(d, d)
        new = np.ones(len(d), bool)
        new[1:] = (s[1:] != s[:-1]) | (d[1:] != d[:-1])
        d, s, place = d[new], s[new], place[new]
        yield lo, hi, s, place, np.searchsorted(d, np.arange(hi - lo + 1))


def _in_turn(run):
    """``run`` over one batch at a time; what a batch took goes back before the next one comes."""
    def each(batches):
        for b in batches:
            yield from run([b])
            b = None
            pa.default_memory_pool().release_unused()
    return each


def _windows(p: Params):
    """(signature, doc_id, at) rows; at packs the function, the centre and the reach to either side."""
    mult = np.random.default_rng(13).integers(1, 2**63, p.hashes, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def run(batches):
        for b in batches:
            ids = b.column(0)
            for lo, hi, s, _, bounds in _sequences(textkit.column(b, "text"), p.k):
                mixed = textkit.mix(s)
                rows, sigs, ats = [], [], []
                for i in range(p.hashes):
                    left, centre, end = compact_windows(textkit.mix(mixed * mult[i]), bounds, p.width)
                    row = np.searchsorted(bounds, centre, "right") - 1
                    first, last = bounds[row], bounds[row + 1]
                    sig = np.full(len(centre), i + 1, np.uint64)
                    for step in range(-p.around, p.around + 1):
                        at = centre + step
                        inside = (at >= first) & (at < last)
                        sig = textkit.mix(sig + np.where(inside, mixed[np.where(inside, at, 0)], np.uint64(0)))
                    before, after = np.minimum(centre - left, 0x7FFF), np.minimum(end - 1 - centre, 0x7FFF)
                    rows.append(row + lo)
                    sigs.append(sig)
                    ats.append((np.int64(i) << 59) | ((centre - first) << 30) | (before << 15) | after)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(sigs).view(np.int64)), ids.take(pa.array(np.concatenate(rows))), pa.array(np.concatenate(ats))],
                    names=["sig", "doc_id", "at"])
    return run


def _tokens(p: Params):
    def run(batches):
        for b in batches:
            for lo, hi, s, place, bounds in _sequences(textkit.column(b, "text"), p.k):
                ends = pa.array(bounds, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), pa.ListArray.from_arrays(ends, s.view(np.int64)), pa.ListArray.from_arrays(ends, place.astype(np.int32))],
                    names=["doc", "tokens", "places"])
    return run


def agreeing(windows: list[tuple[int, int, int, int, int]], agree: int) -> list[tuple[int, int]]:
    """Where the intervals (function, left a, end a, left b, end b) of enough functions overlap in both
    texts: stretches of a, widened to the intervals that meet there."""
    out = []
    for shift, group in _by_offset(windows):
        marks = defaultdict(list)
        for w in group:
            marks[w[1]].append((1, w))
            marks[w[2]].append((0, w))
        live: dict[tuple, int] = {}
        for at in sorted(marks):
            for opens, w in sorted(marks[at]):                # intervals end before others begin
                if opens:
                    live[w] = w[0]
                    if len(set(live.values())) >= agree:
                        out.append((min(x[1] for x in live), max(x[2] for x in live)))
                else:
                    live.pop(w, None)
    merged: list[list[int]] = []
    for a, e in sorted(out):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], e)
        else:
            merged.append([a, e])
    return [tuple(x) for x in merged]


def _by_offset(windows):
    """The windows in groups of nearly the same alignment of a to b."""
    groups: list[tuple[int, list]] = []
    for w in sorted(windows, key=lambda w: w[5]):
        if groups and w[5] - groups[-1][0] <= 64:
            groups[-1][1].append(w)
            groups[-1] = (w[5], groups[-1][1])
        else:
            groups.append((w[5], [w]))
    return groups


def diagonal(a: np.ndarray, b: np.ndarray, offset: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions at which a equals b moved by ``offset``, in a and in b."""
    lo, hi = max(0, offset), min(len(a), len(b) + offset)
    match = lo + np.flatnonzero(a[lo:hi] == b[lo - offset:hi - offset]) if hi > lo else np.zeros(0, int)
    return match, match - offset


def anywhere(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of a whose shingle is in b, and its first place there."""
    order = np.argsort(b, kind="stable")
    place = order[np.minimum(np.searchsorted(b[order], a), len(b) - 1)]
    match = np.flatnonzero(b[place] == a)
    return match, place[match]


def passages(a: np.ndarray, b: np.ndarray, match: np.ndarray, place: np.ndarray, p: Params) -> list[tuple[int, int, int, int]]:
    """(start a, end a, start b, end b), in shingles, of the passages along positions that match."""
    where = np.zeros(len(a), int)
    where[match] = place
    out = []
    todo = np.split(match, np.flatnonzero(np.diff(match) > p.gap) + 1) if len(match) else []
    while todo:
        run = todo.pop()
        if run[-1] - run[0] + 1 < p.width:
            continue
        offset = where[run] - run
        near = run[np.abs(offset - np.sort(offset)[len(offset) // 2]) <= p.gap]
        s, e = near[0], near[-1] + 1
        bs, be = where[near].min(), where[near].max() + 1
        if e - s >= p.width and be - bs >= p.width:
            x, y = np.unique(a[s:e]), np.unique(b[bs:be])
            both = len(np.intersect1d(x, y, assume_unique=True))
            if both >= p.similarity * (len(x) + len(y) - both) - 1e-9:
                out.append((int(s), int(e), int(bs), int(be)))
                continue
        # not similar as a whole: its parts on either side of what differs most
        step = np.abs(np.diff(run)) + np.abs(np.diff(where[run]) - np.diff(run))
        if len(step) and step.max() > 1:
            cut = int(step.argmax()) + 1
            todo += [run[:cut], run[cut:]]
    return sorted(out)


FOUND = "a long, b long, sa long, ea long, sb long, eb long, xa long, ya long, xb long, yb long, ats array<bigint>, bts array<bigint>"


def _verified(p: Params, agree: int):
    """The passages of each pair in words (sa:ea, sb:eb) and shingles (xa:ya, xb:yb); ``ats`` and ``bts`` are the windows in it."""
    def run(batches):
        for b in batches:
            rows = defaultdict(list)
            wins, ta, tb, wa, wb = (b.column(b.schema.get_field_index(c)) for c in ("wins", "tokens_a", "tokens_b", "places_a", "places_b"))
            da, db = (b.column(b.schema.get_field_index(c)).to_pylist() for c in ("a", "b"))
            for n in range(len(b)):
                found, centres = [], []
                for w in wins[n].as_py():
                    i, ca, fa, ea = _unpacked(w["at_a"])
                    _, cb, fb, eb = _unpacked(w["at_b"])
                    f, e = min(fa, fb), min(ea, eb)       # on either side as far as both windows go
                    found.append((i, ca - f, ca + e + 1, cb - f, cb + e + 1, ca - cb))
                    centres.append((ca, cb, w["at_a"], w["at_b"]))
                if len({w[0] for w in found}) < agree:
                    continue
                x = ta[n].values.to_numpy().view(np.uint64)
                y = tb[n].values.to_numpy().view(np.uint64)
                u, v = wa[n].values.to_numpy(), wb[n].values.to_numpy()
                done = []
                for offset, s, e in _offsets(found):
                    if not _covered(done, s, e):
                        done += passages(x, y, *diagonal(x, y, offset), p)
                match = np.flatnonzero(np.isin(x, y))
                for s, e in agreeing(found, agree) if _more(match, done) else []:
                    if not _covered(done, s, e):            # words were put in or left out
                        # the windows bound the stretch from inside: widen it as far as a passage may go on
                        s, e = _widened(match, s, e, p)
                        if not _more(match[(match >= s) & (match < e)], [d for d in done if d[0] < e and s < d[1]]):
                            continue
                        done += [(s + s1, s + e1, s2, e2) for s1, e1, s2, e2 in passages(x[s:e], y, *anywhere(x[s:e], y), p)]
                for s1, e1, s2, e2 in done:
                    rows["a"].append(da[n])
                    rows["b"].append(db[n])
                    for name, at in (("sa", u[s1]), ("ea", u[e1 - 1] + p.k), ("sb", v[s2]), ("eb", v[e2 - 1] + p.k), ("xa", s1), ("ya", e1), ("xb", s2), ("yb", e2)):
                        rows[name].append(int(at))
                    inside = [w for w in centres if s1 <= w[0] < e1 and s2 <= w[1] < e2]
                    rows["ats"].append(sorted({w[2] for w in inside}))
                    rows["bts"].append(sorted({w[3] for w in inside}))
            names = ["a", "b", "sa", "ea", "sb", "eb", "xa", "ya", "xb", "yb", "ats", "bts"]
            yield pa.RecordBatch.from_arrays([pa.array(rows[c], pa.list_(pa.int64()) if c in ("ats", "bts") else pa.int64()) for c in names], names=names)
    return run


def _repeats(p: Params):
    """The further copies, in a representative, of its passages: around the other windows of a verified signature."""
    def run(batches):
        for b in batches:
            rows = defaultdict(list)
            ids, todo, tokens, places = (b.column(b.schema.get_field_index(c)) for c in ("b", "todo", "tokens", "places"))
            for n in range(len(b)):
                y, v = tokens[n].values.to_numpy().view(np.uint64), places[n].values.to_numpy()
                done = defaultdict(list)                  # of each passage
                for w in todo[n].as_py():
                    centre, stretch = _unpacked(w["at_b"])[1], y[w["xb"]:w["yb"]]
                    copies = done[w["xb"], w["yb"]]
                    for at in w["others"]:
                        c = _unpacked(at)[1]
                        if any(s <= c < e for s, e in copies):
                            continue
                        lo, hi = max(0, c - (centre - w["xb"]) - 2 * p.gap), min(len(y), c + w["yb"] - centre + 2 * p.gap)
                        near = y[lo:hi]
                        found = passages(stretch, near, *diagonal(stretch, near, centre - w["xb"] - (c - lo)), p) if hi > lo else []
                        if hi > lo and all(e - s < len(stretch) for _, _, s, e in found):
                            found += passages(stretch, near, *anywhere(stretch, near), p)
                        copies += [(lo + s, lo + e) for _, _, s, e in found]
                for s, e in sorted({x for copies in done.values() for x in copies}):
                    for name, x in (("b", ids[n].as_py()), ("sb", int(v[s])), ("eb", int(v[e - 1]) + p.k)):
                        rows[name].append(x)
            yield pa.RecordBatch.from_arrays([pa.array(rows[c], pa.int64()) for c in ("b", "sb", "eb")], names=["b", "sb", "eb"])
    return run


def _offsets(found) -> list[tuple[int, int, int]]:
    """(offset, start, end) of the stretches of a with one alignment, the most windows first."""
    by = defaultdict(list)
    for w in found:
        by[w[5]].append(w)
    return [(o, min(w[1] for w in ws), max(w[2] for w in ws)) for o, ws in sorted(by.items(), key=lambda x: (-len(x[1]), x[0]))]


def _more(match: np.ndarray, done) -> bool:
    """Whether a free comparison could add to the passages found: a shingle outside them matches, or two may be one."""
    for s, e, _, _ in done:
        match = match[(match < s) | (match >= e)]
    return len(done) > 1 or len(match) > 0


def _covered(done, s: int, e: int) -> bool:
    return any(a <= s and e <= b for a, b, _, _ in done)


def _unpacked(at: int) -> tuple[int, int, int, int]:
    return at >> 59, at >> 30 & 0x1FFFFFFF, at >> 15 & 0x7FFF, at & 0x7FFF


def _widened(match: np.ndarray, s: int, e: int, p: Params) -> tuple[int, int]:
    """The stretch together with the positions beside it that match, over gaps of ``gap``."""
    inside = np.flatnonzero((match >= s) & (match < e))
    if not len(inside):
        return s, e
    lo, hi = inside[0], inside[-1]
    breaks = np.flatnonzero(np.diff(match) > p.gap)
    lo = breaks[breaks < lo].max(initial=-1) + 1
    hi = breaks[breaks >= hi].min(initial=len(match) - 1)
    return int(min(s, match[lo])), int(max(e, match[hi] + 1))


def _contexts(p: Params):
    """(sig, doc_id, at, open, start, near) rows: the shingles around a window's centre, the first at ``start`` from it."""
    reach = p.width + 3 * p.gap                # beyond ``width + gap``, as far as words put in or left out may move them

    def run(batches):
        for b in batches:
            ids, wins = b.column(0), b.column(b.schema.get_field_index("wins"))
            for lo, hi, s, _, bounds in _sequences(textkit.column(b, "text"), p.k):
                short = textkit.mix(s).view(np.int64).astype(np.int32)
                rows = defaultdict(list)
                for n in range(lo, hi):
                    first, end = int(bounds[n - lo]), int(bounds[n - lo + 1])
                    for w in wins[n].as_py():
                        centre = first + _unpacked(w["at"])[1]
                        if centre < end:
                            left = max(first, centre - reach)
                            for name, x in (("sig", w["sig"]), ("row", n), ("at", w["at"]), ("open", w["open"]), ("start", left - centre),
                                            ("near", short[left:min(end, centre + reach + 1)])):
                                rows[name].append(x)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows["sig"], pa.int64()), ids.take(pa.array(rows["row"], pa.int64())), pa.array(rows["at"], pa.int64()), pa.array(rows["open"], pa.bool_()),
                     pa.array(rows["start"], pa.int32()), pa.array(rows["near"], pa.list_(pa.int32()))],
                    names=["sig", "doc_id", "at", "open", "start", "near"])
    return run


def _hopeful(scratch: Scratch, docs: DataFrame, members: DataFrame, name: str, p: Params) -> DataFrame:
    """``members`` without the open windows that can be in no passage: those around whose centre fewer than
    ``width`` shingles, over gaps of ``gap``, occur around that signature in any other document."""
    by_doc = members.groupBy("doc_id").agg(F.collect_list(F.struct("sig", "at", "open")).alias("wins"))
    near = scratch.put(docs.join(by_doc.hint("merge"), "doc_id").select("doc_id", "text", "wins")
                       .mapInArrow(_in_turn(_contexts(p)), "sig long, doc_id long, at long, open boolean, start int, near array<int>"), f"near-{name}")
    met = (near.select("sig", "doc_id", F.explode("near").alias("s")).groupBy("sig", "s")
           .agg(F.min("doc_id").alias("x"), F.max("doc_id").alias("y")).where("x <> y").select("sig", "s"))
    own = near.where("open").select("sig", "doc_id", "at", "start", F.posexplode("near").alias("i", "s")).selectExpr("sig", "doc_id", "at", "s", "start + i as pos")
    reach = p.width + p.gap
    # the places of a window are bits of a few numbers, which an aggregation holds in fixed space
    words = 2 * reach // 64 + 1
    bits = own.where(F.col("pos").between(-reach, reach)).join(met, ["sig", "s"]).selectExpr("sig", "doc_id", "at", f"pos + {reach} as bit").groupBy("sig", "doc_id", "at").agg(
        *[F.bit_or(F.expr(f"if(bit div 64 = {i}, shiftleft(1L, cast(bit % 64 as int)), 0L)")).alias(f"w{i}") for i in range(words)])
    held = F.expr(f"array({', '.join(f'w{i}' for i in range(words))})")
    places = bits.withColumn("w", held).withColumn("r", F.expr(f"""transform(filter(sequence(0, {2 * reach}),
        x -> (shiftrightunsigned(w[cast(x div 64 as int)], cast(x % 64 as int)) & 1L) = 1L), x -> x - {reach})"""))
    run = F.expr(f"""aggregate(r, 0, (e, x) -> if(x > e and x - e <= {p.gap}, x, e))
                     - aggregate(reverse(r), 0, (s, x) -> if(x < s and s - x <= {p.gap}, x, s)) + 1""")
    return places.where(run >= p.width).select("sig", "doc_id", "at").withColumn("hope", F.lit(True))


#: Batches of texts or token lists, and shuffled bytes of a task, that stay small beside an executor's memory.
SMALL = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2048", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m"}


@contextmanager
def _small_tasks(spark: SparkSession):
    """Steps written in here run in more, smaller tasks: rows of distinct shingles take several times
    their shuffled bytes in an aggregation's table, and two tasks share an executor."""
    before = {k: spark.conf.get(k, None) for k in SMALL}
    try:
        for k, v in SMALL.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def shared_passages(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """(a, b, sa, ea, sb, eb): words sa:ea of document a and sb:eb of its representative b are near-duplicates.

    Rows with a = b are further copies of a passage in the representative itself."""
    spark = docs.sparkSession
    ship(spark)
    scratch = Scratch(spark, "substrings")
    docs = docs.select("doc_id", "text").where("doc_id is not null and text is not null")
    with _small_tasks(spark):
        return _shared_passages(scratch, docs, p)


def _shared_passages(scratch: Scratch, docs: DataFrame, p: Params) -> DataFrame:
    windows = docs.mapInArrow(_in_turn(_windows(p)), "sig long, doc_id long, at long")
    common = windows.groupBy("sig").agg(F.min("doc_id").alias("b"), F.max("doc_id").alias("last")).where("b <> last").select("sig", "b")
    members = scratch.put(windows.join(common, "sig").withColumn("family", F.lit(None).cast("int")).withColumn("homes", F.lit(None).cast(HOMES)), "members-0")
    scratch.release()

    def paired(met: DataFrame, agree: int) -> DataFrame:
        return (met.groupBy("a", "b").agg(F.collect_list(F.struct("at_a", "at_b")).alias("wins"))
                .where(F.size(F.array_distinct(F.transform("wins", lambda w: F.shiftright(w["at_a"], 59)))) >= agree))

    def compared(pairs: DataFrame, n: int, agree: int) -> DataFrame:
        pairs = scratch.put(pairs, f"pairs-{n}")
        scratch.release()
        wanted = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
        tokens = scratch.put(docs.join(wanted.hint("merge"), "doc_id", "left_semi").mapInArrow(_in_turn(_tokens(p)), "doc long, tokens array<bigint>, places array<int>"), f"tokens-{n}")
        both = (pairs.join(tokens.selectExpr("doc as a", "tokens as tokens_a", "places as places_a"), "a")
                .join(tokens.selectExpr("doc as b", "tokens as tokens_b", "places as places_b"), "b"))
        out = scratch.put(both.select("a", "b", "wins", "tokens_a", "tokens_b", "places_a", "places_b").mapInArrow(_in_turn(_verified(p, agree)), FOUND), f"found-{n}")
        scratch.drop(f"pairs-{n}", f"tokens-{n}")
        scratch.release()
        return out

    def whole(found: DataFrame) -> DataFrame:
        """With all copies that the representatives hold, not only the one that was compared."""
        again = scratch.spark.read.schema("b long, at_b long, others array<bigint>").parquet(*(f"{scratch.base}/again-{i}" for i in range(turns)))
        todo = (found.select("b", F.explode("bts").alias("at_b"), "xb", "yb").distinct().join(again, ["b", "at_b"])
                .groupBy("b").agg(F.collect_list(F.struct("at_b", "xb", "yb", "others")).alias("todo")))
        todo = scratch.put(todo, "todo")
        out = found.select("a", "b", "sa", "ea", "sb", "eb")
        if todo.isEmpty():
            return out
        tokens = docs.join(todo.select(F.col("b").alias("doc_id")).hint("merge"), "doc_id", "left_semi").mapInArrow(_in_turn(_tokens(p)), "doc long, tokens array<bigint>, places array<int>").withColumnRenamed("doc", "b")
        more = todo.join(tokens, "b").select("b", "todo", "tokens", "places").mapInArrow(_in_turn(_repeats(p)), "b long, sb long, eb long").distinct()
        return out.unionByName(more.selectExpr("b as a", "b", "sb as sa", "eb as ea", "sb", "eb"))

    found, n, turns = None, 0, 0
    while True:
        # a pair may meet by its second function in a later round only: there, one is enough
        agree = p.agree if not n else 1
        reps = (members.where("doc_id = b").groupBy("sig").agg(F.min(F.struct("at", "family", "homes")).alias("r"))
                .selectExpr("sig", "r.at as at_b", "r.family as family_b", "r.homes as homes_b"))
        scratch.put(members.where("doc_id = b").groupBy("sig", "b").agg(F.min("at").alias("at_b"), F.collect_set("at").alias("ats")).where("size(ats) > 1")
                    .select("b", "at_b", F.array_except("ats", F.array("at_b")).alias("others")), f"again-{n}")
        turns += 1
        met = scratch.put(members.where("doc_id <> b").join(reps, "sig").where(APART)
                          .selectExpr("doc_id as a", "b", "at as at_a", "at_b", f"{_same_home(p)} as known"), f"met-{n}")
        new = compared(paired(met.where("not known"), agree), n, agree)
        linked = (new.select(F.col("a").alias("doc_id"), F.explode("ats").alias("at")).union(met.where("known").select("a", "at_a"))
                  .distinct().withColumn("linked", F.lit(True)))
        found = new if found is None else found.unionByName(new)
        # what is left: all but the representatives' windows; those linked with one are its family
        family = F.expr(f"if(linked, coalesce(family_b, {n}), if(doc_id = b, coalesce(family, family_b, {n}), family))")
        left = (members.join(reps, "sig").where("doc_id <> b or at <> at_b").join(linked, ["doc_id", "at"], "left").select("sig", "doc_id", "at", family.alias("family")))
        n += 1
        left = scratch.put(_with_homes(_alive(left, "sig", "doc_id", "at", "family"), found), f"homes-{n}")
        left = scratch.put(_alive(_settled(left, n, p), "sig", "doc_id", "at", "family", "homes"), f"left-{n}")
        scratch.drop(f"members-{n - 1}", f"met-{n - 1}", f"homes-{n}")
        scratch.release()
        if left.isEmpty():
            return whole(found)
        hope = _hopeful(scratch, docs, left.withColumn("open", F.lit(True)), str(n), p)
        members = scratch.put(_alive(left.join(hope, ["sig", "doc_id", "at"], "left_semi"), "sig", "doc_id", "at", "family", "homes", "b"), f"members-{n}")
        scratch.drop(f"near-{n}", f"left-{n}")
        scratch.release()
        if members.isEmpty():
            return whole(found)
        if n > p.rounds:
            other = members.select("sig", F.col("doc_id").alias("b"), F.col("at").alias("at_b"), F.col("family").alias("family_b"), F.col("homes").alias("homes_b"))
            met = (members.drop("b").join(other, "sig").where("doc_id > b").where(APART).where(f"not {_same_home(p)}")
                   .select(F.col("doc_id").alias("a"), "b", F.col("at").alias("at_a"), "at_b"))
            return whole(found.unionByName(compared(paired(met, 1), n, 1)))


#: Two windows of a signature of which no comparison with one representative has found both in its passage.
APART = "family is null or family_b is null or family <> family_b"


#: Where a window lies: its own place, and that place in each representative with which its text there is linked.
HOMES = "array<struct<b:bigint,pos:bigint>>"


def _with_homes(windows: DataFrame, found: DataFrame) -> DataFrame:
    """``windows`` with their ``homes``, by the passages found so far."""
    spans = found.groupBy(F.col("a").alias("doc_id")).agg(F.collect_set(F.struct("b", "xa", "ya", "xb")).alias("spans"))
    centre = f"(shiftright(at, 30) & {0x1FFFFFFF})"
    own = f"array(struct(doc_id as b, {centre} as pos))"
    there = f"transform(filter(spans, s -> s.xa <= {centre} and {centre} < s.ya), s -> struct(s.b as b, s.xb + {centre} - s.xa as pos))"
    return windows.join(spans, "doc_id", "left").withColumn("homes", F.expr(f"if(spans is null, {own}, concat({own}, {there}))").cast(HOMES)).drop("spans")


def _same_home(p: Params) -> str:
    """Whether two windows lie in passages of one representative, at the same place but for words put in or left out."""
    return f"coalesce(exists(homes, x -> exists(homes_b, y -> x.b = y.b and abs(x.pos - y.pos) <= {2 * p.gap})), false)"


def _settled(windows: DataFrame, n: int, p: Params) -> DataFrame:
    """``windows`` with those at home where the least of their signature is as its family, before their surroundings are laid out."""
    least = windows.groupBy("sig").agg(F.min(F.struct("doc_id", "at", "family", "homes")).alias("r")).selectExpr("sig", "r.family as family_b", "r.homes as homes_b")
    family = F.expr(f"if({_same_home(p)}, coalesce(family_b, {-n}), family)")
    return windows.join(least, "sig").select("sig", "doc_id", "at", family.alias("family"), "homes")


def _alive(members: DataFrame, *columns: str) -> DataFrame:
    """The windows of signatures of two documents or more that are not all of one family, with the least of them as b."""
    alive = (members.groupBy("sig").agg(F.min("doc_id").alias("b"), F.max("doc_id").alias("last"), F.max(F.col("family").isNull()).alias("loose"),
                                        F.min("family").alias("low"), F.max("family").alias("high")).where("b <> last and (loose or low <> high)"))
    return members.join(alive.select("sig", "b"), "sig").select(*columns)


def repeated(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """One row per document with a repeated passage: doc_id, component_id, n_words, passages.

    ``passages`` lists the word ranges start:end, merged and comma-joined; ``n_words`` is
    their length; ``component_id`` the smallest doc_id reachable through shared passages.
    """
    scratch = Scratch(docs.sparkSession, "passages")
    found = scratch.put(shared_passages(docs, p), "found")
    comp = components(scratch, found.select(F.col("a").alias("u"), F.col("b").alias("v")))
    ranges = (found.select(F.col("a").alias("doc_id"), F.col("sa").alias("s"), F.col("ea").alias("e"))
              .union(found.select("b", "sb", "eb")).distinct().groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("s", "e"))).alias("r")))
    merged = F.expr("""aggregate(r, cast(array() as array<struct<s:bigint,e:bigint>>), (out, x) ->
        if(size(out) > 0 and x.s <= out[size(out) - 1].e,
           concat(slice(out, 1, size(out) - 1), array(struct(out[size(out) - 1].s as s, greatest(out[size(out) - 1].e, x.e) as e))),
           concat(out, array(struct(x.s as s, x.e as e)))))""")
    return (ranges.select("doc_id", merged.alias("m")).join(comp, F.col("doc_id") == F.col("node"))
            .select("doc_id", F.col("component").alias("component_id"), F.expr("aggregate(m, 0L, (n, x) -> n + x.e - x.s)").alias("n_words"),
                    F.expr("array_join(transform(m, x -> concat(x.s, ':', x.e)), ',')").alias("passages")))


def op2_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated(documents(spark, sf_dir))
