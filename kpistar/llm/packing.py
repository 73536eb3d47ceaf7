"""Packing along a space-filling curve.

Every document becomes its token ids and an end id.  Its ids are counted into ``width``
hashed, signed cells; the vector of damped counts is brought to length 1 and projected on
``axes`` fixed random directions.  Mean and deviation of each axis over all documents place
a document on a grid of 2**``bits`` cells an axis, the grid cell's place on the Hilbert
curve is its key.  Documents are range-sorted by key (a written table: encoded once, and a
lost executor's tasks read it again), and each range is cut along the curve into sequences
of ``length`` ids, so a sequence holds neighbours.  What is left at the end of a range is cut
into sequences of powers of two, which need no padding: none is ever padded.

Ids come from the tokenizers library's file.  ``ranks`` names the same vocabulary as ranks
(checked when read), by which another library gives the same ids several times faster;
texts with a character outside ``SETTLED``, whose class may depend on a library's version of
Unicode, go by the file itself, as do all texts where ``ranks`` is None.

A range is a task's rows in key order; documents with equal keys are told apart by a row
number, so that copies, even a third of all rows, split over ranges like any others.  Within
a task at most one open sequence and one Arrow batch are held.  Sequence ids are the range's
number and a count within it.  On their way ids take two bytes each if the vocabulary allows.

Edge cases: a null text is empty (one id, the end id); a document of any length is cut into
as many sequences as it needs; repeated rows and ids are separate documents; a null doc_id
stays null; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import base64
import json
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from kpistar.llm.shared import Scratch, documents, ship
from kpistar.llm.tokencount import SETTLED


@dataclass(frozen=True)
class Params:
    tokenizer: str = public_tokenizers.path("byte_bpe_50k.json")
    ranks: str | None = public_tokenizers.path("byte_bpe_50k.tiktoken")
    length: int = 1024
    end_id: int = 0
    width: int = 256
    axes: int = 5
    bits: int = 10
    seed: int = 11


# ---------------------------------------------------------------- ids

def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: printable ones themselves, the rest from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Ids:
    """Text -> numpy uint32 ids, special strings as the tokenizer file's library treats them by default."""

    def __init__(self, spec: str, ranks: bytes | None):
        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.fast = None
        parsed = json.loads(spec)
        added, pre = parsed["added_tokens"], parsed["pre_tokenizer"] or {}
        plain = not parsed["normalizer"] and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
        if ranks and plain and not any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added):
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
            letters, special = byte_letters(), {t["content"]: t["id"] for t in added}
            if {bytes(letters[c] for c in t): i for t, i in parsed["model"]["vocab"].items() if t not in special} != table:
                raise ValueError("the ranks are not the tokenizer's vocabulary")
            self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens=special)
            self.unsettled = regex.compile(f"[^{SETTLED}]")

    def width(self, p: Params) -> str:
        return "<u2" if max(self.tokenizer.get_vocab_size() - 1, p.end_id, *self.tokenizer.get_vocab().values()) < 1 << 16 else "<u4"

    def __call__(self, text: str) -> np.ndarray:
        if self.fast is None or self.unsettled.search(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
        return self.fast.encode_to_numpy(text, allowed_special="all")


@lru_cache(maxsize=1)
def _ids(spec: str, ranks: bytes | None) -> Ids:
    return Ids(spec, ranks)


# ---------------------------------------------------------------- the curve

@lru_cache(maxsize=1)
def _projection(p: Params) -> np.ndarray:
    return np.random.default_rng(p.seed).normal(size=(p.width, p.axes))


def hashed(ids: np.ndarray, p: Params) -> np.ndarray:
    """The hashed vector of a document: signed cell counts, damped, of length 1."""
    h = (ids.astype(np.uint64) + np.uint64(p.seed)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    sign = (h >> np.uint64(63)).astype(np.float64) * 2 - 1
    v = np.bincount(((h >> np.uint64(32)) % np.uint64(p.width)).astype(np.int64), sign, p.width)
    v = np.sign(v) * np.sqrt(np.abs(v))
    norm = np.sqrt((v * v).sum())
    return v / norm if norm else v


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """The place on the Hilbert curve of grid cells (n, axes): Skilling's transposed form, then interleaved."""
    x = [c.copy() for c in cells.astype(np.int64).T]
    for b in range(bits - 1, 0, -1):
        low = (1 << b) - 1
        for c in x:
            inside = (c >> b) & 1 == 1
            swap = np.where(inside, 0, (x[0] ^ c) & low)
            first = np.where(inside, x[0] ^ low, x[0] ^ swap)
            if c is x[0]:
                x[0][:] = first
            else:
                c ^= swap
                x[0][:] = first
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> b) & 1 == 1, (1 << b) - 1, 0)
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for c in x:
            key = key << 1 | ((c ^ turn) >> b) & 1
    return key


def _key(mean: np.ndarray, deviation: np.ndarray, p: Params):
    def run(at: pd.Series) -> pd.Series:
        if not len(at):
            return pd.Series([], dtype="int64")
        z = (np.stack(at.to_numpy()) - mean) / deviation
        cells = (1 << p.bits) / (1 + np.exp(-1.702 * np.clip(z, -20, 20)))       # about the share of documents below
        return pd.Series(hilbert(np.minimum(cells.astype(np.int64), (1 << p.bits) - 1), p.bits))
    return F.pandas_udf(run, "long")


# ---------------------------------------------------------------- Spark

def _encoded(source, width: str, p: Params):
    def run(batches):
        ids, directions = _ids(*source.value), _projection(p)
        for b in batches:
            for lo in range(0, len(b), 1024):
                part = b.slice(lo, 1024)
                found = [np.append(ids(t.as_py() or ""), np.uint32(p.end_id)) for t in part.column(1)]
                at = np.array([hashed(x, p) for x in found]) @ directions
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(x) for x in found], pa.int64()), pa.array([x.astype(width).tobytes() for x in found], pa.binary()),
                     pa.array(list(at.astype(np.float32)), pa.list_(pa.float32()))], names=["doc_id", "doc_tokens", "ids", "at"])
    return run


def powers(n: int) -> list[int]:
    """n as a sum of falling powers of two."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


def _cut(length: int, width: str):
    """The pieces of a range's documents, in the order they come."""
    def run(batches):
        number, fill, open_, part, kind = 0, 0, [], 0, pa.int64()
        names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]

        def rows(pieces):
            cols = list(zip(*pieces))
            types = [kind, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

        for b in batches:
            done, kind = [], b.schema.field(0).type
            for doc, n, ids, part in zip(*(b.column(i).to_pylist() for i in range(4))):
                start, ids = 0, np.frombuffer(ids, width).astype("<u4").tobytes()
                while start < n:
                    size = min(n - start, length - fill)
                    open_.append((doc, start, size, ids[4 * start:4 * (start + size)], n, part << 36 | number, fill))
                    start, fill = start + size, fill + size
                    if fill == length:
                        done += open_
                        number, fill, open_ = number + 1, 0, []
            if done:
                yield rows(done)
        # the open sequence of the range's end: sequences of powers of two
        tail, at = [], 0
        for size in powers(fill):
            for doc, start, n, ids, whole, _, offset in open_:
                lo, hi = max(offset, at), min(offset + n, at + size)
                if lo < hi:
                    tail.append((doc, start + lo - offset, hi - lo, ids[4 * (lo - offset):4 * (hi - offset)], whole, part << 36 | number, lo - at))
            number, at = number + 1, at + size
        if tail:
            yield rows(tail)
    return run


def packed(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """The pieces of all documents (doc_id, text): doc_id, start, length, ids (binary, little-endian
    unsigned 32-bit), doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    ship(spark)
    with open(p.tokenizer, encoding="utf-8") as f:
        spec = f.read()
    ranks = None
    if p.ranks:
        with open(p.ranks, "rb") as f:
            ranks = f.read()
    width = _ids(spec, ranks).width(p)  # what does not fit together fails here
    source = spark.sparkContext.broadcast((spec, ranks))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text").mapInArrow(_encoded(source, width, p), f"doc_id {id_type}, doc_tokens long, ids binary, at array<float>")
    rows = Scratch(spark, "packing").put(rows.withColumn("row", F.monotonically_increasing_id()), "encoded")
    measured = rows.agg(*[f(F.col("at")[i].cast("double")) for f in (F.avg, F.stddev_pop) for i in range(p.axes)]).first()
    mean, deviation = (np.array([x or 0.0 for x in part]) for part in (measured[:p.axes], measured[p.axes:]))
    key = _key(mean, np.where(deviation > 0, deviation, 1.0), p)
    along = (rows.select("doc_id", "doc_tokens", "ids", "row", key("at").alias("key")).repartitionByRange("key", "row")
             .sortWithinPartitions("key", "row").select("doc_id", "doc_tokens", "ids", F.spark_partition_id().cast("long").alias("range")))
    return along.mapInArrow(_cut(p.length, width), f"doc_id {id_type}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


def sequences(pieces: DataFrame, p: Params = Params(), pad_id: int = 0) -> DataFrame:
    """sequence_id, ids (binary) of every sequence: its pieces in order, padded to the length unless
    a power of two.  A sequence has at most ``length`` pieces, so no group is large."""
    joined = pieces.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("s"))
    ids = F.expr("aggregate(s, cast('' as binary), (a, x) -> concat(a, x.ids))")
    size = F.expr("cast(octet_length(ids) / 4 as int)")
    missing = F.when(F.bit_count(size) == 1, 0).otherwise(F.lit(p.length) - size)
    pad = F.unhex(F.repeat(F.lit(pad_id.to_bytes(4, "little").hex()), missing))
    return joined.select("sequence_id", ids.alias("ids")).select("sequence_id", F.concat("ids", pad).alias("ids"))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(documents(spark, sf_dir)).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
