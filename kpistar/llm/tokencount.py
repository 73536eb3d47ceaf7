"""Token counts by a map-side two-tier lookup of pre-token lengths.

A byte-level BPE tokenizer cuts a text into pre-tokens and encodes each by itself, so a
text's count is the sum over its pre-tokens.  Tier one is a compact hash table of the
lengths of frequent pre-tokens, counted on at most about ``sample_rows`` documents
(chosen by hash), at most ``table_entries`` of them, and broadcast.  Tier two is a bounded
cache in each worker; what neither has is encoded there by the library.  Pre-tokens
are never shuffled.

Special strings of the tokenizer inside a text count as their one token, as in the
library's default.  A text with a character outside ``SETTLED`` (where Unicode versions
could class characters differently) is counted by the library as a whole.  Edge
cases: a null text is empty (0 bytes, 0 tokens); texts of any length are counted whole.
Only tokenizers with a byte-level pre-tokenizer, its usual pattern and no normalizer are
supported (checked when the file is read).
"""

from __future__ import annotations

import hashlib
import json
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from kpistar.llm.shared import documents, ship

#: Fixed value: the pre-token pattern of byte-level tokenizers.
PATTERN = public_tokenizers.PATTERN
#: Characters whose letter, number and space classes have been the same for many versions of Unicode.
SETTLED = "\x00-ɏΑ-ΡΣ-ϿЀ-ҁ‐-‧‰-⁞€ぁ-ゔァ-ヶ㐀-䶵一-龥가-힣"


@dataclass(frozen=True)
class Params:
    tokenizer: str = public_tokenizers.path("byte_bpe_50k.json")
    limit: int = 1024
    sample_rows: int = 2000
    table_entries: int = 50_000
    cached: int = 160_000          # pre-tokens of each worker, in two halves; the older half goes when the newer is full
    longest_cached: int = 48


class Counts(dict):
    """Pre-token -> number of tokens: the frequent ones, then what this worker has encoded."""

    def __init__(self, data: str, frequent: dict[str, int], p: Params):
        spec = json.loads(data)
        pre = spec["pre_tokenizer"] or {}
        if spec["normalizer"] or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True):
            raise ValueError("only byte-level tokenizers without a normalizer are supported")
        super().__init__(frequent)
        self.p, self.frequent, self.older = p, frequent, {}
        self.tokenizer = Tokenizer.from_str(data)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        added = [t for t in spec["added_tokens"]]
        self.plain_specials = all(not (t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]) for t in added)
        names = sorted((t["content"] for t in added), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, names))) if names else None
        self.cut = regex.compile(PATTERN)
        self.unsettled = regex.compile(f"[^{SETTLED}]")

    def __missing__(self, token: str) -> int:
        n = self.older.get(token)
        if n is None:
            n = len(self.tokenizer.encode(token, add_special_tokens=False).ids)
        if len(token) <= self.p.longest_cached:
            if len(self) >= len(self.frequent) + self.p.cached // 2:
                # what the last half of the cache has not used goes
                self.older = dict(self)
                self.clear()
                self.update(self.frequent)
            self[token] = n
        return n

    def count(self, text: str) -> int:
        if self.unsettled.search(text) or not self.plain_specials:
            return len(self.tokenizer.encode(text, add_special_tokens=False).ids)
        if self.special and self.special.search(text):
            parts = self.special.split(text)
            return len(parts) - 1 + sum(map(self.__getitem__, (x for part in parts for x in self.cut.findall(part))))
        return sum(map(self.__getitem__, self.cut.findall(text)))


@lru_cache(maxsize=2)
def _loaded(key: str, p: Params, source) -> Counts:
    return Counts(*source.value, p)


class _Held:
    """A broadcast that equals any other, so that the cache goes by its digest alone."""

    def __init__(self, source):
        self.source = source

    @property
    def value(self):
        return self.source.value

    def __hash__(self):
        return 0

    def __eq__(self, other):
        return isinstance(other, _Held)


def _frequent_of(keep: int):
    """The most frequent pre-tokens of a partition, with their counts."""
    def run(batches):
        cut, seen = regex.compile(PATTERN), Counter()
        for b in batches:
            for text in b.column(0).to_pylist():
                seen.update(cut.findall(text or ""))
        top = seen.most_common(keep)
        yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], names=["t", "n"])
    return run


def frequent_pretokens(docs: DataFrame, p: Params = Params()) -> list[str]:
    """At most ``table_entries`` pre-tokens, of a sample of about ``sample_rows`` documents."""
    total = docs.count()
    some = docs.select("text")
    if total > p.sample_rows:
        some = some.where(F.pmod(F.xxhash64("text"), F.lit(total)) < p.sample_rows)
    rows = (some.mapInArrow(_frequent_of(p.table_entries), "t string, n long").groupBy("t").agg(F.sum("n").alias("n"))
            .orderBy(F.desc("n"), "t").limit(p.table_entries).collect())
    return [r["t"] for r in rows if len(r["t"]) <= p.longest_cached]


def _counted(source, key: str, p: Params):
    def run(batches):
        counts = _loaded(key, p, _Held(source))
        for b in batches:
            texts = b.column(1)
            bytes_, tokens = [], []
            for i in range(len(b)):
                text = texts[i].as_py() or ""
                tokens.append(counts.count(text))
                bytes_.append(len(text.encode()))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(bytes_, pa.int64()), pa.array(tokens, pa.int64()), pa.array([n > p.limit for n in tokens], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])
    return run


def counted(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select("doc_id", "text")
    with open(p.tokenizer, encoding="utf-8") as f:
        data = f.read()
    lengths = Counts(data, {}, p)
    table = {t: lengths[t] for t in frequent_pretokens(docs, p)}
    key = hashlib.md5((data + repr(sorted(table.items()))).encode()).hexdigest()
    source = spark.sparkContext.broadcast((data, table))
    return docs.mapInArrow(_counted(source, key, p), "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counted(documents(spark, sf_dir))
