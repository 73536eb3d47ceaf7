"""SentencePiece BPE: encoding by a merge-type prefix table, and decoding.

A BPE token sequence is the encoding of its text exactly if each neighbouring pair is
compatible, that is, encoding the pair's own text gives the pair.  So every prefix of a
text has one possible last token: of the pieces that an Aho-Corasick automaton finds
ending there, the one whose own start is the text's or whose predecessor (the last token
of the prefix before it) is compatible.  The table is filled left to right and the ids are
read from its end backwards.  Characters that are in no piece become byte pieces.

Texts are cut only where no piece can lie across: before a run of spaces, around line
breaks and between a letter and a mark that no piece has after a letter.  Repeated units
come from a bounded cache of each worker; the missing ones of a text are encoded in one
pass, a line break between them (an end of a prefix, as it is in no piece).  The pair test
undoes the merges of both pieces from the last one back (equal scores, as of runs of
spaces, merge from the left).  Decoding looks the ids up in a table of piece bytes.

Edge cases: a null text is empty and has the begin and end ids alone; a literal U+2581
counts as a space, as in the library; texts of any length are encoded whole.  The model
must be BPE with an identity normaliser and a dummy prefix (checked when it is read).
"""

from __future__ import annotations

import hashlib
import re
from array import array
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from kpistar.llm.shared import documents, ship

SPACE = "▁"


@dataclass(frozen=True)
class Params:
    model: str = public_tokenizers.path("piece_bpe_32k.model")
    cached_units: int = 160_000     # of each worker, in two halves; the older half goes when the newer is full
    longest_cached: int = 48
    cached_pairs: int = 200_000


def _fields(data: bytes):
    """(number, value) of the fields of a protobuf message."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            value = varint()
        else:
            size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
            value = data[at:at + size]
            at += size
        yield key >> 3, value


class Pieces:
    """Encoder and decoder of one model."""

    def __init__(self, serialized: bytes, p: Params):
        sp = sentencepiece.SentencePieceProcessor(model_proto=serialized)
        message = dict(_fields(serialized))
        trainer, normalizer = dict(_fields(message.get(2, b""))), dict(_fields(message.get(3, b"")))
        n = sp.get_piece_size()
        texts = [sp.id_to_piece(i) for i in range(n)]
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) for i in range(n)]
        inner = re.compile(f"[^{SPACE}]{SPACE}|\n.|.\n", re.S)
        if (trainer.get(3) != 2 or normalizer.get(2) or normalizer.get(3, 1) != 1 or normalizer.get(4, 1) != 0 or any(sp.is_unused(i) for i in range(n))
                or any(inner.search(t) for t, s in zip(texts, special) if not s)):
            raise ValueError("only BPE models with an identity normaliser, a dummy prefix and no piece across words are supported")
        self.p = p
        self.begin, self.end, self.unknown = sp.bos_id(), sp.eos_id(), sp.unk_id()
        self.text = texts
        self.ids = {t: i for i, (t, s) in enumerate(zip(texts, special)) if not s}
        self.score = [sp.get_score(i) for i in range(n)]
        self.byte = {int(texts[i][3:5], 16): i for i in range(n) if sp.is_byte(i)}
        self.splits: dict[int, tuple] = {}
        self.automaton = ahocorasick.Automaton()
        for t, i in self.ids.items():
            if self._split(i) != (-1, -1):          # the piece's own text is encoded as the piece
                self.automaton.add_word(t, (i, len(t)))
        self.automaton.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.units: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.cut = self._cuts()
        self.raw = [b"" if sp.is_control(i) else bytes([int(t[3:5], 16)]) if sp.is_byte(i) else t.replace(SPACE, " ").encode() for i, t in enumerate(texts)]
        self.silent = {i for i in range(n) if sp.is_control(i)}
        self.raw[self.unknown] = " ⁇ ".encode()
        self.length = [len(t) for t in texts]

    def _cuts(self) -> re.Pattern:
        """A unit: spaces and what follows them, up to a border that no piece lies across."""
        letters = {c for t in self.ids for c in t if c.isalpha()}
        marks = {chr(i) for i in range(33, 127) if not chr(i).isalnum()}
        marks -= {b for t in self.ids for a, b in zip(t, t[1:]) if a in letters}
        if not (letters and marks):
            return re.compile(f"{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+|\n")
        letter, mark = (re.escape("".join(sorted(x))) for x in (letters, marks))
        return re.compile(f"(?:{SPACE}+|[^{SPACE}\n])[^{SPACE}\n{mark}]*(?:(?<![{letter}])[{mark}][^{SPACE}\n{mark}]*)*|\n")

    def _split(self, a: int) -> tuple[int, int] | None:
        """The two pieces whose merge makes a piece; None for a character, (-1, -1) if merges never give the piece."""
        known = self.splits.get(a)
        if known is None:
            parts = list(self.text[a])
            known = ()
            while len(parts) > 1:
                best, at = None, -1
                for i in range(len(parts) - 1):
                    both = self.ids.get(parts[i] + parts[i + 1])
                    if both is not None and (best is None or self.score[both] > best):
                        best, at = self.score[both], i
                if best is None:
                    known = (-1, -1)
                    break
                if len(parts) == 2:
                    known = tuple(self.ids.get(x, -1) for x in parts)
                parts[at:at + 2] = [parts[at] + parts[at + 1]]
            self.splits[a] = known
        return known or None

    def compatible(self, a: int, b: int) -> bool:
        """Whether the text of both is encoded as the two pieces.

        Merges are undone from the last one back, of whichever side it was; at no time
        may the two pieces at the border have merged before the merge undone last.
        """
        score, text = self.score, self.text
        before, ties = None, False                  # merges across the border must come after this score
        while True:
            across = self.ids.get(text[a] + text[b])
            if across is not None and (before is None or score[across] > before or ties and score[across] == before):
                return False
            left, right = self._split(a), self._split(b)
            if left is None and right is None:
                return True
            # the later merge has the lower score; among equals the right one is later
            if right is None or left is not None and score[a] < score[b]:
                before, ties = score[a], False
                a = left[1]
            else:
                before, ties = score[b], True
                b = right[0]
            if a < 0 or b < 0:                      # a character that is no piece merges with nothing here
                return True

    def encode_unit(self, unit: str) -> list[int]:
        """The ids of a stretch of text that no piece leaves, by the prefix table."""
        return self._encode_all([unit])[0]

    def _encode_all(self, units: list[str]) -> list[list[int]]:
        """The ids of each unit, by one prefix table over all of them."""
        text = "\n".join(units)
        last = [-1] * (len(text) + 1)               # by the prefix's last character; -1: no piece ends there (nor in the empty prefix, at -1)
        pairs, compatible = self.pairs, self.compatible
        for at, (piece, length) in self.automaton.iter(text):
            if last[at] < 0:
                before = last[at - length]
                if before < 0:
                    last[at] = piece
                else:
                    key = before << 20 | piece
                    fits = pairs.get(key)
                    if fits is None:
                        fits = pairs[key] = compatible(before, piece)
                    if fits:
                        last[at] = piece
        found, end, length = [], -1, self.length
        for unit in units:
            out, start = [], end
            i = end = end + len(unit) + 1
            while i - 1 > start:
                piece = last[i - 1]
                if piece >= 0:
                    out.append(piece)
                    i -= length[piece]
                else:
                    i -= 1
                    out.extend([self.byte[x] for x in reversed(text[i].encode())])
            out.reverse()
            found.append(out)
        if len(pairs) > self.p.cached_pairs:
            pairs.clear()
        return found

    def _missing(self, units: list[str]) -> dict[str, bytes]:
        """The ids of units that the newer half of the cache does not have."""
        found, new = {}, []
        for u in units:
            known = self.older.get(u)
            if known is None:
                new.append(u)
            else:
                found[u] = known
        while new:
            # a table over about 65536 characters at most, or one unit
            size, n = 0, 0
            while n < len(new) and (not n or size + len(new[n]) < 65536):
                size += len(new[n]) + 1
                n += 1
            found.update(zip(new[:n], [array("I", x).tobytes() for x in self._encode_all(new[:n])]))
            new = new[n:]
        for u, known in found.items():
            if len(u) <= self.p.longest_cached:
                if len(self.units) >= self.p.cached_units // 2:
                    # what the last half of the cache has not used goes
                    self.units, self.older = {}, self.units
                self.units[u] = known
        return found

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers, without begin and end ids."""
        if not text:
            return b""
        units = self.cut.findall(SPACE + text.replace(" ", SPACE))
        ids = list(map(self.units.get, units))
        if None in ids:
            found = self._missing(list({u: None for u, known in zip(units, ids) if known is None}))
            ids = [found[u] if known is None else known for u, known in zip(units, ids)]
        return b"".join(ids)

    def decode(self, ids: list[int]) -> str:
        """The text of ids; begin, end and other control ids are silent, invalid bytes become U+FFFD."""
        lo, hi = 0, len(ids)
        while lo < hi and ids[lo] in self.silent:
            lo += 1
        while hi > lo and ids[hi - 1] in self.silent:
            hi -= 1
        if lo == hi:
            return ""
        parts = [[]]
        if self.silent.isdisjoint(ids[lo:hi]):
            parts = [ids[lo:hi]]
        else:                                       # a control id ends a run of byte pieces
            for i in ids[lo:hi]:
                if i in self.silent:
                    parts.append([])
                else:
                    parts[-1].append(i)
        text = "".join(_lenient(b"".join(map(self.raw.__getitem__, x))) for x in parts)
        return text[1:] if self.text[ids[lo]].startswith(SPACE) else text


def _lenient(data: bytes) -> str:
    """UTF-8 with one U+FFFD for each byte that is not part of a valid character."""
    out = []
    while data:
        try:
            out.append(data.decode())
            break
        except UnicodeDecodeError as e:
            out.append(data[:e.start].decode() + "�")
            data = data[e.start + 1:]
    return "".join(out)


@lru_cache(maxsize=2)
def _loaded(digest: str, p: Params, source) -> Pieces:
    return Pieces(source.value, p)


def _model(spark: SparkSession, p: Params):
    """The model file (its size does not depend on the data) as a broadcast, and its digest."""
    with open(p.model, "rb") as f:
        data = f.read()
    return spark.sparkContext.broadcast(data), hashlib.md5(data).hexdigest()


class _Held:
    """A broadcast that hashes by the model's digest, so that a worker reads a model once."""

    def __init__(self, source):
        self.source = source

    @property
    def value(self):
        return self.source.value

    def __hash__(self):
        return 0

    def __eq__(self, other):
        return isinstance(other, _Held)


def _digests(source, digest: str, p: Params):
    def run(batches):
        model = _loaded(digest, p, _Held(source))
        begin, end = (np.array([x], "<u4").tobytes() for x in (model.begin, model.end))
        for b in batches:
            counts, ids_sha, text_sha = [], [], []
            for i in range(len(b)):
                text = b.column(1)[i].as_py() or ""
                ids = begin + model.encode(text) + end
                counts.append(len(ids) // 4)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                text_sha.append(hashlib.sha256(model.decode(np.frombuffer(ids, "<u4").tolist()).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                                             names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return run


def _encoded(source, digest: str, p: Params):
    def run(batches):
        model = _loaded(digest, p, _Held(source))
        begin, end = (np.array([x], "<u4").tobytes() for x in (model.begin, model.end))
        for b in batches:
            text = b.column(b.schema.get_field_index("text"))
            ids = [begin + model.encode(text[i].as_py() or "") + end for i in range(len(b))]
            ends = np.cumsum([0, *(len(x) // 4 for x in ids)]).astype(np.int32)
            values = np.frombuffer(b"".join(ids), "<i4")
            yield pa.RecordBatch.from_arrays([*b.columns, pa.ListArray.from_arrays(ends, values)], names=[*b.schema.names, "ids"])
    return run


def _decoded(source, digest: str, p: Params):
    def run(batches):
        model = _loaded(digest, p, _Held(source))
        for b in batches:
            ids = b.column(b.schema.get_field_index("ids")).to_pylist()
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([None if x is None else model.decode(x) for x in ids], pa.string())], names=[*b.schema.names, "decoded"])
    return run


def encoded(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """``docs`` with ``ids`` (array<int>, begin and end ids included) of ``text``; a column ``ids`` of ``docs`` is replaced."""
    ship(docs.sparkSession)
    docs = docs.drop("ids")
    schema = T.StructType([*docs.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return docs.mapInArrow(_encoded(*_model(docs.sparkSession, p), p), schema)


def decoded(rows: DataFrame, p: Params = Params()) -> DataFrame:
    """``rows`` with the text ``decoded`` of ``ids``; a column ``decoded`` of ``rows`` is replaced."""
    ship(rows.sparkSession)
    rows = rows.drop("decoded")
    return rows.mapInArrow(_decoded(*_model(rows.sparkSession, p), p), T.StructType([*rows.schema.fields, T.StructField("decoded", T.StringType())]))


def digests(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row of ``docs`` (doc_id, text)."""
    ship(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(
        _digests(*_model(docs.sparkSession, p), p), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op8_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(documents(spark, sf_dir))
