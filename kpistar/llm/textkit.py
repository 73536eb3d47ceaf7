"""Vectorised word and shingle hashing over Arrow text batches (numpy, whole texts).

A batch of texts is one byte buffer with offsets.  Words are the maximal runs of
bytes other than ``\\x20`` and ``\\x09-\\x0D``; ``A-Z`` count as ``a-z``.  A word's
64-bit hash is the random-table polynomial of its bytes, a shingle's hash mixes the
hashes of its words in order.  Null texts are empty.  Buffers are cut into slices of
about ``SLICE`` bytes at document borders, so temporaries stay bounded; a document
longer than that is one slice, never cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE = 1 << 19

_rng = np.random.default_rng(20240229)
_TABLE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_TABLE[65:91] = _TABLE[97:123]  # A-Z hash as a-z
_SEP = np.zeros(256, bool)
_SEP[[9, 10, 11, 12, 13, 32]] = True
_P = int(_rng.integers(1, 2**62, dtype=np.uint64)) * 2 + 1
_PINV = pow(_P, -1, 2**64)
_MULTS = _rng.integers(1, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, SLICE + (SLICE >> 1)), base, np.uint64)
        have[0] = 1
        have = np.cumprod(have, dtype=np.uint64)
        if n <= 4 * SLICE:
            _powers[base] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift and multiply)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    """The column of that name, nulls as empty binary."""
    a = batch.column(batch.schema.get_field_index(name)).cast(pa.large_binary())
    return a.fill_null(b"") if a.null_count else a


def pieces(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of each slice of a large_binary array."""
    offs = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + SLICE, "right")) - 1)
        yield lo, hi, data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
        lo = hi


#: Separators for words of letters and digits only: every other ASCII byte.
NOT_ALNUM = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def words(buf: np.ndarray, offs: np.ndarray, sep: np.ndarray = _SEP) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document, hash) of every word of a slice, in text order."""
    n = len(buf)
    if not n:
        e = np.zeros(0, np.int64)
        return e, e, e, np.zeros(0, np.uint64)
    on = ~sep[buf]
    first = on.copy()
    first[1:] &= ~on[:-1]
    borders = offs[1:-1]
    borders = borders[borders < n]
    first[borders] |= on[borders]
    start = np.flatnonzero(first)
    last = on.copy()
    last[:-1] &= ~on[1:]
    inner = borders[borders > 0] - 1
    last[inner] |= on[inner]
    end = np.flatnonzero(last) + 1
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_TABLE[buf] * _power(_P, n), out=sums[1:])
    h = mix((sums[end] - sums[start]) * _power(_PINV, n)[start] + (end - start).astype(np.uint64))
    doc = np.searchsorted(offs, start, "right") - 1
    return start, end, doc, h


def shingles(doc: np.ndarray, h: np.ndarray, n_docs: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of every k-word shingle; a document of 1 to k-1 words has its whole sequence as one."""
    counts = np.bincount(doc, minlength=n_docs)
    if len(h) >= k:
        s = np.zeros(len(h) - k + 1, np.uint64)
        for j in range(k):
            s = mix(s + h[j:len(h) - k + 1 + j] * _MULTS[j])
        whole = doc[:len(s)] == doc[k - 1:]
        out_d, out_h = doc[:len(s)][whole], s[whole]
    else:
        out_d, out_h = doc[:0], h[:0]
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        at = np.concatenate([[0], np.cumsum(counts)])[short]
        extra = np.zeros(len(short), np.uint64)
        for j in range(k - 1):
            has = counts[short] > j
            extra[has] = mix(extra[has] + h[at[has] + j] * _MULTS[j])
        extra = mix(extra + counts[short].astype(np.uint64))
        out_d, out_h = np.concatenate([out_d, short]), np.concatenate([out_h, extra])
        order = np.argsort(out_d, kind="stable")
        out_d, out_h = out_d[order], out_h[order]
    return out_d, out_h


def shingle_sets(texts: pa.Array, k: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text, in row order."""
    for lo, hi, buf, offs in pieces(texts):
        _, _, doc, h = words(buf, offs)
        d, s = shingles(doc, h, hi - lo, k)
        cuts = np.searchsorted(d, np.arange(hi - lo + 1))
        for i in range(hi - lo):
            x = np.sort(s[cuts[i]:cuts[i + 1]])
            yield x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) > 1 else x
