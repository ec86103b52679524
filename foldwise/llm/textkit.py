"""Words and rolling hashes of many texts at once, in numpy.

A task gets its texts as Arrow batches. ``pieces`` cuts a batch into runs of
whole texts of a bounded number of bytes, and ``Words`` finds all words of
such a run without a Python loop over words: a word is a maximal run of bytes
outside ``\\x20\\x09-\\x0D``, which are the same bytes in every UTF-8 text.

Hashes are 64 bits wide: a polynomial over the bytes (prefix sums modulo 2**64,
so any byte range costs one subtraction), finished by a bit mixer. They depend
on the bytes alone, so any task on any executor computes the same value.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 20

_U = np.uint64
_R = _U(0x9E3779B97F4A7C15 | 1)
_RINV = _U(pow(int(_R), -1, 1 << 64))
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.int64).astype(_U) * _U(2) + _U(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE_LOWER = _BYTE[_LOWER]
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: bytes that begin a code point
LEAD = (np.arange(256) & 0xC0) != 0x80


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.ones(n, _U)
    if n > 1:
        out[1:] = base
        np.multiply.accumulate(out, out=out)
    return out


_POW: list[np.ndarray] = [_powers(_R, 1 << 12), _powers(_RINV, 1 << 12)]


def _power_tables(n: int) -> list[np.ndarray]:
    if len(_POW[0]) < n:
        _POW[:] = [_powers(_R, n), _powers(_RINV, n)]
    return [p[:n] for p in _POW] if n <= 1 << 23 else [_powers(_R, n), _powers(_RINV, n)]


def release() -> None:
    """Give freed memory back to the system: a Python worker outlives its task
    and would keep it beside the next one's. Power tables that a long text has made go, too."""
    if len(_POW[0]) > 1 << 12:
        _POW[:] = [_powers(_R, 1 << 12), _powers(_RINV, 1 << 12)]
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """Bit mixer on uint64 (a bijection)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def spread(doc: np.ndarray) -> np.ndarray:
    """A random-looking uint64 for each small integer."""
    return mix((doc.astype(_U) + _U(1)) * _R)


def buffers(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary array; a null is an empty text."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if len(arr) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if arr.null_count:
        arr = arr.fill_null("" if pa.types.is_string(arr.type) or pa.types.is_large_string(arr.type) else b"")
    wide = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    _, off, data = arr.buffers()
    offsets = np.frombuffer(off, np.int64 if wide else np.int32)[arr.offset : arr.offset + len(arr) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(offsets: np.ndarray, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts hold at most ``limit`` bytes, or one text each."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi
        lo = hi


class Words:
    """The words of the texts ``lo..hi`` of a batch."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lo: int, hi: int):
        self.off = offsets[lo : hi + 1] - offsets[lo]
        self.data = data[offsets[lo] : offsets[hi]]
        self.n_docs = hi - lo
        n = len(self.data)
        solid = ~SPACE[self.data]
        self.solid = solid
        cut = np.zeros(n + 1, bool)
        cut[self.off] = True
        edge = np.empty(n + 1, bool)
        edge[0] = edge[n] = True
        edge[1:n] = ~solid[:-1]
        before = edge | cut  # nothing of the same word stands left of i
        self.start = np.flatnonzero(solid & before[:n])
        after = np.ones(n + 1, bool)
        after[: n - 1 if n else 0] = ~solid[1:]
        after = after[:n] | cut[1:]
        self.end = np.flatnonzero(solid & after) + 1
        self.first = np.searchsorted(self.start, self.off)  # index of each text's first word; one more at the end
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(self.n_docs), self.count)

    def sums(self, lower: bool = False) -> np.ndarray:
        """Prefix sums of the byte polynomial."""
        out = np.zeros(len(self.data) + 1, _U)
        np.cumsum((_BYTE_LOWER if lower else _BYTE)[self.data] * _power_tables(len(self.data))[0], out=out[1:])
        return out

    def range_hash(self, start: np.ndarray, end: np.ndarray, sums: np.ndarray) -> np.ndarray:
        """Hash of the bytes start..end, for each pair."""
        back = _power_tables(len(self.data) + 1)[1]
        return mix((sums[end] - sums[start]) * back[start] + (end - start).astype(_U))

    def hashes(self, lower: bool = False) -> np.ndarray:
        return self.range_hash(self.start, self.end, self.sums(lower))


def windows(h: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the n-word windows that stay inside one text, index of the
    first word of each)."""
    total = len(h)
    if total < n:
        return np.zeros(0, _U), np.zeros(0, np.int64)
    g = np.zeros(total - n + 1, _U)
    c = _U(1)
    for j in range(n):
        c = _U(int(c) * int(_R) % (1 << 64))
        g += h[j : total - n + 1 + j] * c
    ok = np.ones(total - n + 1, bool)
    for j in range(1, n):  # a window that begins less than n words before a later text's first word
        at = first[1:-1] - j
        ok[at[(at >= 0) & (at < len(ok))]] = False
    # texts of fewer than n words: their windows begin before their own end too
    at = np.flatnonzero(ok)
    if len(first) > 1:
        last = np.repeat(first[1:], np.diff(first))[at]
        at = at[at + n <= last]
    return mix(g[at]), at


def repeated(keys: np.ndarray) -> np.ndarray:
    """True where a key stands at least twice."""
    n = len(keys)
    out = np.zeros(n, bool)
    if n < 2:
        return out
    bits = max(10, int(n - 1).bit_length() + 3)
    slot = (keys >> _U(64 - bits)).astype(np.int64)
    maybe = np.flatnonzero(np.bincount(slot, minlength=1 << bits)[slot] > 1)
    if len(maybe):
        k = keys[maybe]
        order = np.argsort(k, kind="stable")
        s = k[order]
        same = s[1:] == s[:-1]
        dup = np.zeros(len(s), bool)
        dup[1:] = same
        dup[:-1] |= same
        out[maybe[order]] = dup
    return out


def runs(mask: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the maximal runs of True that stay inside one text."""
    n = len(mask)
    cut = np.zeros(n + 1, bool)
    cut[off] = True
    left = np.ones(n, bool)
    right = np.ones(n, bool)
    if n:
        left[1:] = ~mask[:-1]
        right[:-1] = ~mask[1:]
    return np.flatnonzero(mask & (left | cut[:n])), np.flatnonzero(mask & (right | cut[1:])) + 1


def count_words(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Number of words of each text."""
    out = [np.zeros(0, np.int64)]
    for lo, hi in pieces(off):
        o = off[lo:hi + 1] - off[lo]
        start, _ = runs(~SPACE[data[off[lo]:off[hi]]], o)
        out.append(np.diff(np.searchsorted(start, o)))
    return np.concatenate(out).astype(np.int64)


def word_count(text):
    """Column: number of words of a text, 0 for a null one."""
    from pyspark.sql import functions as F

    return F.arrow_udf(lambda t: pa.array(count_words(*buffers(t)), pa.int64()), "bigint")(text.cast("string"))
