"""Whole texts as byte arrays: words, hashes and windows by numpy.

An Arrow batch holds its texts as one byte buffer with offsets. The functions
here work on that buffer directly, for all texts of a chunk at once: no Python
string is made per word. A chunk holds whole texts only, so nothing is cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; a longer text is a chunk of its own.
CHUNK = 1 << 20
#: Odd 64-bit base of the rolling hash.
BASE = 0x9E3779B97F4A7C15 | 1
U64 = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (xor-shift, multiply), elementwise."""
    x = np.array(x, dtype=U64)
    x ^= x >> U64(32)
    x *= U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    x *= U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    return x


_BYTE = mix(np.arange(1, 257, dtype=U64) * U64(BASE))
_POW: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``BASE**i`` and its inverse modulo 2^64 for ``i < n``."""
    if len(_POW.get("up", ())) < n:
        size = max(n, CHUNK + 1)
        for name, b in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            p = np.full(size, U64(b))
            p[0] = U64(1)
            _POW[name] = np.cumprod(p, dtype=U64)
    return _POW["up"][:n], _POW["down"][:n]


class RollingHash:
    """64-bit hashes of any byte range of a buffer, in O(1) each."""

    def __init__(self, data: np.ndarray):
        up, self.down = _powers(len(data) + 1)
        self.prefix = np.zeros(len(data) + 1, dtype=U64)
        np.cumsum(_BYTE[data] * up[:len(data)], out=self.prefix[1:])

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of ``data[start:end]``, the length mixed in."""
        h = (self.prefix[end] - self.prefix[start]) * self.down[start]
        return mix(h + (end - start).astype(U64) * U64(0xA0761D6478BD642F))

    def windows(self, width: int) -> np.ndarray:
        """Hash of every ``width``-byte window of the buffer."""
        n = len(self.prefix) - width
        if n <= 0:
            return np.empty(0, dtype=U64)
        return mix((self.prefix[width:] - self.prefix[:n]) * self.down[:n])


def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, offsets)`` of a string column; null texts are empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = pc.fill_null(col, "")
    if not len(col):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    width = np.int64 if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type) else np.int32
    _, offs, data = col.buffers()
    off = np.frombuffer(offs, dtype=width)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def chunks(data: np.ndarray, off: np.ndarray, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, past last row, bytes, offsets)`` of whole texts."""
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, "right")) - 1)
        yield lo, hi, data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi


GAP = np.zeros(256, dtype=bool)
GAP[[9, 10, 11, 12, 13, 32]] = True
LETTER = np.zeros(256, dtype=bool)
LETTER[48:58] = LETTER[65:91] = LETTER[97:123] = LETTER[128:] = True


def _bounds(inside: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of ``inside``, cut between texts."""
    full = np.flatnonzero(np.diff(off))
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    before[off[full]] = False
    after = np.empty_like(inside)
    after[-1:] = False
    after[:-1] = inside[1:]
    after[off[full + 1] - 1] = False
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def rows_of(off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The text that each byte position lies in."""
    return np.searchsorted(off, at, "right") - 1


def words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+``."""
    return _bounds(~GAP[data], off)


def tokens(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of letters and digits, and every other non-space byte alone."""
    run = LETTER[data]
    s, e = _bounds(run, off)
    lone = np.flatnonzero(~run & ~GAP[data])
    start, end = np.concatenate([s, lone]), np.concatenate([e, lone + 1])
    order = np.argsort(start, kind="stable")
    return start[order], end[order]
