"""Vectorised scans over the UTF-8 buffers of Arrow text columns.

The operators that look at every word work on Arrow batches inside
``mapInArrow``: word boundaries and 64-bit word hashes of a whole block of
documents come from a few numpy passes, so no Python object is made per word.
Hashes are position free (the same word has the same hash in every block).
A block is cut into pieces for the passes that need memory per byte, so a very
long document costs memory per word only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 20            # bytes per vector pass
BLOCK = 16 << 20           # bytes of text per block of documents
_M64 = (1 << 64) - 1
_R = 0x9E3779B97F4A7C15    # odd, so it has an inverse modulo 2**64
_RINV = pow(_R, -1, 1 << 64)

WS = np.zeros(256, dtype=bool)
WS[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_BYTE = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_pow = {"n": 0}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _pow["n"] < n:
        n = max(n, PIECE + (1 << 16))
        up, down = np.full(n, _R, np.uint64), np.full(n, _RINV, np.uint64)
        up[0] = down[0] = 1
        _pow.update(n=n, up=np.multiply.accumulate(up), down=np.multiply.accumulate(down))
    return _pow["up"], _pow["down"]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; null reads as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if col.null_count:
        col = col.fill_null("")
    if pa.types.is_large_string(col.type):
        offs = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    else:
        offs = np.frombuffer(col.buffers()[1], np.int32)[col.offset:col.offset + len(col) + 1]
    data = col.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offs.astype(np.int64)


def row_blocks(offs: np.ndarray, limit: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts hold at most ``limit`` bytes (one row at least)."""
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def _pieces(buf: np.ndarray, offs: np.ndarray) -> Iterator[tuple[int, int]]:
    """Byte ranges that end at a document's start or before white space that
    follows an ASCII letter or digit: no word or pre-token crosses them."""
    at, end = int(offs[0]), int(offs[-1])
    while at < end:
        cut = at + PIECE
        if cut >= end:
            yield at, end
            return
        doc = int(offs[np.searchsorted(offs, cut)])
        step = cut
        cut = doc
        while step < doc:
            w = buf[step - 1:min(step + (1 << 16), doc)]
            alnum = ((w[:-1] | 32) - np.uint8(97) < 26) | (w[:-1] - np.uint8(48) < 10)
            hit = np.flatnonzero(WS[w[1:]] & alnum)
            if len(hit):
                cut = step + int(hit[0])
                break
            step += 1 << 16
        yield at, cut
        at = cut


def hash_ranges(buf: np.ndarray, at: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the byte ranges [start, end) of one piece that begins at ``at``."""
    up, down = _powers(len(buf) + 1)
    sums = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_BYTE[buf] * up[:len(buf)], out=sums[1:])
    s, e = starts - at, ends - at
    return mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))


def scan_words(buf: np.ndarray, offs: np.ndarray, lower: bool = False):
    """Words ``[^\\x20\\x09-\\x0D]+`` of the documents ``offs`` delimits.

    Returns (start, end, hash, ptr): byte ranges, hashes (of A-Z lower-cased
    bytes if ``lower``), and the words ``ptr[i]:ptr[i+1]`` of document i.
    """
    starts, ends, hashes = [], [], []
    for a, b in _pieces(buf, offs):
        part = LOWER[buf[a:b]] if lower else buf[a:b]
        space = WS[part]
        first = offs[np.searchsorted(offs, a):np.searchsorted(offs, b)] - a
        edge = np.zeros(b - a + 1, bool)
        edge[1:] = space
        edge[0] = True
        before = edge[:-1].copy()
        before[first] = True
        after = np.ones(b - a, bool)
        after[:-1] = space[1:]
        after[first[first > 0] - 1] = True
        s = np.flatnonzero(~space & before) + a
        e = np.flatnonzero(~space & after) + a + 1
        starts.append(s)
        ends.append(e)
        hashes.append(hash_ranges(part, a, s, e))
    if not starts:
        return (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(len(offs), np.int64))
    s = np.concatenate(starts)
    return s, np.concatenate(ends), np.concatenate(hashes), np.searchsorted(s, offs)


def joined(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, sep: int = 0x20) -> bytes:
    """The byte ranges, each followed by ``sep``."""
    n = ends - starts + 1
    out = np.cumsum(n)
    idx = np.arange(int(out[-1]) if len(out) else 0) + np.repeat(starts - (out - n), n)
    res = buf[np.minimum(idx, len(buf) - 1)] if len(idx) else np.zeros(0, np.uint8)
    res[out - 1] = sep
    return res.tobytes()


def groups(h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes in order, the first place of each, and each place's code."""
    uniq, first, code = np.unique(h, return_index=True, return_inverse=True)
    return uniq, first, code.astype(np.int32)


def count_by_row(flags: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    """Sums of ``flags`` over the word ranges of ``ptr``."""
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[ptr[1:]] - sums[ptr[:-1]]
