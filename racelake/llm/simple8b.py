"""Simple-8b word-aligned coding of token ids.

A 64-bit word holds a 4-bit selector and 60 bits of data: ``count`` slots of
``width`` bits.  The all-ones value of a slot is reserved: it says that the
id stands in the block's escape list (ids of 20 bits or more), so one rare
wide id never widens its neighbours.  Each block also keeps, for every
``STRIDE``-th word, the index of its first id; a reader of some documents of a
block decodes only the words between two such offsets.

Everything works on whole arrays; only the choice of the next word start is a
chain that is followed step by step.
"""

from __future__ import annotations

import numpy as np

#: Slot width and slot count by selector (1, 2, ... index).
WIDTHS = (1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20)
COUNTS = (60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3)
MAX_WIDTH = WIDTHS[-1]
#: Words between two recorded offsets.
STRIDE = 128

_NEED = np.array([int(v + 1).bit_length() for v in range(1 << 17)], np.uint8)
_COUNT_OF = np.array((0, *COUNTS, 0, 0, 0), np.int64)


def _need(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bits that each id takes (v < 2^w - 1), and which ids are escaped."""
    if ids.size and ids.max() < (1 << 17):
        return _NEED[ids], np.zeros(0, np.int64)
    escaped = ids >= (1 << MAX_WIDTH) - 1
    need = np.frexp(np.where(escaped, 0, ids).astype(np.float64) + 1)[1].astype(np.uint8)
    need[escaped] = 1
    return need, np.flatnonzero(escaped)


def encode(ids: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """ids -> (words, escapes, offsets), each as little-endian bytes."""
    ids = np.ascontiguousarray(ids, np.uint64)
    n = ids.size
    if not n:
        return b"", b"", b""
    need, escaped = _need(ids)
    # the selector at each position: the most slots whose ids all fit; the
    # sliding maximum over each slot count is built from shorter ones
    selector = np.full(n, len(WIDTHS), np.uint8)
    tallest, done = {1: need}, 1
    for s in range(len(WIDTHS), 0, -1):
        count = COUNTS[s - 1]
        while done < count:
            add = max(k for k in tallest if k <= count - done)
            wider = tallest[done].copy()
            np.maximum(wider[:-done], tallest[add][done:], out=wider[:-done])
            done += add
            tallest[done] = wider
        fits = tallest[count] <= WIDTHS[s - 1]
        if s < len(WIDTHS) and not fits.any():
            break  # narrower slots need still longer runs
        np.copyto(selector, np.uint8(s), where=fits)
    step = _COUNT_OF[selector].tolist()
    starts, at = [], 0
    while at < n:
        starts.append(at)
        at += step[at]
    first = np.array(starts, np.int64)
    chosen = selector[first]
    if escaped.size:
        slots = ids.copy()
        slots[escaped] = np.uint64(2**64 - 1)
    else:
        slots = ids
    slots = np.concatenate((slots, np.zeros(60, np.uint64)))
    words = np.empty(first.size, np.uint64)
    for s in np.unique(chosen).tolist():
        width, count = WIDTHS[s - 1], COUNTS[s - 1]
        here = np.flatnonzero(chosen == s)
        base = first[here]
        word = np.full(here.size, np.uint64(s) << np.uint64(60))
        mask = np.uint64((1 << width) - 1)
        for k in range(count):
            word |= (slots[base + k] & mask) << np.uint64(width * k)
        words[here] = word
    return (words.astype("<u8").tobytes(), ids[escaped].astype("<u8").tobytes(),
            first[::STRIDE].astype("<u4").tobytes())


def _unpack(words: np.ndarray, escapes: np.ndarray) -> np.ndarray:
    chosen = (words >> np.uint64(60)).astype(np.int64)
    counts = _COUNT_OF[chosen]
    first = np.cumsum(counts) - counts
    out = np.empty(int(counts.sum()), np.uint64)
    hit = []
    for s in np.unique(chosen).tolist():
        width, count = WIDTHS[s - 1], COUNTS[s - 1]
        here = np.flatnonzero(chosen == s)
        base, part = first[here], words[here]
        mask = np.uint64((1 << width) - 1)
        for k in range(count):
            value = (part >> np.uint64(width * k)) & mask
            out[base + k] = value
            if escapes.size:
                hit.append((base + k)[value == mask])
    if escapes.size:
        at = np.sort(np.concatenate(hit))
        out[at] = escapes[:at.size]
    return out


def decode(words: bytes, escapes: bytes, n: int) -> np.ndarray:
    """All ``n`` ids of a block."""
    if not n:
        return np.zeros(0, np.uint64)
    return _unpack(np.frombuffer(words, "<u8"), np.frombuffer(escapes, "<u8"))[:n]


def decode_range(words: bytes, escapes: bytes, offsets: bytes, n: int, lo: int, hi: int) -> np.ndarray:
    """Ids lo..hi-1 of a block, decoding only the words around them."""
    hi = min(hi, n)
    if lo >= hi:
        return np.zeros(0, np.uint64)
    if escapes:  # the place of an escape needs the number of escapes before it
        return decode(words, escapes, n)[lo:hi]
    first = np.frombuffer(offsets, "<u4").astype(np.int64)
    a = int(np.searchsorted(first, lo, "right")) - 1
    b = int(np.searchsorted(first, hi, "left"))
    part = np.frombuffer(words, "<u8")[a * STRIDE:b * STRIDE]
    return _unpack(part, np.zeros(0, np.uint64))[lo - first[a]:hi - first[a]]
