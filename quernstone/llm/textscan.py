"""Vectorised word scanning of Arrow text columns.

Everything here works on the UTF-8 bytes of a slice of an Arrow batch, so no
Python object is made per word.  Memory follows the slice (``SLICE`` bytes, or
one document if that is longer), not the batch.

Words and runs of words are told apart by keyed 64-bit hashes: eight bytes at a
time go through a non-linear mixer, long words through BLAKE2b, and runs are
built by pairing halves.  The key is drawn anew for each run of an operator
(``new_key``) or each worker, so nobody can write texts that collide.  Where
hashes of the whole corpus meet, two independent lanes make 128 bits.
"""

from __future__ import annotations

import ctypes
import hashlib
import secrets
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE = 1 << 20
#: Longer words are hashed one by one.
LONG = 64
_LENGTH = np.uint64(0xD6E8FEB86659FD93)
_LEFT = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
#: Masks that keep the first 0 to 8 bytes of a little-endian number.
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def released(run: Callable) -> Callable:
    """A batch function that gives freed memory back when its task ends: Python workers live on and share an executor's memory."""

    def inner(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim:
                trim(0)

    return inner


def new_key() -> int:
    """A random key; tasks of one run must share it, so it is drawn in the driver."""
    return secrets.randbits(64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser; it changes x in place."""
    x ^= x >> np.uint64(33)
    x *= _M1
    x ^= x >> np.uint64(29)
    x *= _M2
    x ^= x >> np.uint64(32)
    return x


class Splitter:
    """Which bytes belong to words, and how they are read."""

    def __init__(self, separators: bytes, lower: bool):
        self.inside = np.ones(256, bool)
        self.inside[list(separators)] = False
        self.lower = np.arange(256, dtype=np.uint8)
        if lower:
            self.lower[0x41:0x5B] = self.lower[0x61:0x7B]


#: Words are runs of anything but space, tab, LF, VT, FF and CR.
SPACES = bytes([0x20, *range(0x09, 0x0E)])
SPACED = Splitter(SPACES, lower=False)
SPACED_LOWER = Splitter(SPACES, lower=True)
#: Words are runs of digits, ASCII letters (lower-cased) and non-ASCII characters.
ALNUM_LOWER = Splitter(bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]), lower=True)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and len+1 offsets into them; null is empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), at


def slices(offsets: np.ndarray, size: int = SLICE) -> Iterator[tuple[int, int]]:
    """Runs of rows with about `size` bytes of text, one row at least."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1
        end = min(max(end, row + 1), rows)
        yield row, end
        row = end


def byte_hashes(data: np.ndarray, s: np.ndarray, e: np.ndarray, key: int, lanes: int = 1, lower: np.ndarray | None = None) -> list[np.ndarray]:
    """Hashes of the byte runs data[s:e], one array for each lane."""
    if not len(s):
        return [np.zeros(0, np.uint64) for _ in range(lanes)]
    base, end = int(s.min()), int(e.max())
    padded = np.zeros(end - base + 8, np.uint8)
    padded[: end - base] = data[base:end] if lower is None else lower[data[base:end]]
    eights = np.ndarray((end - base + 1,), "<u8", padded, strides=(1,))
    s, size = s - base, e - s
    seeds = [np.frombuffer(hashlib.blake2b(bytes([lane]), key=key.to_bytes(8, "little"), digest_size=8).digest(), np.uint64)[0] for lane in range(lanes)]
    out = [size.astype(np.uint64) * _LENGTH + seed for seed in seeds]
    long = np.flatnonzero(size > LONG)
    # Every run takes part in the first step, so empty ones are mixed too.
    on, at, left = slice(None), s, np.minimum(size, LONG)
    while True:
        chunk = eights[at] & _FIRST[np.minimum(left, 8)]
        for h in out:
            x = h[on] ^ chunk
            h[on] = mix(x)
        going = np.flatnonzero(left > 8)
        if not len(going):
            break
        on = going if isinstance(on, slice) else on[going]
        at, left = at[going] + 8, left[going] - 8
    for i in long.tolist():
        digest = hashlib.blake2b(padded[s[i] : s[i] + size[i]].data, key=key.to_bytes(8, "little"), digest_size=8 * lanes).digest()
        for lane in range(lanes):
            out[lane][i] = int.from_bytes(digest[8 * lane : 8 * lane + 8], "little")
    return out


def word_places(data: np.ndarray, offsets: np.ndarray, splitter: Splitter) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and the index of each row's first word (len+1)."""
    a, b = int(offsets[0]), int(offsets[-1])
    inside = splitter.inside[data[a:b]]
    if not inside.any():
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    edges = offsets[np.searchsorted(offsets, a, "right") : np.searchsorted(offsets, b)] - a
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    s, e = np.flatnonzero(first) + a, np.flatnonzero(last) + a + 1
    return s, e, np.searchsorted(s, offsets)


def words(data: np.ndarray, offsets: np.ndarray, splitter: Splitter, key: int, lanes: int = 1):
    """Start and end of each word, the index of each row's first word (len+1), and the words' hashes, one array for each lane."""
    s, e, first = word_places(data, offsets, splitter)
    return s, e, first, *byte_hashes(data, s, e, key, lanes, splitter.lower)


def _pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix(left * _LEFT + right)


def windows(h: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of `width` words, by their first word."""
    if len(h) < width:
        return np.zeros(0, np.uint64)
    x, k = h, 1
    while 2 * k <= width:
        x, k = _pair(x[:-k], x[k:]), 2 * k
    return x.copy() if k == width else _pair(x[: len(h) - width + 1], x[width - k :])


def runs(h: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the runs h[start:end], one word each at least."""
    out, size = np.zeros(len(start), np.uint64), end - start
    x, k, most = h, 1, int(size.max(initial=0))
    while k <= most:
        on = np.flatnonzero((size >= k) & (size < 2 * k))
        out[on] = _pair(x[start[on]], x[end[on] - k])
        if 2 * k <= most:
            x = _pair(x[:-k], x[k:])
        k *= 2
    return mix(out + size.astype(np.uint64) * _LENGTH)


def shingles(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each row's runs of k words (all of its words if it has fewer, but some), and the rows' offsets into them."""
    count = np.diff(first)
    per_row = np.where(count >= k, count - k + 1, np.minimum(count, 1))
    at = np.zeros(len(first), np.int64)
    np.cumsum(per_row, out=at[1:])
    start = np.arange(at[-1]) + np.repeat(first[:-1] - at[:-1], per_row)
    every = windows(hashes, k)
    out = every[np.minimum(start, max(len(every) - 1, 0))] if len(every) else np.zeros(len(start), np.uint64)
    short = np.flatnonzero((count > 0) & (count < k))
    out[at[short]] = runs(hashes, first[short], first[short] + count[short])
    return out, at


def text_digest(data: np.ndarray, start: int, end: int) -> int:
    """A 64-bit digest of a text's bytes, as a signed number."""
    return int.from_bytes(hashlib.blake2b(data[start:end].data, digest_size=8).digest(), "little", signed=True)
