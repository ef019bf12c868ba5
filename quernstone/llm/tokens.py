"""Token ids of a public byte-level BPE, with each distinct piece of text encoded once.

A text is cut before every single space that stands between two characters
that are not white space.  The tokenizer's own pre-tokenizer never matches
across such a place, so the ids of a text are the ids of its pieces in order.
Pieces repeat far more often than texts do; they are told apart by 128 bits of
two hashes under a key that each Python worker draws for itself, and kept, with
their ids, in a bounded table.  Texts are also cut around the tokenizer's added
tokens, which it finds anywhere.
"""

from __future__ import annotations

import base64
import json
import os
import re

import numpy as np
import pyarrow as pa

from .textscan import SLICE, byte_hashes, new_key, slices, text_bytes

#: Lead bytes of the non-ASCII white space characters.
_WIDE = np.zeros(256, bool)
_WIDE[[0xC2, 0xE1, 0xE2, 0xE3]] = True
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E), *range(0x1C, 0x20)]] = True


def pieces(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the pieces of the rows' texts begin."""
    a, b = int(offsets[0]), int(offsets[-1])
    x = data[a:b]
    space, wide = _SPACE[x], _WIDE[x]
    cut = x == 0x20
    cut[:1] = False
    cut[-1:] = False
    cut[1:] &= ~space[:-1]
    cut[:-1] &= ~(space[1:] | wide[1:])
    cut[2:] &= ~wide[:-2]
    cut[3:] &= ~wide[:-3]
    rows = offsets[:-1][np.diff(offsets) > 0] - a
    cut[rows] = True
    return np.flatnonzero(cut) + a


class PieceEncoder:
    """Ids of texts; `path` is the tokenizer's file.

    Where a rank file of the same vocabulary lies beside it (``.tiktoken``), new
    pieces go through that, many in one call; the ids are the same, which the
    tests assert.  Else the tokenizer encodes them in batches.
    """

    #: The table of pieces starts anew beyond so many pieces or ids: some 40 MB.
    MAX_PIECES, MAX_IDS = 150_000, 1_500_000

    def __init__(self, path: str):
        self.ranks, beside = None, os.path.splitext(path)[0] + ".tiktoken"
        with open(path, encoding="utf-8") as f:
            added = {t["content"].encode(): t["id"] for t in json.load(f).get("added_tokens") or []}
        #: Added tokens, the longest first, and their ids.
        self.added = {t: added[t] for t in sorted(added, key=len, reverse=True)}
        self.find_added = re.compile(b"|".join(map(re.escape, self.added))) if added else None
        if not os.path.exists(beside):
            from tokenizers import Tokenizer

            self.tokenizer = Tokenizer.from_file(path)
            self.tokenizer.encode_special_tokens = True
        else:
            import public_tokenizers
            import tiktoken

            with open(beside, "rb") as lines:
                ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
            self.ranks = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
            self.width = np.zeros(max(ranks.values()) + 1, np.int64)
            for token, rank in ranks.items():
                self.width[rank] = len(token)
        self.key = new_key()
        self.clear()

    def clear(self) -> None:
        self.index: dict[int, int] = {}
        self.check = np.empty(1 << 14, np.uint64)
        self.ids = np.empty(1 << 16, np.uint32)
        self.at = np.zeros(1 << 14, np.int64)

    def _alone(self, texts: list[bytes]) -> tuple[np.ndarray, list[int]]:
        """Ids of all texts in a row, and how many each has."""
        if self.ranks is None:
            got = [x.ids for x in self.tokenizer.encode_batch_fast([x.decode() for x in texts], add_special_tokens=False)]
        else:
            got = [self.ranks.encode_ordinary(x.decode()) for x in texts]
        return np.array([i for x in got for i in x], np.uint32), [len(x) for x in got]

    def _learn(self, data: np.ndarray, s: np.ndarray, e: np.ndarray, hashes: np.ndarray, checks: np.ndarray) -> None:
        """Adds new pieces.  Those that begin with a space and end without one may stand in a row, in one call."""
        plain = (data[s] == 0x20) & (e - s > 1) & (self.ranks is not None)
        after, last = data[np.minimum(s + 1, e - 1)], data[e - 1]
        plain &= ~(_SPACE[after] | _WIDE[after] | _SPACE[last] | _WIDE[data[np.maximum(e - 2, s)]] | _WIDE[data[np.maximum(e - 3, s)]])
        base = int(s.min())
        whole = data[base : int(e.max())].tobytes()
        cut = lambda mask: [whole[a:b] for a, b in zip((s[mask] - base).tolist(), (e[mask] - base).tolist(), strict=True)]
        ids, sizes = self._alone(cut(~plain))
        if plain.any():
            row = np.asarray(self.ranks.encode_to_numpy(b"".join(cut(plain)).decode(), disallowed_special=()), np.uint32)
            ends = np.searchsorted(np.cumsum(self.width[row]), np.cumsum((e - s)[plain])) + 1
            ids, sizes = np.concatenate([row, ids]), [*np.diff(ends, prepend=0), *sizes]
        n, used = len(self.index), int(self.at[len(self.index)])
        while len(self.ids) < used + len(ids):
            self.ids = np.resize(self.ids, 2 * len(self.ids))
        while len(self.at) < n + len(s) + 1:
            self.at, self.check = np.resize(self.at, 2 * len(self.at)), np.resize(self.check, 2 * len(self.check))
        self.check[n : n + len(s)] = np.concatenate([checks[plain], checks[~plain]])
        self.ids[used : used + len(ids)] = ids
        self.at[n + 1 : n + 1 + len(s)] = used + np.cumsum(sizes)
        self.index.update(zip([*hashes[plain].tolist(), *hashes[~plain].tolist()], range(n, n + len(s)), strict=True))

    def _cuts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the pieces begin, and the id of each that is an added token (else -1)."""
        starts = pieces(data, offsets)
        low, high = int(offsets[0]), int(offsets[-1])
        found = [(m.start() + low, m.end() + low, self.added[m[0]]) for m in self.find_added.finditer(data[low:high].data)] if self.find_added else []
        # A match across two texts is none.
        found = [x for x in found if np.searchsorted(offsets, x[0], "right") == np.searchsorted(offsets, x[1] - 1, "right")]
        if not found:
            return starts, np.full(len(starts), -1)
        begin, end, ids = (np.array(x, np.int64) for x in zip(*found, strict=True))
        inside = np.searchsorted(begin, starts, "right") - 1
        starts = starts[(inside < 0) | (starts >= end[inside])]
        starts = np.union1d(starts, np.concatenate([begin, end[(end < high) & ~np.isin(end, begin)]]))
        at = np.minimum(np.searchsorted(begin, starts), len(begin) - 1)
        return starts, np.where(begin[at] == starts, ids[at], -1)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all rows and the rows' offsets into them."""
        starts, added = self._cuts(data, offsets)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        ends = np.append(starts[1:], int(offsets[-1]))
        hashes, checks = byte_hashes(data, starts, ends, self.key, 2)
        distinct, where, back = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.index) > self.MAX_PIECES or self.at[len(self.index)] > self.MAX_IDS:
            self.clear()
        keys = distinct.tolist()
        new = [i for i, k in enumerate(keys) if k not in self.index]
        if new:
            at = where[new]
            self._learn(data, starts[at], ends[at], distinct[new], checks[at])
        entry = np.fromiter(map(self.index.__getitem__, keys), np.int64, len(keys))[back]
        if (self.check[entry] != checks).any():
            # Two pieces with one hash: another key.
            self.key = new_key()
            self.clear()
            return self.encode(data, offsets)
        size = np.where(added < 0, self.at[entry + 1] - self.at[entry], 1)
        sums = np.zeros(len(size) + 1, np.int64)
        np.cumsum(size, out=sums[1:])
        ids = self.ids[np.minimum(np.arange(sums[-1]) + np.repeat(self.at[entry] - sums[:-1], size), len(self.ids) - 1)]
        ids[sums[:-1][added >= 0]] = added[added >= 0]
        return ids, sums[np.searchsorted(starts, offsets)]


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """The Python worker's encoder for this file."""
    if path not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def encoded(column: pa.Array, path: str):
    """(first row, ids, offsets of the rows into ids) for slices of a text column."""
    data, offsets = text_bytes(column)
    for a, b in slices(offsets, SLICE):
        yield a, *encoder(path).encode(data, offsets[a : b + 1])
