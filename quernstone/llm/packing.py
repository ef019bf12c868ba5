"""Bounded-space online best-fit packing of token sequences (operator 8)."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table
from .textscan import released
from .tokens import encoded

END = 2
CAPACITY = 1024
#: Bins that a task holds open; more than a bin for each amount of free space.
OPEN_BINS = 4096
PIECE = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def cut(total: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of `total` tokens; only the first may be shorter."""
    first = total % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, total, capacity))]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Token pieces of each document, the end id included; null is the empty text, of one token."""

    def run(batches):
        for batch in batches:
            out: list[tuple] = []
            names = batch.column(0)
            for row, ids, at in encoded(batch.column(1), tokenizer):
                for i in range(len(at) - 1):
                    own = np.append(ids[at[i] : at[i + 1]], np.uint32(END)).astype("<u4")
                    doc = names[row + i].as_py()
                    for k, (s, n) in enumerate(cut(len(own), capacity)):
                        these = own[s : s + n].tobytes()
                        out.append((doc, k, s, n, zlib.crc32(these), these) if with_ids else (doc, k, s, n, zlib.crc32(these)))
            columns = list(zip(*out, strict=True)) or [[]] * (6 if with_ids else 5)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=False)], names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: len(columns)])

    source = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(released(run), PIECE + ", ids binary" * with_ids)


class BestFit:
    """Online best fit over a bounded number of open bins.

    The free space of the open bins is a bitset: bit f is set while some open
    bin has f free.  The tightest bin that a piece fits is the lowest bit from
    the piece's length on.  When a bin must be opened and all are in use, the
    fullest closes: the lowest bit of all.
    """

    def __init__(self, capacity: int, open_bins: int):
        self.capacity, self.most = capacity, open_bins
        self.free, self.bins, self.open, self.made = 0, [[] for _ in range(capacity + 1)], 0, 0

    def _take(self, f: int) -> int:
        bin_ = self.bins[f].pop()
        if not self.bins[f]:
            self.free &= ~(1 << f)
        self.open -= 1
        return bin_

    def place(self, length: int) -> tuple[int, int]:
        """(bin, offset) of a piece."""
        fitting = self.free >> length
        if fitting:
            f = length + (fitting & -fitting).bit_length() - 1
            bin_ = self._take(f)
        else:
            f, bin_ = self.capacity, self.made
            self.made += 1
        left = f - length
        if left:
            if self.open >= self.most:
                # The fullest closes, be it this one.
                low = (self.free & -self.free).bit_length() - 1
                if left <= low:
                    return bin_, self.capacity - f
                self._take(low)
            self.bins[left].append(bin_)
            self.free |= 1 << left
            self.open += 1
        return bin_, self.capacity - f


def pack(parts: DataFrame, capacity: int = CAPACITY, open_bins: int = OPEN_BINS) -> DataFrame:
    """parts (a `length` column and any others) with sequence_id and offset.

    Pieces are dealt to tasks by a hash of their whole row and each task packs
    its own as they come, the longest of each Arrow batch first; a task leaves
    at most `open_bins` bins that could have held more.  Ids are unique over
    all tasks.  Columns sequence_id and offset of parts are an error.
    """
    taken = {"sequence_id", "offset"} & set(parts.columns)
    if taken:
        raise ValueError(f"columns are taken: {sorted(taken)}")
    at = parts.columns.index("length")
    schema = f"{parts.schema.simpleString()[7:-1]}, sequence_id bigint, offset bigint"

    def run(batches):
        # An empty batch has no rows to place.
        batches = (b for b in batches if b.num_rows)
        best, base = BestFit(capacity, open_bins), TaskContext.get().partitionId() << 40
        for batch in batches:
            length = batch.column(at).to_numpy()
            order = np.argsort(-length, kind="stable")
            got = np.empty((len(length), 2), np.int64)
            got[order] = [best.place(n) for n in length[order].tolist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(base + got[:, 0]), pa.array(got[:, 1].copy())], names=[*batch.schema.names, "sequence_id", "offset"])

    return parts.repartition(F.xxhash64(*[c for c in parts.columns if c != "ids"])).mapInArrow(released(run), schema)


def best_fit_pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, open_bins: int = OPEN_BINS, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, (ids,) sequence_id, offset.

    A null id stays null; rows that repeat an id are packed like any others,
    so their pieces repeat too.  No documents make no rows.
    """
    return pack(pieces(docs, tokenizer, capacity, id_col, text_col, with_ids), capacity, open_bins)


def tokenizer_path() -> str:
    """The default tokenizer file; operators take the path as a parameter."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op8_best_fit(spark, sf_dir: str) -> DataFrame:
    return best_fit_pack(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path())
