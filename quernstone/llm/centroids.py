"""Centroid clustering over dictionary-encoded subvectors (operator 13).

Vectors become integers, and every two neighbouring components one subvector of
64 bits.  Subvectors repeat far more often than vectors do, so each block of
components gets a dictionary of its distinct subvectors, and a vector becomes a
row of codes.  A round computes the exact squared distance of each dictionary
entry to each centroid once in a task; the distance of a vector is the sum of
its codes' entries.

A dictionary holds the ``CODES`` most frequent subvectors of all blocks
together, which bounds what is broadcast; a rarer subvector stays as it is in
its row and is measured there, so the encoding loses nothing at any size.
Nothing but the codes is read in a round, and a task returns one row of sums
for each centroid, so a vector that a third of all rows share costs no more
than others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import shared_folder, stash, table
from .textscan import released

#: Entries of all dictionaries together: 4 MB broadcast, and 128 bytes for each in a task with 16 centroids.
CODES = 1 << 18
#: Integer components below this keep squared distances of up to 2^8 components within 63 bits.
LARGEST = 1 << 26
#: Subvectors a task gathers before it hands their counts on.
_HELD = 1 << 20


def integers(vectors: DataFrame, id_col: str, vec_col: str, dims: int, scale: int) -> DataFrame:
    """(id, x) of the vectors that have exactly dims components, none null or non-finite; x holds floor(scale * component)."""
    v = F.col(vec_col)

    def whole(c: Column) -> Column:
        scaled = F.lit(float(scale)) * c.cast("double")
        return F.when(F.abs(scaled) < LARGEST, F.floor(scaled).cast("int")).otherwise(F.raise_error(F.lit(f"a component is {LARGEST} or more when scaled")).cast("int"))

    kept = (F.size(v) == dims) & F.forall(v, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < float("inf")))
    return vectors.where(kept).select(F.col(id_col).cast("bigint").alias("id"), F.transform(v, whole).alias("x"))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def pack(x: np.ndarray) -> np.ndarray:
    """Integer rows as subvectors of two components each; the last one of an odd row has a zero beside it."""
    if x.shape[1] % 2:
        x = np.hstack([x, np.zeros((len(x), 1), x.dtype)])
    x = x.astype(np.int64)
    return (x[:, 0::2] << 32) | (x[:, 1::2] & 0xFFFFFFFF)


def unpack(sub: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return sub >> 32, sub.astype(np.int32).astype(np.int64)


def _counted(dims: int):
    """(block, sub, n) of (id, x) batches, each subvector once until _HELD of them are held."""

    def out(held: list) -> pa.RecordBatch:
        block, sub, n = (np.concatenate(c) for c in zip(*held, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(block), pa.array(sub), pa.array(n)], names=["block", "sub", "n"])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            subs = pack(_matrix(batch.column(1), dims))
            for b in range(subs.shape[1] if len(subs) else 0):
                sub, n = np.unique(subs[:, b], return_counts=True)
                held.append((np.full(len(sub), b, np.int32), sub, n.astype(np.int64)))
                size += len(sub)
            if size > _HELD:
                yield out(held)
                held, size = [], 0
        if held:
            yield out(held)

    return run


class Dictionary:
    """The subvectors that have codes, sorted within their block; at[b] is the first code of block b."""

    def __init__(self, rows: Sequence[tuple[int, int]], blocks: int):
        rows = sorted(rows)
        self.sub = np.array([s for _, s in rows], np.int64)
        self.at = np.searchsorted(np.array([b for b, _ in rows], np.int64), np.arange(blocks + 1))

    def codes(self, subs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of rows of subvectors, and which of them have none."""
        codes, missing = np.zeros(subs.shape, np.int64), np.ones(subs.shape, bool)
        for b in range(subs.shape[1]):
            own = self.sub[self.at[b] : self.at[b + 1]]
            if len(own):
                k = np.minimum(np.searchsorted(own, subs[:, b]), len(own) - 1)
                codes[:, b], missing[:, b] = k + self.at[b], own[k] != subs[:, b]
        return codes, missing

    def distances(self, centroids: np.ndarray) -> np.ndarray:
        """Squared distance of each entry to the same block of each centroid: entries x centroids."""
        hi, lo = unpack(self.sub)
        c_hi, c_lo = unpack(pack(centroids))
        block = np.repeat(np.arange(len(self.at) - 1), np.diff(self.at))
        return (hi[:, None] - c_hi.T[block]) ** 2 + (lo[:, None] - c_lo.T[block]) ** 2


def _encoded(dims: int, dictionary):
    """Batches (id, codes, plain): a negative code -1-k stands for the k-th plain subvector of the row."""

    def run(batches):
        d = dictionary.value
        for batch in batches:
            subs = pack(_matrix(batch.column(1), dims))
            codes, missing = d.codes(subs)
            rank = np.cumsum(missing, axis=1)
            codes[missing] = -rank[missing]
            offsets = np.append(0, np.cumsum(missing.sum(axis=1))).astype(np.int32)
            width = np.arange(len(subs) + 1, dtype=np.int32) * subs.shape[1]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(width), pa.array(codes.ravel().astype(np.int32))), pa.ListArray.from_arrays(pa.array(offsets), pa.array(subs[missing]))],
                names=["id", "codes", "plain"],
            )

    return run


class _Round:
    """Nearest centroids of encoded batches."""

    def __init__(self, dictionary: Dictionary, centroids: np.ndarray):
        self.d, self.table, self.centroids = dictionary, dictionary.distances(centroids), pack(centroids)

    def nearest(self, batch: pa.RecordBatch):
        """Codes, plain subvectors by row, block and value, nearest centroid and squared distance of each row."""
        blocks, k = self.centroids.shape[1], self.table.shape[1]
        codes = _matrix(batch.column(1), blocks).astype(np.int64)
        row, block = np.nonzero(codes < 0)
        plain = batch.column(2).flatten().to_numpy(zero_copy_only=False)
        total = np.zeros((len(codes), k), np.int64)
        for b in range(blocks):
            if self.d.at[b] < self.d.at[b + 1]:
                here = codes[:, b] >= 0
                total[here] += self.table[codes[here, b]]
        if len(row):
            hi, lo = unpack(plain)
            c_hi, c_lo = unpack(self.centroids)
            np.add.at(total, row, (hi[:, None] - c_hi.T[block]) ** 2 + (lo[:, None] - c_lo.T[block]) ** 2)
        best = total.argmin(axis=1)
        return codes, (row, block, plain), best, total[np.arange(len(codes)), best]


def _sums(dictionary, centroids: np.ndarray):
    """(cluster, n, sums) of a task's vectors, one row for each centroid that has some."""

    def run(batches):
        d = dictionary.value
        each, k, blocks = _Round(d, centroids), len(centroids), len(d.at) - 1
        hi, lo = unpack(d.sub)
        n, sums = np.zeros(k, np.int64), np.zeros((k, 2 * blocks), np.int64)
        for batch in batches:
            codes, (row, block, plain), best, _ = each.nearest(batch)
            n += np.bincount(best, minlength=k)
            for b in range(blocks):
                here = codes[:, b] >= 0
                for side, part in ((0, hi), (1, lo)):
                    sums[:, 2 * b + side] += np.bincount(best[here], part[codes[here, b]], k).astype(np.int64)
            for side, part in enumerate(unpack(plain)):
                np.add.at(sums, (best[row], 2 * block + side), part)
        some = np.flatnonzero(n)
        width = np.arange(len(some) + 1, dtype=np.int32) * 2 * blocks
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(n[some]), pa.ListArray.from_arrays(pa.array(width), pa.array(sums[some].ravel()))], names=["cluster", "n", "sums"])

    return run


def _assigned(dictionary, centroids: np.ndarray):
    def run(batches):
        each = _Round(dictionary.value, centroids)
        for batch in batches:
            _, _, best, distance = each.nearest(batch)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(best.astype(np.int32)), pa.array(distance)], names=["id", "cluster", "distance"])

    return run


def cluster(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", dims: int = 64, scale: int = 64, k: int = 16, rounds: int = 3, seed: int = 1, codes: int = CODES) -> tuple[DataFrame, list[list[int]]]:
    """(id, cluster, distance) of the kept vectors, and the final centroids as integers.

    Kept are vectors of exactly dims components, none null or non-finite; each
    component x is floor(scale * x), which must stay below 2^26 (an error
    otherwise).  Centroids start as the k kept vectors with the smallest
    lowercase-hex sha256 of ``<seed>:<id>``, a null id being empty, then by
    their components.  Fewer vectors make fewer centroids, none make no rows.
    Ties of distance go to the smaller number.  Centroids without vectors stay.
    Rows that repeat an id are clustered each by itself; other columns of
    vectors are not looked at.
    """
    if dims > 256:
        raise ValueError("squared distances of more than 256 components may leave 63 bits")
    spark, blocks = vectors.sparkSession, -(-dims // 2)
    ints = stash(integers(vectors, id_col, vec_col, dims, scale))
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    centroids = np.array([r.x for r in ints.orderBy(mark, "x").limit(k).collect()], np.int64)
    schema = "id bigint, cluster int, distance bigint"
    if not len(centroids):
        return spark.createDataFrame([], schema), []
    counts = ints.mapInArrow(released(_counted(dims)), "block int, sub bigint, n bigint").groupBy("block", "sub").agg(F.sum("n").alias("n"))
    frequent = counts.orderBy(F.desc("n"), "block", "sub").limit(codes).select("block", "sub").collect()
    dictionary = spark.sparkContext.broadcast(Dictionary([tuple(r) for r in frequent], blocks))
    encoded = stash(ints.mapInArrow(released(_encoded(dims, dictionary)), "id bigint, codes array<int>, plain array<bigint>"))
    for _ in range(rounds):
        parts = encoded.mapInArrow(released(_sums(dictionary, centroids)), "cluster int, n bigint, sums array<bigint>")
        total = parts.select("cluster", "n", F.posexplode("sums").alias("at", "part")).where(F.col("at") < dims)
        total = total.groupBy("cluster", "at").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
        for r in total.collect():  # k * dims rows
            centroids[r.cluster, r.at] = int(r.total) // r.n
    return encoded.mapInArrow(released(_assigned(dictionary, centroids)), schema), centroids.tolist()


def op13_subvector_centroids(spark, sf_dir: str) -> DataFrame:
    found, centroids = cluster(table(spark, sf_dir, "embeddings"))
    found = stash(found, shared_folder(spark))
    spread = {r.cluster: int(r.total) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}
    shas = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    rows = [(c, spread[c], sum(spread.values()), shas[c]) for c in spread]
    told = spark.createDataFrame(rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return found.join(F.broadcast(told), "cluster").select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def brute_force(rows: Sequence[tuple[int | None, list | None]], dims: int = 64, scale: int = 64, k: int = 16, rounds: int = 3) -> list[tuple]:
    """Sorted rows of the query, in plain Python."""
    import math

    kept = [(i, [math.floor(scale * float(x)) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    seeds = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [list(x) for _, x in seeds[:k]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        members = {}
        for _, x in kept:
            members.setdefault(nearest(x)[1], []).append(x)
        for j, m in members.items():
            centroids[j] = [sum(c) // len(m) for c in zip(*m, strict=True)]
    found = [(i, *nearest(x)) for i, x in kept]
    spread = {}
    for _, d, j in found:
        spread[j] = spread.get(j, 0) + d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, j, d, spread[j], sum(spread.values()), sha[j]) for i, d, j in found), key=str)
