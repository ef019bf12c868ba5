"""Uniform shuffle into shards of exact size by a hypergeometric communication matrix (operator 6).

DataFrame operations only.  Row (i, s) of the matrix says how many rows of
input partition i go to shard s.  It is drawn exactly: the rows of partition i
are a sample without replacement from the places that the shards have left, so
its row of the matrix is multivariate hypergeometric.  Each partition is
permuted at random and cut by its row of the matrix, rows are exchanged, and
each shard is permuted again.  Only counts meet in the driver.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, stash, table

#: Rows that a task permutes: of an input partition, and of a part of a shard.
ROWS = 20_000
#: Parts at most, so that the driver draws a bounded number of counts; beyond ROWS * PARTS rows, parts are larger.
PARTS = 100_000


def hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """How many of n draws without replacement are good: any population, time in proportion to the spread of the outcome.

    The distribution is built from its mode outwards by ratios of neighbours,
    which are exact to the last bits at any size, and inverted.
    """
    low, high = max(0, n - bad), min(n, good)
    if low == high:
        return low
    total = good + bad
    mode = min(max((n + 1) * (good + 1) // (total + 2), low), high)
    reach = 40 + int(14 * (n * (good / total) * (bad / total)) ** 0.5)
    k = np.arange(max(low, mode - reach), min(high, mode + reach) + 1, dtype=np.float64)
    step = (good - k[:-1]) * (n - k[:-1]) / ((k[:-1] + 1) * (float(bad - n) + k[:-1] + 1))
    at = mode - int(k[0])
    p = np.ones(len(k))
    p[at + 1 :] = np.cumprod(step[at:])
    p[:at] = np.cumprod(1 / step[:at][::-1])[::-1]
    sums = np.cumsum(p)
    return int(k[np.searchsorted(sums, rng.random() * sums[-1], "right").clip(0, len(k) - 1)])


def communication_matrix(counts: list[int], capacity: list[int], seed: int) -> np.ndarray:
    """Rows sum to counts, columns to capacity; uniform over all assignments of rows to places."""
    rng, left = np.random.default_rng(seed), list(capacity)
    out = np.zeros((len(counts), len(capacity)), np.int64)
    for i, n in enumerate(counts):
        rest = sum(left)
        for s in range(len(left)):
            rest -= left[s]
            out[i, s] = hypergeometric(rng, left[s], rest, n)
            n -= out[i, s].item()
            left[s] -= out[i, s].item()
    return out


def shard_rows(rows: DataFrame, shards: int = 16, seed: int = 7, rows_per_task: int = ROWS) -> DataFrame:
    """rows with shard and slot: shards differ by one row at most, and every assignment is equally likely.

    The random keys are hashes of a row's place in a table on shared storage,
    so a task that runs again after a lost executor draws the same ones, and
    equal rows and null ids are placed like any others.  No rows make no rows.
    Columns of rows that have one of the names used here are an error.
    """
    clash = {"_part", "_bucket", "_rank", "_cuts", "_before", "_file", "_row", "_metadata", "shard", "slot"} & set(rows.columns)
    if clash:
        raise ValueError(f"columns are taken: {sorted(clash)}")
    spark = rows.sparkSession
    names = [F.col(f"`{c}`") for c in rows.columns]
    file = F.regexp_replace("_metadata.file_name", "-[0-9a-f-]{36}-", "-")  # without the name of the write
    rows = stash(rows).select(*names, file.alias("_file"), F.col("_metadata.row_index").alias("_row"))
    key = lambda k: F.xxhash64(F.lit(seed * 8 + k), "_file", "_row")
    n = rows.count()
    rows_per_task = max(rows_per_task, -(-n // PARTS))
    capacity = [n // shards + (s < n % shards) for s in range(shards)]
    parts = max(1, -(-n // rows_per_task))
    placed = rows.withColumn("_part", F.pmod(key(0), F.lit(parts)).cast("int"))
    have = {r[0]: r[1] for r in placed.groupBy("_part").count().collect()}
    matrix = communication_matrix([have.get(i, 0) for i in range(parts)], capacity, seed)
    cuts = spark.createDataFrame([(i, c) for i, c in enumerate(np.cumsum(matrix, axis=1).tolist())], "_part int, _cuts array<bigint>")

    # Permute in each input partition, and let the first rows go to shard 0, the next to shard 1, ...
    w = Window.partitionBy("_part").orderBy(key(1), "_file", "_row")
    dealt = placed.withColumn("_rank", F.row_number().over(w)).join(F.broadcast(cuts) if parts <= BROADCAST_ROWS // shards else cuts, "_part")
    dealt = dealt.withColumn("shard", F.size(F.filter("_cuts", lambda c: c < F.col("_rank"))).cast("int")).drop("_part", "_rank", "_cuts")

    # Exchange, and permute in each shard: by a random part of it, then inside that part.
    buckets = max(1, -(-n // (shards * rows_per_task)))
    dealt = stash(dealt.withColumn("_bucket", F.pmod(key(2), F.lit(buckets)).cast("int")))
    sizes = dealt.groupBy("shard", "_bucket").count()
    before = sizes.select("shard", "_bucket", (F.sum("count").over(Window.partitionBy("shard").orderBy("_bucket")) - F.col("count")).alias("_before"))
    w = Window.partitionBy("shard", "_bucket").orderBy(key(3), "_file", "_row")
    out = dealt.withColumn("_rank", F.row_number().over(w)).join(F.broadcast(before) if shards * buckets <= BROADCAST_ROWS else before, ["shard", "_bucket"])
    return out.select(*names, "shard", (F.col("_before") + F.col("_rank") - 1).cast("bigint").alias("slot"))


def op6_uniform_shards(spark, sf_dir: str) -> DataFrame:
    text = F.col("text").cast("string")
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint").alias("size"), F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32")
    )
    out = shard_rows(rows, shards=16)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
