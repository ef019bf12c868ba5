"""Shared pieces of the corpus operators: tables on shared storage, checked broadcasts, components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of 8 to 16 bytes that may be broadcast: a few dozen MB in each executor.
BROADCAST_ROWS = 1_000_000
#: Bytes, as JSON, of rows with strings or arrays that may be broadcast.
BROADCAST_BYTES = 32 << 20
#: Stands for a missing document id: larger than every other one.
NO_ID = (1 << 63) - 1


def shared_folder(spark: SparkSession) -> str:
    """A new folder under the cluster's ``spark.checkpoint.dir``; a local one only where that is unset."""
    top = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext._jsc.sc().getCheckpointDir().getOrElse(None)
    if not top:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        top = tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(top)
    return f"{top}/quernstone-{uuid.uuid4().hex}"


def stash(df: DataFrame, path: str | None = None, arrow_rows: int | None = None) -> DataFrame:
    """Writes df to shared storage and reads it again, which cuts its lineage.

    arrow_rows bounds the rows of an Arrow batch while it is written, for rows
    that hold whole texts.
    """
    spark, key = df.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch"
    path, old = path or shared_folder(spark), spark.conf.get(key)
    if arrow_rows:
        spark.conf.set(key, arrow_rows)
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        spark.conf.set(key, old)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame) -> DataFrame:
    """A stashed df with strings or arrays, to be broadcast up to a checked number of bytes."""
    size = df.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def unstash(df: DataFrame) -> None:
    """Deletes a stashed table that nothing reads any more."""
    spark = df.sparkSession
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def among(df: DataFrame, keys: DataFrame, on: str | Sequence[str], limit: int = BROADCAST_ROWS) -> DataFrame:
    """Rows of df whose key is in `keys` (distinct, stashed): by broadcast up to `limit` keys, else by a shuffle."""
    return df.join(F.broadcast(keys) if keys.count() <= limit else keys, on, "left_semi")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components: (node, component), component being the smallest node.  `edges`: longs a, b.

    Alternates large stars and small stars (Kiveris et al., 2014) until no
    edge changes.  Each round is two aggregations by node and two joins; no
    neighbourhood is ever gathered in one place, and each round is cut off by
    a table on shared storage.
    """

    def star(e: DataFrame, large: bool) -> DataFrame:
        if large:
            e = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = e.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        out = e.join(low, "a")
        if large:
            return out.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return out.where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.where("a > m").select("a", F.col("m").alias("b")))

    def state(e: DataFrame):
        return e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()

    # Pairs are kept as (larger, smaller).
    e = stash(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = state(e)
    for _ in range(max_rounds):
        if not before[0]:
            break
        new = stash(star(star(e, True).distinct(), False).distinct())
        unstash(e)
        e, after = new, state(new)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return e.select(F.col("a").alias("node"), F.col("b").alias("component"))
