"""Tables on shared storage, which cut a plan's lineage and survive lost executors."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A new folder under the cluster's ``spark.checkpoint.dir``; a local one only where that is unset."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        top = tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(top)
    return f"{top}/quernstone-{uuid.uuid4().hex}"


def written(df: DataFrame, path: str, partition_by: str | None = None) -> DataFrame:
    """df as a Parquet table at path, read again."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Keys that a task may hold while it counts or joins them, some 100 bytes each.
KEYS = 1 << 18


def key_parts(spark: SparkSession, keys: float, rows: float) -> int | None:
    """How many parts `rows` rows of about `keys` distinct keys are dealt over, so that no task holds more than KEYS or so.

    None where Spark's own partitions do, and where keys repeat so often that
    summing them up before the shuffle is what keeps tasks small.
    """
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if rows > 4 * keys or keys <= KEYS * least:
        return None
    # Powers of two, so that joins of tables of about one size share what they shuffle.
    return max(least, 1 << math.ceil(math.log2(keys / KEYS)))


def dealt(df: DataFrame, parts: int | None, *columns: str) -> DataFrame:
    """df in so many parts by the columns; as it is for None."""
    return df.repartition(parts, *columns) if parts else df


def removed(spark: SparkSession, path: str) -> None:
    """Deletes a table that nothing reads any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
