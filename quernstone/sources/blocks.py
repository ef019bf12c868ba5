"""Random samples of Parquet tables by blocks: whole row groups, so that what is read follows the fraction.

A sample of rows reads the whole table and throws most of it away.  Here the
footers give the row groups and their rows; groups are taken in the order of
a hash of seed, file and number until they hold the wanted number of rows, and
of the last one only a run of rows from a place that the hash gives.  Rows that
stand together are drawn together: for means and counts of a table in random
order that is a random sample, for a sorted one a sample of its blocks.

Footers are read by tasks and the rows by others; the driver lists names only.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..storage import shared_folder, written

BLOCKS = "path string, block int, rows bigint, bytes bigint"
#: Row groups are summed by this many lanes of their hash before they are ordered.
LANES = 1 << 16
BATCH = 4096


def _open(uri: str) -> pq.ParquetFile:
    fs, path = pafs.FileSystem.from_uri(uri)
    return pq.ParquetFile(fs.open_input_file(path), coerce_int96_timestamp_unit="us")


def row_groups(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """path, block, rows, bytes of every row group of a file or folder; bytes are the compressed ones of the columns."""
    source = spark.read.parquet(path)
    wanted = set(columns or source.columns)
    files = sorted(source.inputFiles())
    if not files:
        return spark.createDataFrame([], BLOCKS)

    def run(batches):
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                with _open(uri) as file:
                    groups = [file.metadata.row_group(g) for g in range(file.metadata.num_row_groups)]
                size = [sum(c.total_compressed_size for c in map(g.column, range(g.num_columns)) if c.path_in_schema.split(".")[0] in wanted) for g in groups]
                yield pa.RecordBatch.from_arrays([pa.array([uri] * len(groups), pa.string()), pa.array(range(len(groups)), pa.int32()), pa.array([g.num_rows for g in groups], pa.int64()), pa.array(size, pa.int64())], names=["path", "block", "rows", "bytes"])

    names = spark.createDataFrame([(f,) for f in files], "path string")
    return names.repartition(min(len(files), 4 * spark.sparkContext.defaultParallelism)).mapInArrow(run, BLOCKS)


def choose_blocks(blocks: DataFrame, fraction: float, seed: int = 0) -> DataFrame:
    """Row groups of a sample of ceil(fraction x rows) rows, with start and take: the run of rows to read of each.

    Groups are summed by lanes of their hash; only the lane in which the number
    is reached is looked at group by group.
    """
    if not 0 <= fraction <= 1:
        raise ValueError(f"a fraction is from 0 to 1, not {fraction}")
    number = lambda at: F.conv(F.substring(F.sha2(F.concat_ws(":", F.lit(str(seed)), F.element_at(F.split("path", "/"), -1), "block"), 256), at, 8), 16, 10).cast("bigint")
    placed = blocks.where("rows > 0").select("*", number(1).alias("place"), number(9).alias("at")).withColumn("lane", F.col("place") % LANES)
    # One window over the lanes: at most LANES rows.
    lanes = placed.groupBy("lane").agg(F.sum("rows").alias("lane_rows"))
    upto = F.sum("lane_rows").over(Window.orderBy("lane").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # The product is rounded first: a share such as 0.1 is not exact in binary.
    target = F.ceil(F.round(F.sum("lane_rows").over(Window.partitionBy()) * F.lit(float(fraction)), 6))
    lanes = lanes.select("lane", (upto - F.col("lane_rows")).alias("lane_before"), target.alias("target")).where("lane_before < target")
    inside = Window.partitionBy("lane").orderBy("place", "path", "block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = placed.join(F.broadcast(lanes), "lane").withColumn("before", F.col("lane_before") + F.sum("rows").over(inside) - F.col("rows")).where("before < target")
    take = F.least("rows", F.col("target") - F.col("before"))
    return ranked.withColumn("take", take).withColumn("start", F.col("at") % (F.col("rows") - F.col("take") + 1)).select("path", "block", "rows", "bytes", "start", "take")


def _runs(schema: T.StructType, opener: Callable = _open) -> Callable:
    """Reads runs of rows (path, block, start, take), by path, with the columns of schema."""
    arrow = to_arrow_schema(schema)

    def run(batches):
        # A footer names all row groups of its file, so a task reads it once, not once for each group.
        name, file = None, None
        try:
            for batch in batches:
                for r in batch.to_pylist():
                    if r["path"] != name:
                        if file:
                            file.close()
                        name, file = r["path"], opener(r["path"])
                    at, end = 0, r["start"] + r["take"]
                    for part in file.iter_batches(BATCH, row_groups=[r["block"]], columns=schema.names):
                        some = part.slice(max(0, r["start"] - at), max(0, min(part.num_rows, end - at) - max(0, r["start"] - at)))
                        if some.num_rows:
                            yield from pa.Table.from_batches([some]).select(schema.names).cast(arrow).to_batches()
                        at += part.num_rows
                        if at >= end:
                            break
        finally:
            if file:
                file.close()

    return run


def read_blocks(spark: SparkSession, path: str, chosen: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The chosen runs of rows of a table, with these columns (all if none are named); the rest of the file is not read."""
    schema = spark.read.parquet(path).select(*[F.col(f"`{c}`") for c in columns or ()] or ["*"]).schema
    chosen = written(chosen, f"{shared_folder(spark)}/blocks")
    n = max(1, min(chosen.count(), 8 * spark.sparkContext.defaultParallelism))

    # Neighbours go to one task, so that few tasks open the same file.
    return chosen.select("path", "block", "start", "take").repartitionByRange(n, "path", "block").sortWithinPartitions("path", "block").mapInArrow(_runs(schema), schema)


def block_sample(spark: SparkSession, path: str, fraction: float, seed: int = 0, columns: Sequence[str] | None = None) -> DataFrame:
    """ceil(fraction x rows) rows of a Parquet file or folder, the same ones for the same seed and files.

    0 gives no rows, 1 gives all; an empty table gives an empty sample.  Rows
    are neither changed nor repeated: nulls and equal rows come as they stand.
    Folders by partition value are an error, as their files lack those columns.
    """
    source = spark.read.parquet(path)
    if any(f"/{c}=" in f for f in source.inputFiles()[:1] for c in source.columns):
        raise ValueError(f"{path} is partitioned by value; sample its folders one by one")
    return read_blocks(spark, path, choose_blocks(row_groups(spark, path, columns), fraction, seed), columns)
