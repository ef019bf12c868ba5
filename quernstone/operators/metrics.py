"""How two column sets overlap: one job for each relationship, on key counts instead of rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.types import canonical, compatibility
from ..storage import dealt, shared_folder, written
from .stats import comparable

#: Relationships that are measured in one plan.
BATCH = 64
METRICS = ["source_rows", "target_rows", "source_distinct", "target_distinct", "common", "joined_rows", "inclusion_rate", "jaccard_index", "source_uniqueness", "target_uniqueness", "multiplicity"]


def comparable_types(a: T.DataType, b: T.DataType) -> str | None:
    """The type in which values of both are compared; None where they never are equal."""
    if a == b:
        return None if isinstance(a, T.MapType | T.ArrayType | T.StructType | T.VariantType) else a.simpleString()
    if compatibility(canonical(a)[0], canonical(b)[0]) <= 0:
        return None
    if isinstance(a, T.DateType) != isinstance(b, T.DateType):
        return None
    if isinstance(a, T.FloatType | T.DoubleType) or isinstance(b, T.FloatType | T.DoubleType):
        return "double"
    if isinstance(a, T.DecimalType) or isinstance(b, T.DecimalType):
        return "decimal(38,10)"
    if isinstance(a, T.StringType):
        return "string"
    if isinstance(a, T.TimestampType | T.TimestampNTZType):
        return "timestamp_ntz"
    return "bigint"


def key_counts(df: DataFrame, columns: Sequence[str], kinds: Sequence[str] | None = None, parts: int | None = None) -> DataFrame:
    """(k0, k1, ..., n): how often each value set without a null occurs, counted in so many parts."""
    kinds = kinds or [None] * len(columns)
    keys = [(comparable(df, c) if k is None else comparable(df, c).cast(k)).alias(f"k{i}") for i, (c, k) in enumerate(zip(columns, kinds, strict=True))]
    names = [f"k{i}" for i in range(len(columns))]
    return dealt(df.select(*keys).na.drop("any", subset=names), parts, *names).groupBy(*names).agg(F.count("*").alias("n"))


def overlap(source: DataFrame, source_columns: Sequence[str], target: DataFrame, target_columns: Sequence[str], parts: int | None = None) -> DataFrame:
    """One row of METRICS.

    Both sides are reduced to key counts, map-side first, so a hot key is one
    row before the join.  One full outer join of the counts gives distinct
    counts, intersection, union and the size of the row join, which is the sum
    of the products of the counts.  With `parts` (of storage.key_parts) rows of
    nearly unique keys are dealt over so many tasks first.  A side without a complete key makes all
    rates 0 and the multiplicity 1.
    """
    kinds = [comparable_types(source.schema[a].dataType, target.schema[b].dataType) for a, b in zip(source_columns, target_columns, strict=True)]
    never = any(k is None and not source.schema[a].dataType == target.schema[b].dataType for k, a, b in zip(kinds, source_columns, target_columns, strict=True))
    names = [f"k{i}" for i in range(len(kinds))]
    s = key_counts(source, source_columns, None if never else kinds, parts).withColumnRenamed("n", "s")
    t = key_counts(target, target_columns, None if never else kinds, parts).withColumnRenamed("n", "t")
    if never:
        zero = F.lit(None).cast("bigint")
        both = s.select("s", zero.alias("t")).unionAll(t.select(zero.alias("s"), "t"))
    else:
        both = s.join(t, names, "full").select("s", "t")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    counts = both.agg(
        total("s").alias("source_rows"), total("t").alias("target_rows"), F.count("s").alias("source_distinct"), F.count("t").alias("target_distinct"),
        F.count_if(F.col("s").isNotNull() & F.col("t").isNotNull()).alias("common"), total(F.col("s") * F.col("t")).alias("joined_rows"),
    )
    some = (F.col("source_rows") > 0) & (F.col("target_rows") > 0)
    rate = lambda a, b, empty=0.0: F.when(some, a / b).otherwise(empty)
    return counts.select(
        "*",
        rate(F.col("common"), F.col("source_distinct")).alias("inclusion_rate"),
        rate(F.col("common"), F.col("source_distinct") + F.col("target_distinct") - F.col("common")).alias("jaccard_index"),
        rate(F.col("source_distinct"), F.col("source_rows")).alias("source_uniqueness"),
        rate(F.col("target_distinct"), F.col("target_rows")).alias("target_uniqueness"),
        rate(F.col("joined_rows"), F.col("source_rows"), 1.0).alias("multiplicity"),
    )


def overlaps(pairs: Sequence[tuple], batch: int = BATCH) -> DataFrame | None:
    """(id, METRICS) of many relationships; None for none.

    pairs: id, source, its columns, target, its columns and, if known, the parts that overlap takes.

    Up to `batch` of them are one plan, in which scans and key counts that
    recur are computed once (exchange reuse).  More are measured in such
    batches, a table on shared storage each, so that no plan grows with their
    number; relationships of one key follow each other and share its counts.
    """
    if not pairs:
        return None

    def plan(some) -> DataFrame:
        return reduce(DataFrame.unionAll, [overlap(*of).select(F.lit(name).alias("relationship_id"), "*") for name, *of in some])

    if len(pairs) <= batch:
        return plan(pairs)
    spark = pairs[0][1].sparkSession
    folder = shared_folder(spark)
    near = sorted(pairs, key=lambda p: (sorted(p[4]), sorted(p[2]), p[0]))
    done = [written(plan(near[i : i + batch]), f"{folder}/{i}") for i in range(0, len(near), batch)]
    return spark.read.schema(done[0].schema).parquet(*[f"{folder}/{i}" for i in range(0, len(near), batch)])
