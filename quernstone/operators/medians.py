"""Exact medians by selection: a counted histogram of ranges, then one refinement of the ranges that hold the middle.

No task holds the values of a group.  Sizes below FINE have a range each, larger
ones share ranges of WIDE sizes, so a group has at most 2 x FINE ranges,
whatever the number of its rows; they are summed in the task before they are
shuffled.  Only where a middle value lies in a wide range are the values of that
range counted one by one, of which there are at most WIDE.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import shared_folder, written

FINE = 1 << 16
WIDE = 1 << 15


def _ranked(counts: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """counts with `before`, the number of smaller ones in a partition, and its `total`."""
    part = Window.partitionBy(*by)
    upto = F.sum("n").over(part.orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return counts.withColumn("before", upto - F.col("n")).withColumn("total", F.sum("n").over(part))


def _middles() -> Column:
    """How many of the two middle ranks (from 0; the same one twice in an odd total) a row holds."""
    holds = lambda rank: ((rank >= F.col("before")) & (rank < F.col("before") + F.col("n"))).cast("int")
    return holds(F.floor((F.col("total") - 1) / 2)) + holds(F.floor(F.col("total") / 2))


def medians(df: DataFrame, sizes: Mapping[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """(by..., column, median): the exact median of each size, an integer from 0 to 2^31 - 1, in each group.

    Nulls are left out; a group without values has no row, so an empty table
    has none.  Null is a group of its own.  A negative size is an error.
    """
    if {"column", "median"} & set(by):
        raise ValueError("groups may not be called column or median")
    spark = df.sparkSession
    value = F.explode(F.array(*[F.struct(F.lit(k).alias("column"), v.cast("bigint").alias("size")) for k, v in sizes.items()]))
    each = df.select(F.struct(F.lit(0).alias("all"), *[F.col(f"`{c}`") for c in by]).alias("group"), value.alias("x")).select("group", "x.*").where("size IS NOT NULL")
    wide = F.lit(FINE) + F.floor((F.col("size") - FINE) / WIDE)
    each = each.withColumn("range", F.when(F.col("size") < 0, F.raise_error(F.lit("a size is negative"))).when(F.col("size") < FINE, F.col("size")).otherwise(wide))

    ranges = each.groupBy("group", "column", "range").agg(F.count("*").alias("n"))
    middle = _ranked(ranges, ["group", "column"], "range").withColumn("middles", _middles()).where("middles > 0")
    # Two rows at most for each column and group.
    middle = written(middle, f"{shared_folder(spark)}/middle") if by else spark.createDataFrame(middle.collect(), middle.schema)
    found = middle.where(F.col("range") < FINE).select("group", "column", F.col("range").alias("size"), "middles")
    open_ = middle.where(F.col("range") >= FINE)
    if open_.take(1):
        bases = open_.select(F.col("group").alias("g"), F.col("column").alias("c"), F.col("range").alias("r"), F.col("before").alias("base"), F.col("total").alias("of"))
        same = F.col("group").eqNullSafe(F.col("g")) & (F.col("column") == F.col("c")) & (F.col("range") == F.col("r"))
        values = each.join(bases, same).groupBy("group", "column", "range", "base", "of", "size").agg(F.count("*").alias("n"))
        ranked = _ranked(values, ["group", "column", "range", "base", "of"], "size").withColumns({"before": F.col("before") + F.col("base"), "total": F.col("of")})
        found = found.unionByName(ranked.withColumn("middles", _middles()).where("middles > 0").select("group", "column", "size", "middles"))
    return found.groupBy("group", "column").agg((F.sum(F.col("size") * F.col("middles")) / 2).alias("median")).select(*[F.col("group")[c].alias(c) for c in by], "column", "median")
