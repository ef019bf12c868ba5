"""Windowed statistics over a stream and drift against a stored profile.

An extension: batch profiles have no streaming counterpart to agree with.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.stats import clean


def windowed_profile(stream: DataFrame, time_col: str, columns: Sequence[str], window: str = "1 hour", slide: str | None = None, late: str = "2 hours") -> DataFrame:
    """(window_start, window_end, column, rows, nulls, approx_distinct, mean) of each window; later rows than `late` are left out.

    Works alike on a stream (append or update mode) and on a table.  One
    stateful aggregation holds all columns, so state grows with windows, not
    with columns times windows.
    """
    numeric = [c for c in columns if isinstance(stream.schema[c].dataType, T.NumericType)]
    parts = []
    for c in columns:
        v = clean(stream, c)
        mean = F.avg(v.cast("double")) if c in numeric else F.avg(F.lit(None).cast("double"))
        parts.append(F.struct(F.lit(c).alias("column"), F.count("*").alias("rows"), (F.count("*") - F.count(v)).alias("nulls"), F.approx_count_distinct(v).alias("approx_distinct"), mean.alias("mean")).alias(f"_{c}"))
    at = F.col(time_col).cast("timestamp")
    timed = stream.withColumn("_at", at).withWatermark("_at", late)
    grouped = timed.groupBy(F.window("_at", window, slide) if slide else F.window("_at", window)).agg(*parts)
    return grouped.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), F.inline(F.array(*[F.col(f"`_{c}`") for c in columns])))


def drift(windows: DataFrame, profile: DataFrame, null_change: float = 0.1, mean_change: float = 0.5) -> DataFrame:
    """Windows beside the stored profile (column, null_rate, mean_value), with flags where they differ by more than allowed."""
    known = F.broadcast(profile.select("column", F.col("null_rate").alias("known_null_rate"), F.expr("try_cast(mean_value AS double)").alias("known_mean")))
    out = windows.join(known, "column").withColumn("null_rate", F.when(F.col("rows") > 0, F.col("nulls") / F.col("rows")).otherwise(0.0))
    moved = F.abs(F.col("mean") - F.col("known_mean")) > mean_change * F.greatest(F.abs("known_mean"), F.lit(1e-9))
    return out.withColumns({"null_drift": F.abs(F.col("null_rate") - F.col("known_null_rate")) > null_change, "mean_drift": F.coalesce(moved, F.lit(False))})
