"""Theta sketches of key columns, and what they say of a relationship before anything is joined.

A sketch keeps the smallest hashes of a column set's values: two of them give
distinct counts, and how many values both share, without the rows.  They are
estimates, so a candidate is left out only if its score stays below the
threshold at the upper end of what the sketches allow, seven standard errors
away; everything else is measured exactly.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .stats import clean

#: Values kept by a sketch are 2 to this power; up to so many distinct ones it is exact.
LG_K = 12
SIGMAS = 7.0
SKETCHES = "table string, columns array<string>, sketch binary"


def canonical_value(df: DataFrame, name: str) -> Column | None:
    """A text that is the same for values that are equal across types; None for types that are compared otherwise."""
    kind, c = df.schema[name].dataType, clean(df, name)
    if isinstance(kind, T.IntegralType):
        return F.concat(F.lit("n"), c.cast("string"))
    if isinstance(kind, T.FloatType | T.DoubleType):
        wide = c.cast("double")
        whole = (wide == F.floor(wide)) & (F.abs(wide) < float(1 << 53))
        return F.concat(F.lit("n"), F.when(whole, wide.cast("bigint").cast("string")).otherwise(wide.cast("string")))
    if isinstance(kind, T.StringType):
        return F.concat(F.lit("s"), c)
    if isinstance(kind, T.TimestampType | T.TimestampNTZType):
        return F.concat(F.lit("t"), c.cast("timestamp_ntz").cast("string"))
    if isinstance(kind, T.DateType | T.BooleanType):
        return F.concat(F.lit(kind.typeName()), c.cast("string"))
    return None


def key_value(df: DataFrame, columns: Sequence[str]) -> Column | None:
    """One text for a column set's values; null if one is null."""
    parts = [canonical_value(df, c) for c in columns]
    if any(p is None for p in parts):
        return None
    return parts[0] if len(parts) == 1 else F.concat(*[x for p in parts for x in (F.length(p).cast("string"), F.lit(":"), p)])


def key_sketches(frames: Mapping[str, DataFrame], sets: Mapping[str, Sequence[Sequence[str]]]) -> DataFrame | None:
    """A row of SKETCHES for each column set that can be sketched: one pass over each table for all of its sets."""
    out = None
    for table, some in sets.items():
        df = frames[table]
        values = {tuple(s): v for s in some if (v := key_value(df, s)) is not None}
        if not values:
            continue
        one = df.agg(*[F.struct(F.array(*map(F.lit, s)).alias("columns"), F.theta_sketch_agg(v, LG_K).alias("sketch")).alias(f"s{i}") for i, (s, v) in enumerate(values.items())])
        rows = one.select(F.lit(table).alias("table"), F.inline(F.array(*[F.col(f"s{i}") for i in range(len(values))])))
        out = rows if out is None else out.unionAll(rows)
    return out


def score_bounds(candidates: DataFrame, sketches: DataFrame, weights: Mapping[str, float]) -> DataFrame:
    """candidates (source, source_columns, target, target_columns, name_similarity, type_compatibility) with score_bound: no score can be higher.  It is null where a side has no sketch."""
    side = lambda t, p: sketches.select(F.col("table").alias(t), F.col("columns").alias(f"{t}_columns"), F.col("sketch").alias(p))
    both = candidates.join(side("source", "_s"), ["source", "source_columns"], "left").join(side("target", "_t"), ["target", "target_columns"], "left")
    n, m, common = F.theta_sketch_estimate("_s"), F.theta_sketch_estimate("_t"), F.theta_sketch_estimate(F.theta_intersection("_s", "_t"))
    both = both.withColumns({"_n": n.cast("double"), "_m": m.cast("double"), "_common": common.cast("double")})
    k, z = float(1 << LG_K), SIGMAS
    # A kept hash stands for `each` values; the count of shared hashes is Poisson at worst.
    each = F.greatest(F.greatest("_n", "_m") / k, F.lit(1.0))
    most = F.when(each <= 1, F.col("_common")).otherwise(F.col("_common") + each * (z * z / 2 + z * F.sqrt(F.col("_common") / each + z * z / 4)))
    least = lambda c: F.when(F.col(c) <= k, F.col(c)).otherwise(F.col(c) * (1 - z / k**0.5))
    both = both.withColumns({"_most": most, "_ln": least("_n"), "_lm": least("_m")})
    union = F.greatest("_ln", "_lm", F.col("_ln") + F.col("_lm") - F.col("_most"))
    share = lambda of: F.when(F.col("_most") <= 0, 0.0).otherwise(F.least(F.lit(1.0), F.try_divide("_most", of)))
    bound = F.lit(weights["inclusion_rate"]) * share(F.col("_ln")) + F.lit(weights["jaccard_index"]) * share(union)
    for name in ("name_similarity", "type_compatibility"):
        bound = bound + F.lit(weights[name]) * F.col(name)
    return both.withColumn("score_bound", F.when(F.col("_s").isNotNull() & F.col("_t").isNotNull(), bound + 1e-9)).drop("_s", "_t", "_n", "_m", "_common", "_most", "_ln", "_lm")
