"""Column statistics: one aggregation for all columns of a table, exact distinct counts where they matter.

Counting distinct values of every column in one aggregate multiplies rows by
columns before the shuffle.  The profile therefore takes two steps: moments and
approximate distinct counts in a pass that shuffles one row for each task, then
exact counts and value distributions for the columns where an exact figure can
change a decision (or for all, on demand).  Median lengths are selected from
counted ranges, in a pass of their own.  Columns of few values are counted
together in one pass; any other one is read by itself and counted in its own
type, and its values are not listed.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import BARE, ProfileConfig
from ..storage import dealt, key_parts
from .medians import medians

STATS = [
    "column", "sample_count", "null_count", "null_rate", "unique_count", "uniqueness", "min_value", "max_value", "mean_value",
    "avg_length", "min_length", "max_length", "median_length", "length_std", "least_count", "longest_value", "value_distribution",
]
_COMPLEX = (T.ArrayType, T.MapType, T.StructType, T.VariantType)
#: Uniqueness near these bounds is counted exactly.
BOUNDS = (0.05, 0.70, 0.80, 0.95, 1.0)


def clean(df: DataFrame, name: str) -> Column:
    """The column with NaN as null and -0.0 as 0.0."""
    c = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, T.FloatType | T.DoubleType):
        return F.when(~F.isnan(c), c + F.lit(0).cast(df.schema[name].dataType))
    return c


def _ordered_maps(c: Column, kind: T.DataType) -> Column:
    """c with every map as a list of its entries by key, so that equal values are written alike."""
    if isinstance(kind, T.MapType):
        entries = F.transform(F.map_entries(c), lambda e: F.struct(e["key"].alias("key"), _ordered_maps(e["value"], kind.valueType).alias("value")))
        return F.array_sort(F.transform(entries, lambda e: F.struct(e["key"].cast("string").alias("key"), F.to_json(F.struct(e["value"].alias("v"))).alias("value"))))
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: _ordered_maps(x, kind.elementType))
    if isinstance(kind, T.StructType):
        fields = sorted(kind.fields, key=lambda f: f.name)
        return F.when(c.isNotNull(), F.struct(*[_ordered_maps(c[f.name], f.dataType).alias(f.name) for f in fields]))
    return c


def comparable(df: DataFrame, name: str) -> Column:
    """A value that can be hashed and compared: complex ones in canonical JSON, list order kept, keys sorted."""
    kind, c = df.schema[name].dataType, clean(df, name)
    if isinstance(kind, T.VariantType):
        return F.to_json(c)
    if isinstance(kind, _COMPLEX):
        return F.when(c.isNotNull(), F.to_json(F.struct(_ordered_maps(c, kind).alias("v")), {"ignoreNullFields": "false"}))
    return c


def null_rate(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: rows, rows with a null in any of the columns, and their share (4 places)."""
    missing = F.greatest(*[clean(df, c).isNull().cast("int") for c in columns]) if len(columns) > 1 else clean(df, columns[0]).isNull().cast("int")
    n = F.count("*")
    return df.agg(n.alias("rows"), F.coalesce(F.sum(missing), F.lit(0)).alias("nulls")).withColumn("null_rate", F.when(F.col("rows") > 0, F.round(F.col("nulls") / F.col("rows"), 4)).otherwise(0.0))


def uniqueness(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: rows, distinct values and their share.  One column leaves nulls out; several count null as a value."""
    value = comparable(df, columns[0]) if len(columns) == 1 else F.struct(*[comparable(df, c).alias(c) for c in columns])
    out = df.agg(F.count("*").alias("rows"), F.count_distinct(value).alias("distinct"))
    return out.withColumn("uniqueness", F.when(F.col("rows") > 0, F.round(F.col("distinct") / F.col("rows"), 4)).otherwise(0.0))


def key_frequencies(df: DataFrame, name: str, parts: int | None = None) -> DataFrame:
    """(value, n) of a column's non-null values: summed before the shuffle, or dealt over so many parts."""
    return dealt(df.select(comparable(df, name).alias("value")).where("value IS NOT NULL"), parts, "value").groupBy("value").agg(F.count("*").alias("n"))


_COUNTED = ("column", "exact", "least_count", "longest_value", "top")


def counted(df: DataFrame, name: str, parts: int | None = None) -> DataFrame:
    """One row of _COUNTED with the number of distinct values; values are only listed where a sketch has seen that they are few."""
    none = F.lit(None)
    return key_frequencies(df, name, parts).agg(F.count("*").alias("exact")).select(F.lit(name).alias("column"), "exact", none.cast("bigint").alias("least_count"), none.cast("bigint").alias("longest_value"), none.cast("array<struct<value:string,n:bigint>>").alias("top"))


def counted_together(df: DataFrame, names: Sequence[str], most: int) -> DataFrame:
    """Rows of _COUNTED of columns that a sketch has seen to have few values: one pass for all of them.

    A row becomes one (column, value) for each column; as the values are few,
    they are summed up in the task before anything is shuffled.
    """
    one = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), comparable(df, c).cast("string").alias("value")) for c in names]))
    each = df.select(one.alias("x")).select("x.*").groupBy("column", "value").agg(F.count("*").alias("n"))
    ranked = F.array_sort(F.collect_list(F.when(F.col("value").isNotNull(), F.struct((-F.col("n")).alias("less"), "value"))))
    top = F.transform(F.slice(ranked, 1, most), lambda x: F.struct(x["value"].alias("value"), (-x["less"]).alias("n")))
    return each.groupBy("column").agg(F.count("value").alias("exact"), F.min(F.when(F.col("value").isNotNull(), F.col("n"))).alias("least_count"), F.max(F.length("value")).cast("bigint").alias("longest_value"), top.alias("top")).select(*_COUNTED)


def distributions(df: DataFrame, columns: Sequence[str], threshold: int = 10, top: int = 10) -> DataFrame:
    """(column, value, n, rank): the most frequent values of each column with at most `threshold` distinct ones; ties go by value."""
    about = df.agg(*[F.approx_count_distinct(comparable(df, c), 0.02) for c in columns]).first()
    few = [c for c, n in zip(columns, about, strict=True) if n <= 4 * threshold]
    if not few:
        return df.sparkSession.createDataFrame([], "column string, value string, n bigint, rank int")
    found = counted_together(df, few, top).where(F.col("exact") <= threshold)
    return found.select("column", F.posexplode("top").alias("rank", "one")).select("column", "one.value", "one.n", (F.col("rank") + 1).alias("rank"))


def _length(df: DataFrame, name: str) -> Column | None:
    """Length of a text, binary or complex value; other columns have none."""
    kind = df.schema[name].dataType
    if isinstance(kind, (T.StringType, T.VarcharType, T.CharType, T.BinaryType, *_COMPLEX)):
        return F.length(clean(df, name) if isinstance(kind, T.StringType | T.BinaryType) else comparable(df, name))
    return None


def _moments(df: DataFrame, name: str) -> Column:
    """A struct of aggregates of one column."""
    kind, c = df.schema[name].dataType, clean(df, name)
    none, text = F.lit(None).cast("double"), F.lit(None).cast("string")
    parts = {"sample_count": F.count("*"), "null_count": F.count("*") - F.count(c)}
    parts["approx"] = F.lit(None).cast("bigint") if isinstance(kind, T.BinaryType) else F.approx_count_distinct(comparable(df, name), 0.02)
    numeric = isinstance(kind, T.NumericType | T.BooleanType)
    value = c.cast("int") if isinstance(kind, T.BooleanType) else c
    parts["min_value"] = F.substring(F.min(c).cast("string"), 1, 100) if numeric else text
    parts["max_value"] = F.substring(F.max(c).cast("string"), 1, 100) if numeric else text
    parts["mean_value"] = F.substring(F.avg(value).cast("string"), 1, 100) if numeric else text
    size = _length(df, name)
    if size is not None:
        parts |= {"avg_length": F.round(F.avg(size), 2), "min_length": F.min(size).cast("bigint"), "max_length": F.max(size).cast("bigint")}
        parts["length_std"] = F.when(F.count(c) > 0, F.round(F.coalesce(F.stddev_samp(size), F.lit(0.0)), 2))
    else:
        parts |= {"avg_length": none, "min_length": none.cast("bigint"), "max_length": none.cast("bigint"), "length_std": none}
    return F.struct(F.lit(name).alias("column"), *[v.alias(k) for k, v in parts.items()]).alias(name)


def needs_exact(rows: int, approx: int | None, threshold: int) -> bool:
    """Whether an approximate distinct count (error 2 %, taken as 8) leaves a decision open."""
    if approx is None or not rows:
        return False
    return approx <= 4 * threshold or any(abs(approx / rows - b) <= 0.08 * max(b, 0.05) + 0.005 for b in BOUNDS)


def profile(df: DataFrame, config: ProfileConfig = BARE, exact: str = "needed", columns: Sequence[str] | None = None, median: bool = True) -> DataFrame:
    """One row for each column, as in STATS.  exact: ``all``, ``needed`` or ``none``; without `median` that length is null and spares a pass.

    An empty table has no rates but 0, no distinct values and no lengths.
    Binary columns are not searched for distinct values.
    """
    if exact not in ("all", "needed", "none"):
        raise ValueError(f"exact is all, needed or none, not {exact!r}")
    columns = list(columns or df.columns)
    one = df.agg(*[_moments(df, c) for c in columns])
    first = one.select(F.inline(F.array(*[F.col(f"`{c}`") for c in columns])))
    sizes = {c: size for c in columns if (size := _length(df, c)) is not None}
    middle = medians(df, sizes) if sizes and median else df.sparkSession.createDataFrame([], "column string, median double")
    few = []
    if exact != "none":
        # One small row for each column comes to the driver, which then plans the second pass.
        known = first.collect()
        first = df.sparkSession.createDataFrame(known, first.schema)
        open_ = [r for r in known if r.approx is not None and (exact == "all" or needs_exact(r.sample_count, r.approx, config.enum_threshold))]
        listed = [r.column for r in open_ if r.approx <= 4 * config.enum_threshold]
        few = [counted(df, r.column, key_parts(df.sparkSession, r.approx, r.sample_count)) for r in open_ if r.column not in listed]
        few += [counted_together(df, listed, config.enum_threshold)] if listed else []
    first = first.join(F.broadcast(middle.withColumnRenamed("median", "median_length")), "column", "left")
    return finish(first, reduce(DataFrame.unionAll, few) if few else None, config)


def finish(first: DataFrame, counts: DataFrame | None, config: ProfileConfig) -> DataFrame:
    """Puts moments and counts together."""
    if counts is None:
        counts = first.sparkSession.createDataFrame([], "column string, exact bigint, least_count bigint, longest_value bigint, top array<struct<value:string,n:bigint>>")
    few = F.col("exact") <= config.enum_threshold
    top = F.map_from_entries(F.when(F.size("top") > 0, F.col("top")))
    counts = counts.select("column", "exact", F.when(few, F.col("least_count")).alias("least_count"), F.when(few, F.col("longest_value")).alias("longest_value"), F.when(few, top).alias("value_distribution"))
    share = lambda n: F.when(F.col("sample_count") > 0, F.round(n / F.col("sample_count"), 4)).otherwise(F.when(n.isNotNull(), F.lit(0.0)))
    unique = F.coalesce("exact", F.least("approx", F.col("sample_count") - F.col("null_count")))
    out = first.join(F.broadcast(counts), "column", "left").withColumn("unique_count", unique)
    return out.withColumns({"null_rate": share(F.col("null_count")), "uniqueness": share(F.col("unique_count"))}).select(*STATS)
