"""Profiling a catalog: statistics, roles, logical keys, categories."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import BARE, ProfileConfig
from ..operators import keys as K
from ..operators import roles as R
from ..operators import stats as S
from ..sources.catalog import Catalog, Table, head_sample


@dataclass
class Profile:
    """Frames of metadata size: columns (statistics, flags and roles), tables (counts and categories) and logical keys; sketches of key columns as they were asked for."""

    catalog: Catalog
    columns: DataFrame
    tables: DataFrame
    keys: DataFrame
    logical_keys: dict[str, list[K.LogicalKey]]
    failed: dict[str, str]
    sketches: list = field(default_factory=list)


def described(columns: DataFrame, constraints: DataFrame, statistics: DataFrame) -> DataFrame:
    """Catalog columns with flags and statistics (schema, table, STATS)."""
    return R.structure_flags(columns, constraints).join(F.broadcast(statistics), ["schema", "table", "column"], "left")


def statistics(t: Table, config: ProfileConfig, exact: str, sample: int | None) -> DataFrame:
    df = t.frame if sample is None else head_sample(t.frame, sample, t.frame.columns[:1])
    return S.profile(df, config, exact).select(F.lit(t.schema).alias("schema"), F.lit(t.name).alias("table"), "*")


def profile_catalog(catalog: Catalog, config: ProfileConfig = BARE, exact: str = "needed", sample: int | None = None, workers: int = 4) -> Profile:
    """Profiles all tables, `workers` at a time, so small tables do not wait for each other.  Full tables by default; `sample` rows, the first by the first column, for a quick look.

    Each table has one status: it is profiled or it is in `failed` with its
    error.  What is collected are rows of metadata, one for each column.
    """
    spark, rows, failed = catalog.spark, [], {}
    schema = None

    def one(t: Table):
        try:
            stats = statistics(t, config, exact, sample)
            return stats.schema, stats.collect(), None
        except Exception as e:
            return None, [], f"{type(e).__name__}: {e}".splitlines()[0]

    with ThreadPoolExecutor(workers) as pool:
        for t, (kind, got, error) in zip(catalog, pool.map(one, catalog), strict=True):
            schema, rows = kind or schema, rows + got
            if error:
                failed[t.full_name] = error
    good = Catalog(spark, [t for t in catalog if t.full_name not in failed])
    if schema is None:
        raise ValueError(f"no table could be profiled: {failed}")
    stats = spark.createDataFrame(rows, schema)
    roles = R.column_roles(described(good.columns_frame(), good.constraints_frame(), stats), config)
    collected = roles.orderBy("schema", "table", "ordinal").collect()
    columns = spark.createDataFrame(collected, roles.schema)

    def keys_of(t: Table) -> list[K.LogicalKey]:
        mine = [r for r in collected if (r.schema, r.table) == (t.schema, t.name)]
        return K.logical_keys(t.frame if sample is None else head_sample(t.frame, sample, t.frame.columns[:1]), mine, config, bool(t.of_kind("pk")))

    with ThreadPoolExecutor(workers) as pool:
        logical = {t.full_name: k for t, k in zip(good, pool.map(keys_of, good), strict=True)}
    found = [(*n.split(".", 1), list(k.columns), k.confidence, k.uniqueness, k.null_rate) for n, ks in logical.items() for k in ks]
    keys = spark.createDataFrame(found, K.KEYS)
    keyed = keys.select("schema", "table").union(good.constraints_frame().where("kind = 'pk'").select("schema", "table")).distinct().withColumn("has_key", F.lit(True))
    counts = R.role_counts(columns).join(good.tables_frame(), ["schema", "table"]).join(F.broadcast(keyed), ["schema", "table"], "left").withColumn("has_key", F.coalesce("has_key", F.lit(False)))
    return Profile(good, columns, R.table_category(counts, config), keys, logical, failed)
