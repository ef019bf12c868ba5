"""Semantic roles of columns and categories of tables: ordered decision lists over profile rows.

Each list is one `when` expression built from the configured words and
patterns; the first rule that holds decides.  Keywords are substrings, not
words.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..config import BARE, ProfileConfig

FLAGS = [
    "is_primary_key", "is_composite_primary_key_member", "is_foreign_key", "is_composite_foreign_key_member", "is_unique_constraint",
    "is_composite_unique_constraint_member", "is_indexed", "is_composite_indexed_member",
]
ROLES = ("identifier", "metric", "datetime", "attribute", "audit", "description", "enum", "complex")


def contains_any(text: Column, words: Iterable[str]) -> Column:
    return text.rlike("|".join(re.escape(w) for w in words))


def matches_any(text: Column, patterns: Iterable[str]) -> Column:
    return text.rlike("|".join(f"(?:{p})" for p in patterns))


def first_of(text: Column, words: Iterable[str]) -> Column:
    """The first of the words, in their order, that text contains."""
    out = F.lit(None).cast("string")
    for w in reversed(list(words)):
        out = F.when(text.contains(w), w).otherwise(out)
    return out


def structure_flags(columns: DataFrame, constraints: DataFrame) -> DataFrame:
    """columns with FLAGS: membership in a key of one column and of several exclude each other."""
    part = constraints.select("schema", "table", "kind", F.size("columns").alias("width"), F.explode("columns").alias("column"))
    single = lambda kind: F.max((F.col("kind") == kind) & (F.col("width") == 1))
    several = lambda kind: F.max((F.col("kind") == kind) & (F.col("width") > 1))
    names = dict(zip(("pk", "fk", "uk", "index"), ("primary_key", "foreign_key", "unique_constraint", "indexed"), strict=True))
    found = part.groupBy("schema", "table", "column").agg(*[f(k).alias(f"{p}{n}{s}") for k, n in names.items() for f, p, s in ((single, "is_", ""), (several, "is_composite_", "_member"))])
    out = columns.join(F.broadcast(found), ["schema", "table", "column"], "left")
    for n in names.values():
        one = F.coalesce(f"is_{n}", F.lit(False))
        out = out.withColumns({f"is_{n}": one, f"is_composite_{n}_member": F.coalesce(f"is_composite_{n}_member", F.lit(False)) & ~one})
    return out


def _choose(rules: list[tuple[Column, dict]], otherwise: dict) -> Column:
    """One struct, of the first rule that holds."""
    def make(values: dict) -> Column:
        return F.struct(*[(v if isinstance(v, Column) else F.lit(v)).cast("double" if k == "confidence" else "string").alias(k) for k, v in values.items()])

    out = make(otherwise)
    for on, values in reversed(rules):
        out = F.when(F.coalesce(on, F.lit(False)), make(values)).otherwise(out)
    return out


def role(c: ProfileConfig = BARE) -> Column:
    """(role, confidence, basis) of a row with column, data_type, char_length, scale, flags and statistics."""
    name, kind = F.lower("column"), F.lower("data_type")
    uniq, present = F.coalesce("uniqueness", F.lit(0.0)), 1 - F.coalesce("null_rate", F.lit(0.0))
    one_of = lambda names: kind.isin(*names)

    complex_ = one_of(c.complex_types) | (kind.endswith("[]") if "array" in c.complex_types else F.lit(False))
    may_identify = ~contains_any(name, C.NAME_EXCLUDED) & one_of(C.IDENTIFIER_TYPES) & ~(one_of(("numeric", "decimal")) & (F.coalesce("scale", F.lit(0)) > 0))
    constrained = F.col("is_primary_key") | F.col("is_foreign_key") | F.col("is_unique_constraint")
    stands_out = (uniq > c.high_uniqueness) & (present > c.min_non_null) & ~contains_any(name, C.METRIC_WORDS)
    named = contains_any(name, C.IDENTIFIER_KEYWORDS)

    keyed = F.col("is_primary_key") | F.col("is_composite_primary_key_member") | F.col("is_foreign_key") | F.col("is_composite_foreign_key_member")
    long_text = (kind == "text") | (one_of(("varchar", "character varying", "char", "character")) & (F.coalesce("char_length", F.lit(0)) >= c.description_min_varchar))
    may_describe = ~keyed & ~F.col("is_indexed") & ~F.col("is_composite_indexed_member") & long_text
    std, spread = F.coalesce("length_std", F.lit(0.0)), F.coalesce(F.col("max_length") - F.col("min_length"), F.lit(0))
    varied = (
        ~contains_any(name, C.DESCRIPTION_EXCLUDED) & (F.coalesce("avg_length", F.lit(0.0)) >= c.description_min_avg_length) & (uniq >= c.description_min_uniqueness)
        & (std >= c.description_stable_std) & ((std > c.description_variance_std) | (spread > 100))
    )

    strings = one_of(C.ENUM_STRING_TYPES)
    unique = F.col("is_unique_constraint") | F.col("is_composite_unique_constraint_member") | ((F.col("unique_count") == F.col("sample_count")) & (F.col("sample_count") > 0))
    two_values = (
        ~contains_any(name, C.NAME_EXCLUDED) & (F.col("unique_count") == 2) & (strings | one_of(C.ENUM_INTEGER_TYPES)) & ~keyed & ~unique
        & (F.coalesce("null_rate", F.lit(0.0)) < 0.3) & (F.col("least_count") >= 2) & (~strings | (F.coalesce("longest_value", F.lit(0)) <= 20))
    )
    number, measure = one_of(C.NUMERIC_TYPES), matches_any(name, C.METRIC_PATTERNS)

    rules = [
        (complex_, {"role": "complex", "confidence": 0.95, "basis": "complex_type"}),
        (matches_any(name, C.AUDIT_PATTERNS), {"role": "audit", "confidence": 0.95, "basis": "audit_pattern"}),
        (one_of(c.datetime_types), {"role": "datetime", "confidence": 1.0, "basis": "datetime_type"}),
        (matches_any(name, [f"{s}$" for s in C.DATETIME_SUFFIXES]), {"role": "datetime", "confidence": 0.85, "basis": "datetime_name"}),
        (may_identify & constrained, {"role": "identifier", "confidence": 1.0, "basis": "physical_constraint"}),
        (may_identify & stands_out, {"role": "identifier", "confidence": 0.95, "basis": "logical_primary_key"}),
        (may_identify & named & (uniq > c.low_uniqueness), {"role": "identifier", "confidence": 0.85, "basis": "naming_and_uniqueness"}),
        (may_identify & named, {"role": "identifier", "confidence": 0.75, "basis": "naming_only"}),
        (may_describe & contains_any(name, c.description_keywords), {"role": "description", "confidence": 0.85, "basis": "description_keyword_match"}),
        (may_describe & varied, {"role": "description", "confidence": 0.85, "basis": "description_high_variance"}),
        (two_values, {"role": "enum", "confidence": 0.85, "basis": "simple_two_value_enum"}),
        (number & measure, {"role": "metric", "confidence": 0.95, "basis": "numeric_type,metric_pattern"}),
        (number, {"role": "metric", "confidence": 0.7, "basis": "numeric_type"}),
        (measure, {"role": "metric", "confidence": 0.6, "basis": "metric_pattern"}),
    ]
    return _choose(rules, {"role": "attribute", "confidence": 0.7, "basis": "fallback_attribute"})


def datetime_grain(name: Column) -> Column:
    out = F.lit(None).cast("string")
    for suffix, grain in reversed(C.GRAIN_SUFFIXES):
        out = F.when(F.lower(name).endswith(suffix), grain).otherwise(out)
    return out


def _kind(name: Column, kinds: tuple[tuple[str, tuple[str, ...]], ...], otherwise: str) -> Column:
    """The first kind with a word that the name holds."""
    out = F.lit(otherwise)
    for kind, held in reversed(kinds):
        out = F.when(contains_any(F.lower(name), held), kind).otherwise(out)
    return out


def metric_category(name: Column) -> Column:
    return _kind(name, C.METRIC_KINDS, "metric")


def metric_aggregations(category: Column) -> Column:
    text = lambda *x: F.array(*[F.lit(v) for v in x])
    return F.when(category == "count", text("SUM")).when(category == "ratio", text("AVG")).otherwise(text("SUM", "AVG", "MIN", "MAX"))


def audit_type(name: Column) -> Column:
    return _kind(name, tuple((kind, held) for kind, _, held in C.AUDIT_KINDS), C.AUDIT_OTHER[0])


def audit_purpose(name: Column) -> Column:
    return _kind(name, tuple((purpose, held) for _, purpose, held in C.AUDIT_KINDS), C.AUDIT_OTHER[1])


def column_roles(profiles: DataFrame, c: ProfileConfig = BARE) -> DataFrame:
    """Profile rows (columns, flags and statistics) with role, confidence and basis, and facts of the role."""
    out = profiles.withColumn("_role", role(c))
    role_is = lambda r: F.col("_role.role") == r
    category = F.when(role_is("metric"), metric_category(F.col("column")))
    return out.select(
        *profiles.columns, "_role.role", "_role.confidence", "_role.basis",
        ((F.col("unique_count") == F.col("sample_count")) & (F.col("sample_count") > 0)).alias("is_unique"),
        F.when(role_is("identifier"), ~F.col("is_foreign_key")).alias("is_surrogate"),
        F.when(role_is("identifier"), first_of(F.lower("column"), C.IDENTIFIER_KEYWORDS)).alias("identifier_keyword"),
        F.when(role_is("datetime"), datetime_grain(F.col("column"))).alias("datetime_grain"),
        category.alias("metric_category"), F.when(role_is("metric"), metric_aggregations(category)).alias("metric_aggregations"),
        F.when(role_is("audit"), audit_type(F.col("column"))).alias("audit_type"), F.when(role_is("audit"), audit_purpose(F.col("column"))).alias("audit_purpose"),
        F.when(role_is("enum"), F.map_keys("value_distribution")).alias("enum_values"),
    )


def role_counts(roles: DataFrame) -> DataFrame:
    """Columns of each table by role, and columns in keys."""
    count = lambda on: F.count_if(on).cast("bigint")
    return roles.groupBy("schema", "table").agg(
        F.count("*").alias("total_columns"), *[count(F.col("role") == r).alias(f"{r}_count") for r in ROLES],
        count(F.col("is_primary_key") | F.col("is_composite_primary_key_member")).alias("primary_key_count"),
        count(F.col("is_foreign_key") | F.col("is_composite_foreign_key_member")).alias("foreign_key_count"),
        count(F.col("is_unique_constraint") | F.col("is_composite_unique_constraint_member")).alias("unique_constraint_count"),
    )


def table_category(counts: DataFrame, c: ProfileConfig = BARE) -> DataFrame:
    """role_counts rows with comment and has_key, with category, confidence and basis."""
    name, comment = F.lower("table"), F.coalesce("comment", F.lit(""))
    metrics, ids, times = F.col("metric_count") >= 1, F.col("identifier_count") >= 2, F.col("datetime_count") >= 1
    add = lambda on, v: F.when(on, v).otherwise(0.0)
    listed = lambda *parts: F.concat_ws(",", *[F.when(on, text) for on, text in parts])
    bridge = (F.col("foreign_key_count") >= c.bridge_min_fk_columns) & (F.col("total_columns") <= c.bridge_max_columns) & (F.col("metric_count") <= c.bridge_max_metrics)
    fact = metrics.cast("int") + ids.cast("int") + times.cast("int") >= 2
    dim = F.col("has_key") & (F.col("metric_count") <= 0) & (F.col("identifier_count") >= 1)
    fact_name, fact_comment = matches_any(name, C.FACT_NAMES), contains_any(comment, C.FACT_COMMENTS)
    dim_name, dim_comment = matches_any(name, C.DIM_NAMES), contains_any(comment, C.DIM_COMMENTS)
    fact_score = F.least(F.lit(0.98), 0.6 + add(metrics, 0.15) + add(ids, 0.1) + add(times, 0.1) + add(fact_name, 0.05) + add(fact_comment, 0.05))
    dim_score = F.least(F.lit(0.95), 0.7 + add(F.col("has_key"), 0.15) + add(F.col("metric_count") == 0, 0.1) + add(dim_name, 0.05) + add(dim_comment, 0.05))
    chosen = _choose(
        [
            (bridge, {"category": "bridge", "confidence": 0.85, "basis": "bridge_fk_threshold"}),
            (fact, {"category": "fact", "confidence": F.round(fact_score, 4), "basis": listed((metrics, "fact_has_metric"), (ids, "fact_dimension_columns"), (times, "fact_datetime"), (fact_name, "fact_name_pattern"), (fact_comment, "fact_comment_keyword"))}),
            (dim, {"category": "dim", "confidence": F.round(dim_score, 4), "basis": listed((F.lit(True), "dim_identifier_columns"), (F.col("has_key"), "dim_has_primary_key"), (dim_name, "dim_name_pattern"), (dim_comment, "dim_comment_keyword"))}),
        ],
        {"category": "unknown", "confidence": 0.5, "basis": ""},
    )
    return counts.withColumn("_c", chosen).select(*counts.columns, "_c.category", "_c.confidence", "_c.basis")


def override_category(tables: DataFrame, proposals: DataFrame) -> DataFrame:
    """Categories from outside (schema, table, category, confidence): valid ones win, the rule's are kept beside them."""
    p = proposals.select("schema", "table", F.lower(F.trim("category")).alias("_p"), F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.coalesce("confidence", F.lit(0.9)))).alias("_pc"))
    out = tables.join(F.broadcast(p.where(F.col("_p").isin("fact", "dim", "bridge", "unknown"))), ["schema", "table"], "left")
    out = out.withColumns({"category_rule_based": F.col("category"), "confidence_rule_based": F.col("confidence")})
    return out.withColumns({"category": F.coalesce("_p", "category"), "confidence": F.coalesce("_pc", "confidence")}).drop("_p", "_pc")


def merge_comments(columns: DataFrame, proposals: DataFrame, overwrite: bool = False) -> DataFrame:
    """Comments from outside (schema, table, column, comment): fill blanks, or overwrite with the old one kept."""
    p = proposals.select("schema", "table", "column", F.trim("comment").alias("_p")).where("_p <> ''")
    out = columns.join(F.broadcast(p), ["schema", "table", "column"], "left")
    blank = F.coalesce(F.trim("comment"), F.lit("")) == ""
    use = F.col("_p").isNotNull() & (F.lit(overwrite) | blank)
    return out.withColumns({"comment_before": F.when(use & ~blank, F.col("comment")), "comment": F.when(use, F.col("_p")).otherwise(F.col("comment"))}).drop("_p")
