"""Scores, cardinalities, decisions and identities of relationships, as expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import RELATIONS, RelationConfig

HIGH, LOW, FEW, MANY, MOSTLY = 0.95, 0.80, 1.1, 1.5, 0.85


def relationship_id(source: Column, source_columns: Column, target: Column, target_columns: Column, salt: str = "") -> Column:
    """rel_ and 12 hex digits of the MD5 of both ends, columns sorted; source and target are schema.table."""
    side = lambda t, c: F.concat(t, F.lit(".["), F.array_join(F.array_sort(c), ","), F.lit("]"))
    return F.concat(F.lit("rel_"), F.substring(F.md5(F.concat(side(source, source_columns), F.lit("->"), side(target, target_columns), F.lit(salt))), 1, 12))


def score(weights: dict[str, float]) -> Column:
    out = F.lit(0.0)
    for name, w in weights.items():
        out = out + F.lit(w) * F.col(name)
    return out


def inferred_cardinality(su: Column, tu: Column, m: Column) -> Column:
    """From the uniqueness of both sides, then from how many rows a source row joins."""
    return (
        F.when((su >= HIGH) & (tu >= HIGH), "1:1").when((su >= HIGH) & (tu < LOW), "1:N").when((su < LOW) & (tu >= HIGH), "N:1")
        .when((m <= FEW) & (su >= tu), "1:1").when(m <= FEW, "N:1").when((m > MANY) & (su >= MOSTLY), "1:N").otherwise("M:N")
    )


def needs_join(su: float, tu: float) -> bool:
    """Whether uniqueness alone leaves the cardinality open."""
    return not ((su >= HIGH and (tu >= HIGH or tu < LOW)) or (su < LOW and tu >= HIGH))


def defined_cardinality(source_unique: Column, target_unique: Column) -> Column:
    return F.when(source_unique & target_unique, "1:1").when(source_unique, "1:N").when(target_unique, "N:1").otherwise("M:N")


def confidence_level(s: Column) -> Column:
    return F.when(s >= 0.90, "high").when(s >= 0.80, "medium").otherwise("low")


def columns_unique(columns: Sequence[str], keys: Sequence[Sequence[str]], uniqueness: dict[str, float]) -> bool:
    """A key on just these columns, or every column unique enough by itself."""
    return any(set(k) == set(columns) for k in keys) or min((uniqueness.get(c) or 0.0 for c in columns), default=0.0) >= HIGH


def decide(scored: DataFrame, c: RelationConfig = RELATIONS) -> DataFrame:
    """scored with decision (accepted or rejected) and reason.

    scored: source, target, source_columns, composite_score, exempt.  Below the
    threshold everything is rejected; then, where a composite of the same
    directed pair of tables was accepted, singles go unless they are exempt
    (their source column is a key by constraint).
    """
    s = F.round("composite_score", 4) if c.round_before_threshold else F.col("composite_score")
    passed, several = s >= c.threshold, F.size("source_columns") > 1
    out = scored.withColumns({"_passed": passed, "_several": several})
    pair = Window.partitionBy("source", "target")
    beside = F.coalesce(F.max(F.col("_passed") & F.col("_several")).over(pair), F.lit(False))
    hidden = F.lit(c.suppress_singles) & beside & ~F.col("_several") & ~F.coalesce("exempt", F.lit(False))
    reason = F.when(~F.col("_passed"), "below_threshold").when(hidden, "suppressed_by_composite")
    return out.withColumn("reason", reason).withColumn("decision", F.when(F.col("reason").isNull(), "accepted").otherwise("rejected")).drop("_passed", "_several")


def discovery(relations: DataFrame) -> DataFrame:
    """relations (kind, source_constraint, target_key) with discovery_method and target_source_type."""
    k = F.col("kind")
    searched = k.isin("single_defined_constraint", "single_defined_constraint_and_logical_pk")
    logical = k.isin("single_logical_key", "composite_logical")
    method = (
        F.when(k == "foreign_key", "foreign_key_constraint").when(searched, "active_search").when(logical, "logical_key_matching")
        .when(k == "composite_physical", "physical_constraint_matching").when(k == "llm_assisted", "llm_assisted").otherwise("standard_matching")
    )
    target = (
        F.when(k == "foreign_key", "foreign_key").when(searched, F.col("target_key")).when(logical, "candidate_logical_key")
        .when(k == "composite_physical", "physical_constraints").when(k == "llm_assisted", "llm_inferred")
    )
    return relations.withColumns({"discovery_method": method, "target_source_type": target, "source_constraint": F.when(searched, F.col("source_constraint"))})


def statistics(decided: DataFrame) -> DataFrame:
    """One row of totals; both counters of discoveries follow the discovery method."""
    accepted = F.col("decision") == "accepted"
    several = F.size("source_columns") > 1
    count = lambda on: F.count_if(on)
    return decided.agg(
        count(accepted).alias("total_relationships"), count(accepted & (F.col("kind") == "foreign_key")).alias("foreign_keys"), count(accepted & several).alias("composite"),
        count(accepted & ~several).alias("single"), count(accepted & (F.col("discovery_method") == "active_search")).alias("active_search"),
        count(F.col("reason") == "below_threshold").alias("below_threshold"), count(F.col("reason") == "suppressed_by_composite").alias("suppressed"),
        count(accepted & (F.col("composite_score") >= 0.90)).alias("high_confidence"), count(accepted & (F.col("composite_score") >= 0.80) & (F.col("composite_score") < 0.90)).alias("medium_confidence"),
    )


def first_wins(relations: DataFrame, order: Sequence[str]) -> DataFrame:
    """One relation for each id: the first by the given columns."""
    return relations.withColumn("_n", F.row_number().over(Window.partitionBy("relationship_id").orderBy(*order))).where("_n = 1").drop("_n")
