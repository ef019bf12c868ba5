"""Discovering relationships of a profiled catalog."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import RELATIONS, RelationConfig
from ..functions.names import mean_similarity, similarity
from ..functions.types import compatibility
from ..operators import decide as D
from ..operators import metrics as M
from ..operators import namejoin as N
from ..operators import sketches as K
from ..operators.candidates import Candidate, Described, candidates, composite_candidates, without_foreign_keys
from ..storage import key_parts
from .profile import Profile

RELATIONS_META = "seq int, source string, source_columns array<string>, target string, target_columns array<string>, kind string, constraint_name string, name_similarity double, type_compatibility double, exempt boolean, source_constraint string, target_key string, defined_cardinality string"


def describe(p: Profile) -> list[Described]:
    rows = p.columns.orderBy("schema", "table", "ordinal").collect()
    out = []
    for t in p.catalog:
        own = {r.column: r for r in rows if (r.schema, r.table) == (t.schema, t.name)}
        of = lambda k, t=t: [c.columns for c in t.of_kind(k)]
        fks = [(c.columns, *c.ref) for c in t.of_kind("fk")]
        out.append(Described(t.schema, t.name, own, of("pk"), of("uk"), of("index"), fks, p.logical_keys[t.full_name]))
    return out


def _meta(seq: int, c: Candidate, tables: dict[str, Described], alike: Callable, name: str | None = None) -> tuple:
    s, t = tables[c.source], tables[c.target]
    kind = lambda d, x: d.columns[x].data_type if x in d.columns else ""
    one = len(c.source_columns) == 1
    a, b = c.source_columns[0], c.target_columns[0]
    source_constraint = ("single_field_primary_key" if s.single(s.primary_keys, a) else "single_field_unique_constraint" if s.single(s.unique_keys, a) else "single_field_index" if s.single(s.indexes, a) else None) if one else None
    target_key = ("primary_key" if t.single(t.primary_keys, b) else "unique_constraint" if t.single(t.unique_keys, b) else "candidate_logical_key" if t.is_logical(b, 0.8) else None) if one else None
    defined = None
    if c.kind == "foreign_key":
        unique = lambda d, cols: D.columns_unique(cols, [*d.primary_keys, *d.unique_keys], {k: v.uniqueness for k, v in d.columns.items()})
        su, tu = unique(s, c.source_columns), unique(t, c.target_columns)
        defined = "1:1" if su and tu else "1:N" if su else "N:1" if tu else "M:N"
    types = [compatibility(kind(s, x), kind(t, y)) for x, y in zip(c.source_columns, c.target_columns, strict=True)]
    return (
        seq, c.source, list(c.source_columns), c.target, list(c.target_columns), c.kind, name, mean_similarity(c.source_columns, c.target_columns, alike),
        sum(types) / len(types), one and s.is_defined(a), source_constraint, target_key, defined,
    )


def score(p: Profile, found: Sequence[Candidate], c: RelationConfig = RELATIONS, alike: Callable = similarity) -> DataFrame:
    """Candidates with metrics, score, cardinality and id; one plan for all overlaps."""
    spark = p.catalog.spark
    tables = {d.full_name: d for d in describe(p)}
    frame = lambda n: p.catalog[n].frame
    meta = spark.createDataFrame([_meta(i, x, tables, alike) for i, x in enumerate(found)], RELATIONS_META)

    def keys(d: Described, columns: Sequence[str]) -> tuple[float, int]:
        """About how many distinct values a column set has at most, and rows."""
        own = [d.columns[c] for c in columns]
        rows = max(c.sample_count or 0 for c in own)
        return min(rows, math.prod(1.25 * (rows if c.unique_count is None else c.unique_count) + 10 for c in own)), rows

    def parts(x: Candidate) -> int | None:
        return key_parts(spark, *max(keys(tables[x.source], x.source_columns), keys(tables[x.target], x.target_columns)))

    jobs = [(str(i), frame(x.source), x.source_columns, frame(x.target), x.target_columns, parts(x)) for i, x in enumerate(found)]
    measured = M.overlaps(jobs)
    if measured is None:
        measured = spark.createDataFrame([], "relationship_id string, " + ", ".join(f"{m} {'bigint' if m in M.METRICS[:6] else 'double'}" for m in M.METRICS))
    out = meta.join(F.broadcast(measured.withColumnRenamed("relationship_id", "id")), F.col("id").cast("int") == F.col("seq")).drop("id")
    empty = (F.col("source_rows") == 0) | (F.col("target_rows") == 0)
    out = out.withColumns({n: F.when(empty, 0.0).otherwise(F.col(n)) for n in ("name_similarity", "type_compatibility")})
    out = out.withColumn("composite_score", D.score(c.weights)).withColumn("cardinality", D.inferred_cardinality(F.col("source_uniqueness"), F.col("target_uniqueness"), F.col("multiplicity")))
    return out.withColumn("relationship_id", D.relationship_id(F.col("source"), F.col("source_columns"), F.col("target"), F.col("target_columns"), c.salt))


def stated(p: Profile, c: RelationConfig = RELATIONS) -> DataFrame:
    """Foreign keys as relationships: taken as they are, without a score."""
    tables = {d.full_name: d for d in describe(p)}
    rows = []
    for t in p.catalog:
        for k in t.of_kind("fk"):
            target = f"{k.ref[0]}.{k.ref[1]}"
            if target in tables:
                rows.append(_meta(len(rows), Candidate(t.full_name, k.columns, target, k.ref[2], "foreign_key"), tables, similarity, k.name))
    out = p.catalog.spark.createDataFrame(rows, RELATIONS_META)
    none = {m: F.lit(None).cast("bigint" if m in M.METRICS[:6] else "double") for m in M.METRICS}
    out = out.withColumns(none | {n: F.lit(None).cast("double") for n in ("name_similarity", "type_compatibility", "composite_score")}).withColumn("cardinality", F.col("defined_cardinality"))
    return out.withColumn("relationship_id", D.relationship_id(F.col("source"), F.col("source_columns"), F.col("target"), F.col("target_columns"), c.salt))


def joined_candidates(p: Profile, c: RelationConfig = RELATIONS) -> DataFrame:
    """source, source_column, target, target_column, kind, name_similarity and places: what single_candidates gives, by joins.

    For catalogs of many tables: distinct names are joined by similarity, once
    for columns that are keys and once for others, and pairs of names lead to
    pairs of columns.
    """
    spark = p.catalog.spark
    rows = []
    for i, t in enumerate(describe(p)):
        for j, (n, col) in enumerate(t.columns.items()):
            defined, logical = t.is_defined(n), t.is_logical(n, c.min_confidence)
            kind = "single_logical_key" if not defined else "single_defined_constraint" + "_and_logical_pk" * logical
            rows.append((i, j, t.full_name, n, n.strip().lower(), col.data_type, col.role, defined or logical, defined or any(n in k for k in t.indexes), kind))
    columns = spark.createDataFrame(rows, "at int, place int, table string, column string, name string, type string, role string, key boolean, exempt boolean, kind string")
    keys, others = columns.where("key"), columns.where("NOT key")
    alike = N.similar_names(keys, keys, c.name_key_like).withColumn("key", F.lit(True)).unionAll(N.similar_names(keys, others, c.name_other).withColumn("key", F.lit(False)))
    kinds = [r.type for r in columns.select("type").distinct().collect()]
    fits = spark.createDataFrame([(a, b) for a in kinds for b in kinds if compatibility(a, b) >= c.type_min], "s_type string, t_type string")
    side = lambda df, x: df.select(*[F.col(n).alias(f"{x}_{n}") for n in df.columns])
    s, t = side(keys, "s"), side(columns, "t")
    pairs = alike.join(s, F.col("a") == F.col("s_name")).join(t, (F.col("b") == F.col("t_name")) & (F.col("key") == F.col("t_key")))
    pairs = pairs.where((F.col("s_table") != F.col("t_table")) & (F.col("t_exempt") | (F.lower("s_column") == F.lower("t_column")) | ~F.coalesce(F.col("t_role").isin(*c.single_excluded_roles), F.lit(False))))
    pairs = pairs.join(F.broadcast(fits), ["s_type", "t_type"])
    return pairs.select(
        F.col("s_table").alias("source"), F.col("s_column").alias("source_column"), F.col("t_table").alias("target"), F.col("t_column").alias("target_column"),
        F.col("s_kind").alias("kind"), F.col("ratio").alias("name_similarity"), "s_at", "s_place", "t_at", "t_place",
    )


#: Pairs of a key and a column above which names are joined in Spark; below, comparing them takes less than a job does.
NAME_PAIRS = 200_000


def found_candidates(p: Profile, c: RelationConfig = RELATIONS, alike: Callable = similarity, pairs: int = NAME_PAIRS) -> list[Candidate]:
    """As candidates gives them, in the same order, by a join of the names where there are many."""
    tables = describe(p)
    keys = sum(t.is_defined(n) or t.is_logical(n, c.min_confidence) for t in tables for n in t.columns)
    if alike is not similarity or keys * sum(len(t.columns) for t in tables) <= pairs:
        return candidates(tables, c, alike)
    rows = joined_candidates(p, c).orderBy("s_at", "s_place", "t_at", "t_place").collect()
    single = [Candidate(r.source, (r.source_column,), r.target, (r.target_column,), r.kind) for r in rows]
    return without_foreign_keys([*composite_candidates(tables, c, alike), *single], tables, c.legacy_fk_dedup)


def excluded_by_sketches(p: Profile, found: Sequence[Candidate], c: RelationConfig = RELATIONS, alike: Callable = similarity) -> dict[int, float]:
    """Places of candidates whose score cannot reach the threshold, with the highest score they can have.

    The profile keeps the sketches, so a column set is read once for all calls.
    """
    sets = {}
    for x in found:
        for table, columns in ((x.source, x.source_columns), (x.target, x.target_columns)):
            sets.setdefault(table, set()).add(tuple(columns))
    have = {(r.table, tuple(r.columns)) for r in p.sketches}
    new = {t: sorted(s for s in some if (t, s) not in have) for t, some in sets.items()}
    made = K.key_sketches({t: p.catalog[t].frame for t in new}, {t: some for t, some in new.items() if some})
    p.sketches.extend(made.collect() if made is not None else [])
    if not found:
        return {}
    tables = {d.full_name: d for d in describe(p)}
    spark = p.catalog.spark
    meta = spark.createDataFrame([_meta(i, x, tables, alike) for i, x in enumerate(found)], RELATIONS_META)
    bounds = K.score_bounds(meta, spark.createDataFrame(p.sketches, K.SKETCHES), c.weights)
    margin = 5e-5 if c.round_before_threshold else 0.0
    return {r.seq: r.score_bound for r in bounds.where(F.col("score_bound") < c.threshold - margin).select("seq", "score_bound").collect()}


def decisions(p: Profile, c: RelationConfig = RELATIONS, alike: Callable = similarity) -> DataFrame:
    """relationship_id, source, source_columns, target, target_columns, decision, reason and score_bound of all candidates, as discover gives them.

    Candidates that sketches exclude are rejected without being measured:
    their composite_score is null, and score_bound tells what it is below.
    """
    found = found_candidates(p, c, alike)
    out_ = excluded_by_sketches(p, found, c, alike)
    kept = ["relationship_id", "source", "source_columns", "target", "target_columns", "composite_score", "decision", "reason", "score_bound", "seq"]
    rest = [x for i, x in enumerate(found) if i not in out_]
    measured = D.decide(score(p, rest, c, alike), c).withColumn("score_bound", F.lit(None).cast("double")).select(*kept)
    rows = [(x.source, list(x.source_columns), x.target, list(x.target_columns), bound, -1) for i, bound in out_.items() for x in [found[i]]]
    left = p.catalog.spark.createDataFrame(rows, "source string, source_columns array<string>, target string, target_columns array<string>, score_bound double, seq int")
    left = left.withColumns({"relationship_id": D.relationship_id(F.col("source"), F.col("source_columns"), F.col("target"), F.col("target_columns"), c.salt), "composite_score": F.lit(None).cast("double"), "decision": F.lit("rejected"), "reason": F.lit("below_threshold")})
    return D.first_wins(measured.unionByName(left.select(*kept)), ["seq"]).drop("seq")


def discover(p: Profile, c: RelationConfig = RELATIONS, alike: Callable = similarity, proposed: Sequence[Candidate] = ()) -> DataFrame:
    """All relationships with decision and reason: foreign keys first, then candidates by rule and proposed ones.

    Of candidates with the same id the first wins.  Foreign keys are accepted
    without a score.
    """
    found = [*found_candidates(p, c, alike), *proposed]
    scored = D.decide(D.first_wins(score(p, found, c, alike), ["seq"]), c)
    keys = stated(p, c).withColumns({"reason": F.lit(None).cast("string"), "decision": F.lit("accepted")})
    both = keys.unionByName(scored)
    both = D.first_wins(both.withColumn("_fk", (F.col("kind") != "foreign_key").cast("int")), ["_fk", "seq"]).drop("_fk")
    return D.discovery(both).withColumn("confidence_level", F.when(F.col("composite_score").isNotNull(), D.confidence_level(F.col("composite_score"))))
