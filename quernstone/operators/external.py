"""Candidates from outside, such as a language model's: read from its reply, checked, and handed on as rows."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CANDIDATES = "source string, source_columns array<string>, target string, target_columns array<string>, seq int"


def objects_in(text: str) -> Iterable[object]:
    """JSON values in a reply: in code fences first, then wherever one begins."""
    decoder = json.JSONDecoder()
    fenced = re.findall(r"```(?:json)?\s*(.*?)```", text, flags=re.DOTALL | re.IGNORECASE)
    for part in [*fenced, text]:
        at = 0
        while (m := re.compile(r"[\[{]").search(part, at)) is not None:
            try:
                value, end = decoder.raw_decode(part, m.start())
            except ValueError:
                at = m.start() + 1
                continue
            yield value
            at = end


def relationships_in(text: str | None) -> list[dict]:
    """The list under ``relationships`` of the first object that has one; nothing otherwise."""
    for value in objects_in(text or ""):
        if isinstance(value, dict) and isinstance(value.get("relationships"), list):
            return [r for r in value["relationships"] if isinstance(r, dict)]
    return []


def list_in(text: str | None) -> list:
    return next((v for v in objects_in(text or "") if isinstance(v, list)), [])


def ends(relation: dict) -> tuple[str, tuple[str, ...], str, tuple[str, ...]] | None:
    """(source, columns, target, columns) of a relation object; None if it names no columns or unlike many."""
    name = lambda t: f"{t.get('schema') or 'public'}.{t.get('table') or ''}" if isinstance(t, dict) else str(t or "")
    cols = lambda side: tuple(str(c) for c in (relation.get(f"{side}_columns") or ([relation[f"{side}_column"]] if relation.get(f"{side}_column") else [])))
    a, b = cols("from"), cols("to")
    return (name(relation.get("from_table")), a, name(relation.get("to_table")), b) if a and len(a) == len(b) else None


def candidate_rows(spark: SparkSession, replies: Sequence[tuple[tuple[str, str], str]]) -> DataFrame:
    """Candidates of replies, each to a prompt about a pair of tables.

    Left out: a table joined to itself on the same columns, and tables other
    than the pair's.
    """
    rows = []
    for pair, text in replies:
        asked = {t.lower() for t in pair}
        for r in relationships_in(text):
            e = ends(r)
            if e is None or not {e[0].lower(), e[2].lower()} <= asked:
                continue
            if e[0].lower() == e[2].lower() and sorted(c.lower() for c in e[1]) == sorted(c.lower() for c in e[3]):
                continue
            rows.append((e[0], list(e[1]), e[2], list(e[3]), len(rows)))
    return spark.createDataFrame(rows, CANDIDATES)


def canonical_names(candidates: DataFrame, columns: DataFrame) -> DataFrame:
    """Table and column names in the catalog's spelling; names that it lacks stay as they are."""
    known = F.broadcast(columns.select(F.concat_ws(".", "schema", "table").alias("t"), "column").groupBy("t").agg(F.map_from_entries(F.collect_list(F.struct(F.lower("column"), F.col("column")))).alias("names")).withColumn("k", F.lower("t")))
    out = candidates
    for side in ("source", "target"):
        out = out.join(known.select("k", F.col("t").alias("_t"), F.col("names").alias("_n")), F.lower(side) == F.col("k"), "left")
        spelled = F.transform(f"{side}_columns", lambda c: F.coalesce(F.try_element_at("_n", F.lower(c)), c))
        out = out.withColumns({f"{side}_columns": spelled, side: F.coalesce("_t", side)}).drop("k", "_t", "_n")
    return out


def known_roles(candidates: DataFrame, roles: DataFrame, excluded: Sequence[str]) -> DataFrame:
    """Candidates without a column of an excluded role on either side; unknown columns pass."""
    bad = roles.where(F.col("role").isin(*excluded)).select(F.concat_ws(".", "schema", "table", "column").alias("bad"))
    each = candidates.select("seq", F.explode(F.concat(F.transform("source_columns", lambda c: F.concat_ws(".", "source", c)), F.transform("target_columns", lambda c: F.concat_ws(".", "target", c)))).alias("bad"))
    return candidates.join(each.join(F.broadcast(bad), "bad").select("seq").distinct(), "seq", "left_anti")


def known_types(candidates: DataFrame, columns: DataFrame, lattice: DataFrame, least: float) -> DataFrame:
    """Candidates whose pairs of columns all go together; a pair with an unknown type passes."""
    kinds = columns.select(F.concat_ws(".", "schema", "table", "column").alias("c"), F.lower("data_type").alias("k"))
    pairs = candidates.select("seq", "source", "target", F.inline(F.arrays_zip(F.col("source_columns").alias("a"), F.col("target_columns").alias("b"))))
    pairs = pairs.select("seq", F.concat_ws(".", "source", "a").alias("a"), F.concat_ws(".", "target", "b").alias("b"))
    for side in ("a", "b"):
        pairs = pairs.join(F.broadcast(kinds.select(F.col("c").alias(side), F.col("k").alias(f"k{side}"))), side, "left")
    bad = pairs.join(F.broadcast(lattice.toDF("ka", "kb", "score")), ["ka", "kb"]).where(F.col("score") < least).select("seq").distinct()
    return candidates.join(bad, "seq", "left_anti")


def without_stated(candidates: DataFrame, constraints: DataFrame) -> DataFrame:
    """Candidates that no foreign key states, in either direction."""
    fk = constraints.where("kind = 'fk'").select(F.concat_ws(".", "schema", "table").alias("f"), F.array_sort("columns").alias("fc"), F.concat_ws(".", "ref_schema", "ref_table").alias("t"), F.array_sort("ref_columns").alias("tc"))
    both = F.broadcast(fk.unionAll(fk.select("t", "tc", "f", "fc")).distinct())
    on = (F.col("source") == F.col("f")) & (F.array_sort("source_columns") == F.col("fc")) & (F.col("target") == F.col("t")) & (F.array_sort("target_columns") == F.col("tc"))
    return candidates.join(both, on, "left_anti")


def prompt_view(profile: dict, top: int = 10) -> dict:
    """Facts of a table profile for a prompt: no derived analysis, distributions cut to the most frequent values."""
    drop = ("semantic_analysis", "structure_flags", "role_specific_info")
    columns = {}
    for name, p in (profile.get("column_profiles") or {}).items():
        kept = {k: v for k, v in p.items() if k not in drop}
        dist = (kept.get("statistics") or {}).get("value_distribution")
        if dist:
            kept["statistics"] = kept["statistics"] | {"value_distribution": dict(sorted(dist.items(), key=lambda x: (-x[1], x[0]))[:top])}
        columns[name] = kept
    return {k: v for k, v in profile.items() if k not in ("column_profiles", "table_profile")} | {"column_profiles": columns}


def ask(prompts: Sequence[str], provider: Callable[[str], str], workers: int = 5, retries: int = 2) -> list[str]:
    """Replies in the prompts' order; a prompt that keeps failing gets an empty reply."""
    def one(prompt: str) -> str:
        for _ in range(retries + 1):
            try:
                return provider(prompt)
            except Exception:
                continue
        return ""

    with ThreadPoolExecutor(max(1, workers)) as pool:
        return list(pool.map(one, prompts))


def merged_settings(base: dict, over: dict) -> dict:
    """over on top of base; dicts merge, anything else is replaced."""
    out = dict(base)
    for k, v in over.items():
        out[k] = merged_settings(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out
