"""Candidate relationships.  They are found on metadata alone, which the driver holds: tables times columns, no rows."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field
from itertools import combinations, permutations

from ..config import RELATIONS, RelationConfig
from ..functions.names import similarity
from ..functions.types import compatibility


@dataclass
class Described:
    """A table as candidates see it: rows of column profiles, constraints and logical keys."""

    schema: str
    name: str
    columns: dict[str, object]
    primary_keys: list[tuple[str, ...]] = field(default_factory=list)
    unique_keys: list[tuple[str, ...]] = field(default_factory=list)
    indexes: list[tuple[str, ...]] = field(default_factory=list)
    foreign_keys: list[tuple[tuple[str, ...], str, str, tuple[str, ...]]] = field(default_factory=list)
    logical_keys: list = field(default_factory=list)

    @property
    def full_name(self) -> str:
        return f"{self.schema}.{self.name}"

    def single(self, keys: Iterable[Sequence[str]], column: str) -> bool:
        return any(tuple(k) == (column,) for k in keys)

    def is_defined(self, column: str) -> bool:
        return self.single(self.primary_keys, column) or self.single(self.unique_keys, column)

    def is_logical(self, column: str, least: float) -> bool:
        return any(k.columns == (column,) and k.confidence >= least for k in self.logical_keys)


@dataclass(frozen=True)
class Candidate:
    source: str
    source_columns: tuple[str, ...]
    target: str
    target_columns: tuple[str, ...]
    kind: str


Similarity = Callable[[str, str], float]


def source_sets(t: Described, c: RelationConfig) -> list[tuple[tuple[str, ...], str]]:
    """Keys of 2 to max_columns columns: physical ones first, then logical ones."""
    physical = [(tuple(k), "physical") for k in (*t.primary_keys, *t.unique_keys)]
    logical = [(k.columns, "logical") for k in t.logical_keys if k.confidence >= c.min_confidence]
    return [(k, kind) for k, kind in (*physical, *logical) if 2 <= len(k) <= c.max_columns]


def target_sets(t: Described, c: RelationConfig) -> list[tuple[str, ...]]:
    """As source_sets, and indexes of several columns; sets of the same columns count once."""
    out = [k for k, _ in source_sets(t, c)]
    seen = {frozenset(k) for k in out}
    for k in t.indexes:
        if 2 <= len(k) <= c.max_columns and frozenset(k) not in seen:
            seen.add(frozenset(k))
            out.append(tuple(k))
    return out


def _type(t: Described, column: str) -> str:
    return t.columns[column].data_type if column in t.columns else ""


def match_as_set(source: Described, columns: Sequence[str], target: Described, pool: Sequence[str], c: RelationConfig, alike: Similarity = similarity) -> tuple[str, ...] | None:
    """The order of the best subset of pool that goes with columns, each pair above both thresholds; the first on ties."""
    best, best_score = None, -1.0
    for order in (p for some in combinations(pool, len(columns)) for p in permutations(some)):
        pairs = [(alike(a, b), compatibility(_type(source, a), _type(target, b))) for a, b in zip(columns, order, strict=True)]
        if any(n < c.name_composite or t < c.type_min for n, t in pairs):
            continue
        score = sum(n + t for n, t in pairs) / (2 * len(pairs))
        if score > best_score:
            best, best_score = order, score
    return best


def match_same_names(source: Described, columns: Sequence[str], target: Described, c: RelationConfig) -> tuple[str, ...] | None:
    """Columns of the same names but for case, with types that go together."""
    by_name = {n.lower(): n for n in target.columns}
    found = tuple(by_name.get(x.lower(), "") for x in columns)
    ok = all(found) and all(compatibility(_type(source, a), _type(target, b)) >= c.type_min for a, b in zip(columns, found, strict=True))
    return found if ok else None


def composite_candidates(tables: Sequence[Described], c: RelationConfig = RELATIONS, alike: Similarity = similarity) -> list[Candidate]:
    out = []
    for s in tables:
        for columns, kind in source_sets(s, c):
            for t in tables:
                if t is s:
                    continue
                matches = (match_as_set(s, columns, t, pool, c, alike) for pool in target_sets(t, c) if len(pool) >= len(columns))
                found = next((m for m in matches if m), None) or match_same_names(s, columns, t, c)
                if found:
                    out.append(Candidate(s.full_name, columns, t.full_name, found, f"composite_{kind}"))
    return out


def single_candidates(tables: Sequence[Described], c: RelationConfig = RELATIONS, alike: Similarity = similarity) -> list[Candidate]:
    out = []
    for s in tables:
        for a in s.columns:
            defined, logical = s.is_defined(a), s.is_logical(a, c.min_confidence)
            if not (defined or logical):
                continue
            kind = "single_logical_key" if not defined else "single_defined_constraint" + "_and_logical_pk" * logical
            for t in tables:
                for b, p in t.columns.items() if t is not s else ():
                    key_like = t.is_defined(b) or t.is_logical(b, c.min_confidence)
                    exempt = t.is_defined(b) or any(b in k for k in t.indexes) or a.lower() == b.lower()
                    if not exempt and p.role in c.single_excluded_roles:
                        continue
                    if compatibility(_type(s, a), p.data_type) >= c.type_min and alike(a, b) >= (c.name_key_like if key_like else c.name_other):
                        out.append(Candidate(s.full_name, (a,), t.full_name, (b,), kind))
    return out


def without_foreign_keys(candidates: Iterable[Candidate], tables: Sequence[Described], legacy: bool = False) -> list[Candidate]:
    """Candidates that no foreign key states in either direction; legacy keeps them all."""
    if legacy:
        return list(candidates)
    stated = set()
    for t in tables:
        for columns, schema, name, ref in t.foreign_keys:
            ends = (t.full_name, frozenset(columns)), (f"{schema}.{name}", frozenset(ref))
            stated |= {ends, ends[::-1]}
    return [c for c in candidates if ((c.source, frozenset(c.source_columns)), (c.target, frozenset(c.target_columns))) not in stated]


def candidates(tables: Sequence[Described], c: RelationConfig = RELATIONS, alike: Similarity = similarity) -> list[Candidate]:
    """Composite candidates first, then single ones, without what foreign keys state."""
    return without_foreign_keys([*composite_candidates(tables, c, alike), *single_candidates(tables, c, alike)], tables, c.legacy_fk_dedup)
