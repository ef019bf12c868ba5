"""Minimal logical keys, found level by level."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import BARE, KEY_TYPES, ProfileConfig
from ..functions.names import is_potential_key
from ..storage import dealt, key_parts
from .stats import comparable

KEYS = "schema string, table string, columns array<string>, confidence double, uniqueness double, null_rate double"


@dataclass(frozen=True)
class LogicalKey:
    columns: tuple[str, ...]
    confidence: float
    uniqueness: float = 1.0
    null_rate: float = 0.0


def name_score(columns: Sequence[str], patterns: Sequence[str]) -> float:
    """One column: 1.0 if it is or ends in the first pattern that it contains, else 0.7, or 0.3 without one."""
    if len(columns) > 1:
        return 0.6 if any(is_potential_key(c) for c in columns) else 0.3
    name = columns[0].lower()
    hit = next((p for p in patterns if p.lower() in name), None)
    if hit is None:
        return 0.3
    return 1.0 if name == hit or name.endswith(f"_{hit}") else 0.7


def confidence(columns: Sequence[str], types: Sequence[str], patterns: Sequence[str], uniqueness: float = 1.0, null_rate: float = 0.0) -> float:
    fit = sum(t.lower() in KEY_TYPES for t in types) / len(types) if types else 0.5
    return round(0.3 * name_score(columns, patterns) + 0.4 * uniqueness + 0.2 * (1 - null_rate) + 0.1 * fit, 4)


def distinct_counts(df: DataFrame, sets: Sequence[Sequence[str]], parts: int | None = None) -> dict[tuple[str, ...], int]:
    """Exact distinct rows of each column set, nulls being values: each set is counted in its own types, all in one job.

    Rows most of which differ are dealt over `parts` (of storage.key_parts) first.
    """
    if not sets:
        return {}
    one = lambda i, s: dealt(df.select(*[comparable(df, c).alias(f"k{j}") for j, c in enumerate(s)]), parts, *[f"k{j}" for j in range(len(s))]).distinct().agg(F.lit(i).alias("i"), F.count("*").alias("n"))
    n = {r.i: r.n for r in reduce(DataFrame.unionAll, [one(i, s) for i, s in enumerate(sets)]).collect()}
    return {tuple(s): n[i] for i, s in enumerate(sets)}


#: Values of column sets are looked at in one of so many parts before they are counted.
SLICES = 64


def nearly_unique(df: DataFrame, sets: Sequence[tuple[str, ...]], total: int, at_once: int = 100) -> list[tuple[str, ...]]:
    """The sets that may tell all `total` rows apart: no two rows agree on one among a part of its values.

    Equal rows fall into the same part, so a set that repeats many values shows
    it there, and only that part is shuffled, for all sets in one pass.  Values
    are told apart by 128 bits of two hashes.
    """
    twice = set()
    for k in range(0, len(sets), at_once):
        some = sets[k : k + at_once]
        value = lambda s: [comparable(df, c) for c in s]
        hashed = df.select("*", *[F.xxhash64(*value(s)).alias(f"#{i}") for i, s in enumerate(some)])
        one = lambda i, s: F.struct(F.lit(k + i).alias("i"), F.col(f"`#{i}`").alias("h"), F.xxhash64(F.lit(1), *value(s)).alias("g"))  # noqa: B023, E731
        parts = F.array(*[F.when(F.pmod(F.col(f"`#{i}`"), F.lit(SLICES)) == 0, one(i, s)) for i, s in enumerate(some)])
        marks = hashed.select(F.explode(parts).alias("x")).where("x IS NOT NULL").select("x.*")
        looked = total * len(some) / SLICES
        marks = dealt(marks, key_parts(df.sparkSession, looked, looked), "i", "h", "g")
        twice |= {r.i for r in marks.groupBy("i", "h", "g").count().where("count > 1").select("i").distinct().collect()}
    return [s for i, s in enumerate(sets) if i not in twice]


#: Rows whose pairs are compared at first, and column sets that are counted together.
PAIRED, AT_ONCE = 512, 100


def maximal(masks: np.ndarray) -> np.ndarray:
    """Rows of a boolean matrix that are part of no other row, each once."""
    masks = np.unique(masks, axis=0)
    masks = masks[np.argsort(-masks.sum(axis=1), kind="stable")]
    kept = masks[:0]
    for m in masks:
        if not (kept[:, m].all(axis=1)).any():
            kept = np.vstack([kept, m])
    return kept


class AgreeSets:
    """Column sets on which two rows of a table agree, so that neither they nor their parts are keys.

    The first ones come from all pairs of PAIRED rows (those with the smallest
    hashes); sets that turn out not to be keys add the pair that shows it.
    They only save work: a set is a key by its count alone.  Values are told
    apart by 128 bits of two hashes.
    """

    def __init__(self, df: DataFrame, columns: Sequence[str]):
        self.df, self.columns = df, list(columns)
        self.marks = [F.struct(F.xxhash64(comparable(df, c)), F.xxhash64(F.lit(1), comparable(df, c))).alias(f"m{i}") for i, c in enumerate(self.columns)]
        self.masks = np.zeros((0, len(self.columns)), bool)
        rows = df.select(*self.marks).orderBy(F.xxhash64(*[f"m{i}" for i in range(len(self.columns))])).limit(PAIRED).collect() if self.columns else []
        self.learn([(a, b) for a, b in combinations(rows, 2)] if len(rows) < 3 else [], rows)

    def learn(self, pairs: Sequence[tuple], rows: Sequence = ()) -> None:
        found = [self.masks, *(np.array([[x == y for x, y in zip(a, b, strict=True)]]) for a, b in pairs)]
        if len(rows) >= 3:
            codes = np.array([[hash(v) for v in r] for r in rows], np.int64)
            found += [maximal(codes[i + 1 :] == codes[i]) for i in range(len(rows) - 1)]
        self.masks = maximal(np.vstack(found)) if self.columns else self.masks

    def witnesses(self, sets: Sequence[tuple[str, ...]]) -> None:
        """Adds, for each set that is no key, a pair of rows that agree on it."""
        if not sets:
            return
        keys = lambda s: [F.col(f"m{self.columns.index(c)}") for c in s]
        marked = self.df.select(*self.marks)
        twice = lambda i, s: marked.groupBy(*keys(s)).count().where("count > 1").limit(1).select(F.lit(i).alias("i"), F.to_json(F.struct(*keys(s))).alias("key"))
        which = {r.i: r.key for r in reduce(DataFrame.unionAll, [twice(i, s) for i, s in enumerate(sets)]).collect()}
        pair = lambda i, s: marked.where(F.to_json(F.struct(*keys(s))) == which[i]).limit(2).select(F.lit(i).alias("i"), *marked.columns)
        rows = reduce(DataFrame.unionAll, [pair(i, s) for i, s in enumerate(sets) if i in which]).collect() if which else []
        both = {}
        for r in rows:
            both.setdefault(r.i, []).append(tuple(r)[1:])
        self.learn([(a, b) for a, b in (v for v in both.values() if len(v) == 2)])

    def open_sets(self, size: int) -> list[tuple[str, ...]]:
        """Sets of that many columns which no agree set holds: each has a column outside of every agree set.

        They are built by choosing such a column for one agree set after the
        other, not by trying all sets.
        """
        outside = ~self.masks
        outside = outside[np.argsort(outside.sum(axis=1), kind="stable")]
        out, seen = set(), set()

        def grow(chosen: frozenset[int]) -> None:
            if chosen in seen:
                return
            seen.add(chosen)
            unmet = np.flatnonzero(~outside[:, sorted(chosen)].any(axis=1)) if chosen else np.arange(len(outside))
            if len(unmet):
                if len(chosen) < size:
                    for c in np.flatnonzero(outside[unmet[0]]).tolist():
                        grow(chosen | {c})
            else:
                free = [c for c in range(len(self.columns)) if c not in chosen]
                out.update(tuple(sorted((*chosen, *more))) for more in combinations(free, size - len(chosen)))

        grow(frozenset())
        return [tuple(self.columns[c] for c in s) for s in sorted(out)]

    def holds(self, s: Sequence[str]) -> bool:
        """Whether some agree set has all of these columns."""
        return bool(self.masks[:, [self.columns.index(c) for c in s]].all(axis=1).any())


def logical_keys(df: DataFrame, profiles: Sequence, config: ProfileConfig = BARE, has_primary_key: bool = False) -> list[LogicalKey]:
    """Keys of a table without a primary key, by falling confidence.

    profiles: rows with column, ordinal, role, data_type, sample_count,
    null_count, unique_count.  A key holds no nulls and is unique by counts,
    not by a rounded rate.  The search stops at the smallest size at which a
    key is confident enough: larger ones would be dropped.  Sets on which two
    rows are known to agree are never looked at, nor are those whose distinct
    counts cannot multiply up to the row count, with a wide margin as
    unique_count may be an estimate; two equal rows in a part of the values rule
    out most others, and what is left is counted exactly.
    """
    rows = sorted(profiles, key=lambda r: r.ordinal)
    total = rows[0].sample_count if rows else 0
    if has_primary_key or not total:
        return []
    fit = [r for r in rows if r.role not in config.key_excluded_roles]
    types = {r.column: r.data_type for r in rows}
    score = lambda cols: confidence(cols, [types[c] for c in cols], config.key_name_patterns)
    found = [LogicalKey((r.column,), score([r.column])) for r in fit if r.unique_count == total and not r.null_count]
    found = [k for k in found if k.confidence >= config.min_key_confidence]
    whole = [r.column for r in fit if not r.null_count]
    most = {r.column: min(total, 1.25 * r.unique_count + 10) for r in fit}
    size, agree, parts = 2, None, key_parts(df.sparkSession, total, total)
    while not found and size <= min(config.max_key_columns, len(whole)):
        agree = agree or AgreeSets(df, whole)
        sets = [c for c in agree.open_sets(size) if score(c) >= config.min_key_confidence and math.prod(most[x] for x in c) >= total]
        while sets:
            some, sets = sets[:AT_ONCE], sets[AT_ONCE:]
            left = nearly_unique(df, some, total)
            counts = distinct_counts(df, left, parts) if parts else distinct_counts(df, left)
            found += [LogicalKey(s, score(s)) for s, n in counts.items() if n == total]
            if sets:
                agree.witnesses([s for s in some if counts.get(s) != total][:16])
                sets = [s for s in sets if not agree.holds(s)]
        size += 1
    return sorted(found, key=lambda k: -k.confidence)
