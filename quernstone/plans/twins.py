"""SQL twins of the queries that classify columns and tables and find keys and relationships.

The rules are written out as SQL once more, over exact statistics; only the
fixed word lists are shared with the library.  Name similarities are literals:
matching characters and the characters of both names.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from difflib import SequenceMatcher
from itertools import combinations

from .. import config as C

Tables = dict[str, dict[str, str]]


def _has(text: str, words: Iterable[str]) -> str:
    return f"regexp_matches({text}, '{'|'.join(map(re.escape, words))}')"


def _like(text: str, patterns: Iterable[str]) -> str:
    return f"regexp_matches({text}, '{'|'.join(patterns)}')"


def _in(text: str, values: Iterable[str]) -> str:
    return f"{text} IN ({', '.join(repr(v) for v in values)})"


def profiles(tables: Tables, keys: dict[str, Sequence[str]]) -> str:
    """t, c, ord, kind, rows, nulls, distinct_, uniq, least, longest, len_avg, len_std, len_range, pk of each column."""
    kind = "CASE any_value(typeof({c})) WHEN 'INTEGER' THEN 'integer' WHEN 'BIGINT' THEN 'bigint' WHEN 'DOUBLE' THEN 'double precision' WHEN 'TIMESTAMP' THEN 'timestamp' WHEN 'FLOAT[]' THEN 'real[]' WHEN 'BOOLEAN' THEN 'boolean' ELSE 'text' END"
    text = lambda c, k: f"round(avg(length({c})), 2) AS len_avg, round(coalesce(stddev_samp(length({c})), 0), 2) AS len_std, max(length({c})) - min(length({c})) AS len_range" if k == "s" else "0.0 AS len_avg, 0.0 AS len_std, 0 AS len_range"
    each = lambda t, i, c, k: (
        f"SELECT '{t}' AS t, '{c}' AS c, {i} AS ord, {kind.format(c=c)} AS kind, count(*) AS rows, count(*) - count({c}) AS nulls, count(DISTINCT {c}) AS distinct_, round(count(DISTINCT {c}) / count(*), 4) AS uniq, "
        f"(SELECT min(n) FROM (SELECT count(*) AS n FROM {t} WHERE {c} IS NOT NULL GROUP BY {c})) AS least, max(length(CAST({c} AS VARCHAR))) AS longest, {text(c, k)}, {c in keys.get(t, ())} AS pk FROM {t}"
    )
    return " UNION ALL ".join(each(t, i, c, k) for t, cols in tables.items() for i, (c, k) in enumerate(cols.items()))


def roles(tables: Tables, keys: dict[str, Sequence[str]]) -> str:
    """profiles with role, confidence and basis (the shipped preset)."""
    words, name = C.SHIPPED, "lower(c)"
    may_identify = f"NOT {_has(name, C.NAME_EXCLUDED)} AND {_in('kind', C.IDENTIFIER_TYPES)}"
    may_describe = "NOT pk AND kind = 'text'"
    strings = _in("kind", C.ENUM_STRING_TYPES)
    two = (
        f"NOT {_has(name, C.NAME_EXCLUDED)} AND distinct_ = 2 AND ({strings} OR {_in('kind', C.ENUM_INTEGER_TYPES)}) AND NOT pk AND distinct_ <> rows "
        f"AND nulls / rows < 0.3 AND least >= 2 AND (NOT {strings} OR longest <= 20)"
    )
    number, measure = _in("kind", C.NUMERIC_TYPES), _like(name, C.METRIC_PATTERNS)
    varied = f"NOT {_has(name, C.DESCRIPTION_EXCLUDED)} AND len_avg >= 50 AND uniq >= 0.7 AND len_std >= 5 AND (len_std > 20 OR len_range > 100)"
    rules = [
        (f"{_in('kind', words.complex_types)} OR kind LIKE '%[]'", "complex", 0.95, "complex_type"),
        (_like(name, C.AUDIT_PATTERNS), "audit", 0.95, "audit_pattern"),
        (_in("kind", words.datetime_types), "datetime", 1.0, "datetime_type"),
        (_like(name, [f"{s}$" for s in C.DATETIME_SUFFIXES]), "datetime", 0.85, "datetime_name"),
        (f"{may_identify} AND pk", "identifier", 1.0, "physical_constraint"),
        (f"{may_identify} AND uniq > 0.95 AND 1 - nulls / rows > 0.8 AND NOT {_has(name, C.METRIC_WORDS)}", "identifier", 0.95, "logical_primary_key"),
        (f"{may_identify} AND {_has(name, C.IDENTIFIER_KEYWORDS)} AND uniq > 0.05", "identifier", 0.85, "naming_and_uniqueness"),
        (f"{may_identify} AND {_has(name, C.IDENTIFIER_KEYWORDS)}", "identifier", 0.75, "naming_only"),
        (f"{may_describe} AND {_has(name, words.description_keywords)}", "description", 0.85, "description_keyword_match"),
        (f"{may_describe} AND {varied}", "description", 0.85, "description_high_variance"),
        (two, "enum", 0.85, "simple_two_value_enum"),
        (f"{number} AND {measure}", "metric", 0.95, "numeric_type,metric_pattern"),
        (number, "metric", 0.7, "numeric_type"),
        (measure, "metric", 0.6, "metric_pattern"),
    ]
    pick = lambda i, quote: "CASE " + " ".join(f"WHEN {r[0]} THEN {repr(r[i]) if quote else r[i]}" for r in rules)
    return f"SELECT *, {pick(1, True)} ELSE 'attribute' END AS role, CAST({pick(2, False)} ELSE 0.7 END AS DOUBLE) AS confidence, {pick(3, True)} ELSE 'fallback_attribute' END AS basis FROM ({profiles(tables, keys)})"


def categories(tables: Tables, keys: dict[str, Sequence[str]]) -> str:
    """t, category, confidence, basis and counts of each table; no table has a foreign key or a comment, nor a name that tells."""
    of = lambda r: f"count(*) FILTER (WHERE role = '{r}') AS {r}_count"
    counts = f"SELECT t, count(*) AS total_columns, bool_or(pk) AS has_key, {of('identifier')}, {of('metric')}, {of('datetime')} FROM ({roles(tables, keys)}) GROUP BY t"
    fact = "(metric_count >= 1)::INT + (identifier_count >= 2)::INT + (datetime_count >= 1)::INT >= 2"
    dim = "has_key AND metric_count = 0 AND identifier_count >= 1"
    parts = "concat_ws(',', CASE WHEN metric_count >= 1 THEN 'fact_has_metric' END, CASE WHEN identifier_count >= 2 THEN 'fact_dimension_columns' END, CASE WHEN datetime_count >= 1 THEN 'fact_datetime' END)"
    sum_ = "round(0.6 + 0.15 * (metric_count >= 1)::INT + 0.1 * (identifier_count >= 2)::INT + 0.1 * (datetime_count >= 1)::INT, 4)"
    return (
        f"SELECT t, CASE WHEN {fact} THEN 'fact' WHEN {dim} THEN 'dim' ELSE 'unknown' END AS category, CAST(CASE WHEN {fact} THEN {sum_} WHEN {dim} THEN 0.95 ELSE 0.5 END AS DOUBLE) AS confidence, "
        f"CASE WHEN {fact} THEN {parts} WHEN {dim} THEN 'dim_identifier_columns,dim_has_primary_key' ELSE '' END AS basis, total_columns, identifier_count, metric_count, datetime_count FROM ({counts})"
    )


def logical_keys(tables: Tables, wide: str = "lineitem") -> str:
    """t, column_set, confidence of the smallest keys, none being known: single columns, and for the table without one sets of two and three.

    A single key has 0.4 + 0.2 as it is unique without nulls, 0.1 for a key
    type, and 0.3 by name (0.21 where the name holds a key word, but does not
    end in _ and the word; else 0.09).  A set has 0.18 if some name holds a
    key word, else 0.09, and its share of key types.  Columns of numbers with
    fractions and of times are never in a set.
    """
    excluded = _in("role", C.SHIPPED.key_excluded_roles)
    r = f"SELECT * FROM ({roles(tables, {})}) WHERE NOT {excluded} AND nulls = 0"
    score = "CASE WHEN regexp_matches(c, '_(id|code|key|pk|no|number)$') THEN 0.3 WHEN regexp_matches(c, 'id|code|key|pk|no|number') THEN 0.21 ELSE 0.09 END"
    ones = f"SELECT t, c AS column_set, round({score} + 0.6 + 0.1 * ({_in('kind', C.KEY_TYPES)})::INT, 4) AS confidence, 1 AS size FROM r WHERE distinct_ = rows"
    columns = [c for c, k in tables[wide].items() if re.search("key$|number$", c) or k == "s"]
    sets = [s for n in (2, 3) for s in combinations(columns, n)]
    counts = ", ".join(f"count(DISTINCT ({', '.join(s)})) AS n{i}" for i, s in enumerate(sets))
    several = " UNION ALL ".join(
        f"SELECT '{','.join(s)}' AS column_set, {len(s)} AS size, {0.18 if any(re.search('id|code|key|no|number|pk', c) for c in s) else 0.09} AS named, n{i} AS n, total, "
        f"(SELECT count(*) FROM r WHERE t = '{wide}' AND {_in('c', s)}) AS fit, (SELECT count(*) FROM r WHERE t = '{wide}' AND {_in('c', s)} AND {_in('kind', C.KEY_TYPES)}) AS typed FROM d"
        for i, s in enumerate(sets)
    )
    return (
        f"WITH r AS MATERIALIZED ({r}), d AS MATERIALIZED (SELECT count(*) AS total, {counts} FROM {wide}), "
        f"k AS ({ones} UNION ALL SELECT '{wide}', column_set, round(named + 0.6 + 0.1 * typed / size, 4), size FROM ({several}) WHERE n = total AND fit = size), good AS (SELECT * FROM k WHERE confidence >= 0.8) "
        "SELECT t, column_set, CAST(confidence AS DOUBLE) AS confidence FROM good WHERE size = (SELECT min(size) FROM good g WHERE g.t = good.t)"
    )


#: Names that are alike enough for a relationship: source, target, matching characters, characters of both.
ALIKE = [
    ("orders", "o_orderkey", "lineitem", "l_orderkey", 9, 20, 1.0),
    ("region", "r_regionkey", "nation", "n_regionkey", 10, 22, 1.0),
    ("nation", "n_nationkey", "customer", "c_nationkey", 10, 22, 1.0),
    ("nation", "n_nationkey", "supplier", "s_nationkey", 10, 22, 1.0),
    ("region", "r_regionkey", "nation", "n_nationkey", 7, 22, 1.0),
    ("nation", "n_nationkey", "region", "r_regionkey", 7, 22, 1.0),
    ("nation", "n_nationkey", "part", "p_partkey", 6, 20, 0.9),
    ("part", "p_partkey", "nation", "n_nationkey", 6, 20, 0.9),
]


#: More such pairs, where the supplier's nation happens to be a key: in small tables.
ALIKE_IF_KEY = [
    ("supplier", "s_nationkey", "nation", "n_nationkey", 10, 22, 1.0),
    ("supplier", "s_nationkey", "customer", "c_nationkey", 10, 22, 1.0),
    ("supplier", "s_nationkey", "region", "r_regionkey", 7, 22, 1.0),
    ("region", "r_regionkey", "supplier", "s_nationkey", 7, 22, 1.0),
    ("supplier", "s_nationkey", "part", "p_partkey", 6, 20, 0.9),
    ("part", "p_partkey", "supplier", "s_nationkey", 6, 20, 0.9),
]


def relationships(metrics: str, cardinality: str, pairs: Sequence[tuple] = ALIKE) -> str:
    """Scored relationships between the pairs, each named source.column->target.column in `metrics`."""
    rows = ", ".join(f"('{s}.{a}->{t}.{b}', '{s}', '{a}', '{t}', '{b}', 2.0 * {m} / {n}, {kind})" for s, a, t, b, m, n, kind in pairs)
    return (
        f"WITH m AS ({metrics}), p(relationship, s, a, t, b, names, types) AS (VALUES {rows}), "
        f"scored AS (SELECT *, 0.55 * inclusion_rate + 0.2 * jaccard_index + 0.15 * names + 0.1 * types AS score, {cardinality} AS cardinality FROM m JOIN p USING (relationship)) "
        "SELECT 'rel_' || substr(md5('public.' || s || '.[' || a || ']->public.' || t || '.[' || b || ']'), 1, 12) AS relationship_id, 'public.' || s AS source, a AS source_columns, 'public.' || t AS target, b AS target_columns, "
        "cardinality, names, score, CASE WHEN score >= 0.65 THEN 'accepted' ELSE 'rejected' END AS decision, CASE WHEN score < 0.65 THEN 'below_threshold' END AS reason FROM scored"
    )


def discovered(metrics: str, cardinality: str, tables: Tables) -> str:
    """Relationships from keys that are found, not known: names must be alike by 0.6 where the target is a key too, else by 0.9."""
    return (
        f"WITH k AS MATERIALIZED (SELECT 'public.' || t AS t, column_set AS c FROM ({logical_keys(tables)})), r AS ({relationships(metrics, cardinality, [*ALIKE, *ALIKE_IF_KEY])}) "
        "SELECT * FROM r WHERE (source, source_columns) IN (SELECT t, c FROM k) AND (names >= 0.9 OR (target, target_columns) IN (SELECT t, c FROM k))"
    )


def candidate_pairs(tables: Tables) -> str:
    """Single-column candidates, none but logical keys being known: all pairs of columns by their names' ratio, listed here, with keys, roles and types from the data."""
    ratio = lambda a, b: 1.0 if a == b else SequenceMatcher(None, a, b).ratio()
    rows = [(s, a, t, b, ratio(a, b)) for s, of in tables.items() for a in of for t, others in tables.items() if t != s for b in others]
    listed = ", ".join(f"('{s}', '{a}', '{t}', '{b}', {r!r})" for s, a, t, b, r in rows if r >= 0.6)
    kinds = "(x.kind = y.kind OR (x.kind IN ('integer', 'bigint') AND y.kind IN ('integer', 'bigint')))"
    return (
        f"WITH p(s, a, t, b, r) AS (VALUES {listed}), q AS MATERIALIZED ({roles(tables, {})}), k AS MATERIALIZED (SELECT t, column_set AS c FROM ({logical_keys(tables)})) "
        "SELECT 'public.' || s AS source, a AS source_column, 'public.' || p.t AS target, b AS target_column, 'single_logical_key' AS kind, round(CAST(r AS DOUBLE), 6) AS name_similarity "
        "FROM p JOIN q x ON x.t = s AND x.c = a JOIN q y ON y.t = p.t AND y.c = b "
        f"WHERE (s, a) IN (SELECT t, c FROM k) AND {kinds} AND (a = b OR NOT {_in('y.role', C.RELATIONS.single_excluded_roles)}) AND (r >= 0.9 OR (p.t, b) IN (SELECT t, c FROM k))"
    )


def composite_keys(name: str, columns: Iterable[str], table: str) -> str:
    """Keys of the smallest size of a table of numbers whose names all hold a key word and end in it: all sets of one, two and three are counted."""
    sets = [s for n in (1, 2, 3) for s in combinations(columns, n)]
    counts = ", ".join(f"count(DISTINCT ({', '.join(s)})) AS n{i}" for i, s in enumerate(sets))
    rows = ", ".join(f"('{','.join(sorted(s))}', {len(s)}, {1.0 if len(s) == 1 else 0.88}, n{i})" for i, s in enumerate(sets))
    return (
        f"WITH w AS MATERIALIZED ({table}), d AS MATERIALIZED (SELECT count(*) AS total, {counts} FROM w), "
        f"k AS (SELECT total, unnest([{rows}]) AS x FROM d), g AS (SELECT x[1] AS column_set, x[2] AS size, x[3] AS confidence FROM k WHERE x[4] = total) "
        f"SELECT '{name}' AS \"table\", column_set, CAST(confidence AS DOUBLE) AS confidence FROM g WHERE size = (SELECT min(size) FROM g)"
    )


def audit_facts() -> str:
    """CASE expressions of an audit column's kind and purpose by its name, c."""
    pick = lambda i: "CASE " + " ".join(f"WHEN {_has('lower(c)', k[2])} THEN '{k[i]}'" for k in C.AUDIT_KINDS) + f" ELSE '{C.AUDIT_OTHER[i]}' END"
    return f"CASE WHEN role = 'audit' THEN {pick(0)} END AS audit_type, CASE WHEN role = 'audit' THEN {pick(1)} END AS audit_purpose"
