"""Vector search, name joins, sketches and agree sets against plain versions."""

import random
from collections import Counter
from difflib import SequenceMatcher
from itertools import combinations
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quernstone.config import BARE, SHIPPED, RelationConfig
from quernstone.operators import keys as K
from quernstone.operators import namejoin as N
from quernstone.operators import sketches as S
from quernstone.operators import vectors as V
from quernstone.operators.candidates import candidates
from quernstone.plans import queries as core
from quernstone.plans.discover import decisions, describe, discover, found_candidates, joined_candidates
from quernstone.plans.profile import profile_catalog
from quernstone.sources.catalog import Catalog, Constraint, Table
from quernstone.storage import shared_folder

VECTORS = "vec_id bigint, embedding array<float>"


def clustered(n: int = 600, dims: int = 8, seed: int = 1):
    r = np.random.default_rng(seed)
    centres = r.normal(0, 1, (20, dims))
    return [(i, [float(np.float32(x)) for x in centres[i % 20] + r.normal(0, 0.1, dims)]) for i in range(n)]


def plain_top(queries, rows, k):
    unit = lambda v: np.array(v, float) / max(np.linalg.norm(np.array(v, float)), 1e-300)
    out = []
    for q, e in queries:
        near = sorted((-round(float(unit(e) @ unit(v)), 9), i) for i, v in rows if v is not None and len(v) == len(e))
        out += [(q, i, p + 1) for p, (_, i) in enumerate(near[:k])]
    return sorted(out)


def got(df, name="id"):
    return sorted((r.query_id, r[name], r["rank"]) for r in df.collect())


@pytest.fixture(scope="module")
def vectors(spark):
    rows = clustered() + [(1000, [0.0] * 8), (1001, [0.0] * 8), (1002, clustered()[3][1]), (1003, clustered()[3][1])]
    odd = [(2000, None), (2001, [1.0] * 7 + [None]), (2002, [1.0] * 7 + [float("nan")])]
    return rows, spark.createDataFrame(rows + odd, VECTORS)


def test_exact_search_in_small_blocks(spark, monkeypatch, vectors):
    monkeypatch.setattr(V, "CHUNK", 50)
    monkeypatch.setattr(V, "BLOCK", 7)
    rows, df = vectors
    more = [(3000, [1.0, 0.0]), (3001, [0.0, 1.0])]
    df = df.unionAll(spark.createDataFrame(more, VECTORS))
    q = [r for r in rows if r[0] % 30 == 0] + [(9001, [1.0, 1.0])]
    found = V.exact_top_k(spark.createDataFrame(q, "query_id bigint, embedding array<float>"), df, 5)
    assert got(found, "vec_id") == plain_top(q, rows + more, 5)


def test_index_search(spark, monkeypatch, vectors):
    monkeypatch.setattr(V, "CHUNK", 40)
    rows, df = vectors
    index = V.build_index(df, shared_folder(spark), lists=16)
    assert index.vectors.count() == len(rows) == index.lists.agg(F.sum("n")).first()[0]
    assert index.lists.where("chunks > 1").count() > 0
    q = [r for r in rows if r[0] % 30 == 0] + [(9000, [0.0] * 8), (9001, [-x for x in rows[5][1]])]
    queries = spark.createDataFrame([*q, (9002, None)], "query_id bigint, embedding array<float>")
    assert got(index.search(queries, 6, probes=1, exact=True)) == plain_top(q, rows, 6)
    near = [x for x in q if x[0] < 9000]
    some = index.search(queries.where("query_id < 1000"), 6, probes=2)
    hits = len(set(got(some)) & set(plain_top(near, rows, 6)))
    assert hits >= 0.9 * 6 * len([x for x in near if x[0] < 1000])
    read = index.compared(queries, 2).agg(F.avg("n")).first()[0]
    assert read < len(rows) / 4
    fewer = V.build_index(df, shared_folder(spark), lists=4)
    assert fewer.compared(queries, 2).agg(F.avg("n")).first()[0] > read
    with pytest.raises(Exception, match="8 components"):
        index.search(spark.createDataFrame([(1, [1.0])], "query_id bigint, embedding array<float>"), 2).collect()
    # Lists that are not wanted are not read.
    plan = index.vectors.where(F.col("list").isin([1, 2]))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [list" in plan


def test_searches_hand_on_few_rows_at_once(spark, monkeypatch, vectors):
    """Rows of a query and a list come in frames that do not grow with the queries of an Arrow batch or with the lists."""
    monkeypatch.setattr(V, "STEP", 16 * 8 * 10, raising=False)
    rows, df = vectors
    index = V.build_index(df, shared_folder(spark), lists=16)
    frame = pd.DataFrame([(i, np.array(e), -2.0) for i, e in rows], columns=["query_id", "embedding", "least"])
    queries = SimpleNamespace(mapInPandas=lambda run, schema: list(run(iter([frame.iloc[:0], frame]))))
    lists = index.lists.where("list >= 0").count()
    near, beyond = index.targets(queries, 3), index.targets(queries, 3, beyond=True)
    assert sum(map(len, near)) == 3 * len(rows) and sum(len(f[f["list"] >= 0]) for f in beyond) == (lists - 3) * len(rows)
    assert max(map(len, near + beyond)) <= 10 * 17 + 10


def test_index_of_odd_vectors(spark):
    nothing = spark.createDataFrame([(1, None)], VECTORS)
    q = spark.createDataFrame([(1, [1.0, 0.0])], "query_id bigint, embedding array<float>")
    assert V.build_index(nothing, shared_folder(spark)).search(q, 3).count() == 0
    zeros = spark.createDataFrame([(1, [0.0, 0.0]), (2, [0.0, 0.0])], VECTORS)
    assert got(V.build_index(zeros, shared_folder(spark)).search(q, 3, exact=True)) == [(1, 1, 1), (1, 2, 2)]
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(30)], VECTORS)
    assert got(V.build_index(same, shared_folder(spark)).search(q, 3)) == [(1, 0, 1), (1, 1, 2), (1, 2, 3)]


# Names ------------------------------------------------------------------------------------------------------------------


def some_names(n: int, seed: int) -> list[str]:
    rng = random.Random(seed)
    words = ["id", "key", "order", "customer", "date", "no", "code", "area", "section", "name", "user", "amount", "x", "total", "aa"]
    out = {"_".join(rng.choices(words, k=rng.choice([1, 1, 2, 2, 3, 4]))) for _ in range(n)}
    return sorted(out | {"a", "ab", "ba", "é_key", "key_" * 15, "key_" * 14 + "kez_", "aaaa", "aaab"})


@pytest.mark.parametrize("threshold", [0.6, 0.9])
def test_names_join_as_compared_one_by_one(spark, threshold):
    a, b = some_names(120, 1), some_names(120, 2)
    df = lambda x: spark.createDataFrame([(n,) for n in [*x, None, " ", f" {x[3].upper()} "]], "name string")
    found = {(r.a, r.b): r.ratio for r in N.similar_names(df(a), df(b), threshold).collect()}
    want = {(x, y): SequenceMatcher(None, x, y).ratio() for x in a for y in b}
    assert found == {p: r for p, r in want.items() if r >= threshold}


def test_signatures_are_met_by_every_pair_that_shares_enough():
    rng = random.Random(4)
    for _ in range(3000):
        threshold = rng.choice([0.4, 0.6, 0.9])
        a, b = ({rng.choice("abcdefghij") for _ in range(rng.randint(1, 10))} for _ in range(2))
        if 2 * len(a & b) >= threshold * (len(a) + len(b)):
            assert set(N.signatures(sorted(a), threshold)) & set(N.signatures(sorted(b), threshold)), (a, b, threshold)


def test_names_meet_few_others(spark):
    """Of 499,500 pairs of unlike names few are looked at."""
    rng = random.Random(7)
    names = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=12)) for _ in range(1000)]
    tokens = [[f"{c}{n[: i + 1].count(c)}" for i, c in enumerate(n)] for n in names]
    uses = Counter(t for some in tokens for t in some)
    marks = [set(N.signatures(sorted(some, key=lambda t: (uses[t], t)), 0.9)) for some in tokens]
    met = sum(len(x & y) > 0 for x, y in combinations(marks, 2))
    assert met < 3000


def catalog_of(spark, n: int):
    """Tables of one row whose names and columns repeat in part."""
    rng, tables = random.Random(n), []
    for i in range(n):
        cols = dict.fromkeys(rng.sample(["order_id", "order_no", "orderid", "customer_code", "customer_id", "area_code", "created_by", "amount", "order_key", "ORDER_ID", "status"], 5))
        cols = list({c.lower(): c for c in cols}.values())
        kinds = [rng.choice(["bigint", "int", "string"]) for _ in cols]
        df = spark.createDataFrame([tuple(1 if k != "string" else "a" for k in kinds), tuple(2 if k != "string" else "b" for k in kinds)], ", ".join(f"{c} {k}" for c, k in zip(cols, kinds, strict=True)))
        tables.append(Table(f"t{i}", df, constraints=[Constraint("pk", (cols[0],), "k")] if i % 2 else [Constraint("index", (cols[1],), "i")]))
    return Catalog(spark, tables)


def test_candidates_by_join_are_those_of_the_loop(spark):
    p = profile_catalog(catalog_of(spark, 6), SHIPPED, exact="all")
    c = RelationConfig()
    want = candidates(describe(p), c)
    assert len(want) > 10 and found_candidates(p, c, pairs=0) == want and found_candidates(p, c) == want
    assert joined_candidates(p, c).count() == len([x for x in want if x.kind.startswith("single")])


# Sketches ---------------------------------------------------------------------------------------------------------------


def test_sketches_bound_scores(spark):
    big = spark.range(60_000)
    frames = {
        "a": big.selectExpr("id AS k", "CAST(id AS double) AS d", "CAST(id AS string) AS s", "id % 100 AS few"),
        "b": big.selectExpr("id + 30000 AS k", "id + 0.5D AS d", "CAST(id + 59000 AS string) AS s", "CAST(id % 50 AS int) AS few"),
        "c": spark.createDataFrame([], "k bigint, d double, s string, few int"),
    }
    sets = {t: [("k",), ("d",), ("s",), ("few",), ("k", "s")] for t in frames}
    sk = S.key_sketches(frames, sets).cache()
    assert sk.count() == 15
    weights = RelationConfig().weights
    pairs = [(t, x, u, y) for t in frames for u in frames if t != u for x in sets[t] for y in sets[u] if len(x) == len(y)]
    meta = spark.createDataFrame([(t, list(x), u, list(y), 1.0, 1.0) for t, x, u, y in pairs], "source string, source_columns array<string>, target string, target_columns array<string>, name_similarity double, type_compatibility double")
    bounds = {(r.source, tuple(r.source_columns), r.target, tuple(r.target_columns)): r.score_bound for r in S.score_bounds(meta, sk, weights).collect()}

    def true_score(t, x, u, y):
        value = lambda f, c: {tuple(r) for r in f.select(*[F.expr(str(k)) for k in c]).collect()}
        s, o = value(frames[t], x), value(frames[u], y)
        both = len(s & o)
        return 0.55 * both / max(len(s), 1) + 0.2 * both / max(len(s | o), 1) + 0.25

    for key in [("a", ("k",), "b", ("k",)), ("b", ("k",), "a", ("k",)), ("a", ("d",), "b", ("d",)), ("a", ("k",), "b", ("d",)), ("a", ("s",), "b", ("s",)), ("a", ("few",), "b", ("few",)), ("a", ("k",), "c", ("k",))]:
        assert bounds[key] >= true_score(*key)
    assert bounds["a", ("d",), "b", ("d",)] < 0.3 and bounds["a", ("s",), "b", ("s",)] < 0.4 and bounds["a", ("k",), "c", ("k",)] < 0.27
    assert bounds["a", ("few",), "b", ("few",)] == pytest.approx(0.55 * 0.5 + 0.2 * 0.5 + 0.25, abs=1e-6)  # small sets are exact
    odd = spark.createDataFrame([(1, [1])], "a int, b array<int>").withColumn("a", F.col("a").cast("decimal(9,2)"))
    assert S.key_value(odd, ["a"]) is None and S.key_sketches({"t": odd}, {"t": [("b",)]}) is None


def test_sketches_change_no_decision(spark, sf):
    p = core.profiled(spark, sf, keys=False)
    want = {r.relationship_id: (r.decision, r.reason) for r in discover(p).collect()}
    out = decisions(p).collect()
    assert {r.relationship_id: (r.decision, r.reason) for r in out} == want
    spared = [r for r in out if r.composite_score is None]
    assert len(spared) >= 3 and all(r.score_bound < 0.65 for r in spared)
    kept = len(p.sketches)
    decisions(p)
    assert len(p.sketches) == kept  # a second call reads no column again


# Keys -------------------------------------------------------------------------------------------------------------------


class Row:
    def __init__(self, column, ordinal, total, unique):
        self.column, self.ordinal, self.role, self.data_type = column, ordinal, "identifier", "bigint"
        self.sample_count, self.null_count, self.unique_count = total, 0, unique


def wide(spark, n=3000, columns=60):
    """n rows, the 60 columns of few values; a_id, b_id and c_id tell rows apart, and so does no other set of three."""
    exprs = ["id % 17 AS a_id", "floor(id / 17) % 19 AS b_id", "floor(id / 323) AS c_id"] + [f"pmod(hash(id, {i}), {5 + i % 9}) AS x{i}_id" for i in range(columns - 3)]
    return spark.range(n).selectExpr(*exprs)


def test_keys_of_a_wide_table(spark, monkeypatch):
    df = wide(spark).cache()
    n = df.count()
    uniques = df.agg(*[F.count_distinct(c).alias(c) for c in df.columns]).first()
    looked = []
    real = K.nearly_unique
    monkeypatch.setattr(K, "nearly_unique", lambda d, sets, total: looked.extend(sets) or real(d, sets, total))
    found = K.logical_keys(df, [Row(c, i, n, uniques[c]) for i, c in enumerate(df.columns)], SHIPPED)
    assert [set(k.columns) for k in found] == [{"a_id", "b_id", "c_id"}]
    assert len(looked) < 500  # of 35,990 sets of two and three


@pytest.mark.parametrize("seed", range(3))
def test_keys_are_those_of_all_combinations(spark, seed, monkeypatch):
    monkeypatch.setattr(K, "AT_ONCE", 3)
    monkeypatch.setattr(K, "PAIRED", [2, 8, 300][seed % 3])
    rng = random.Random(seed)
    cols = [f"{c}_id" for c in "abcdefg"]
    rows = list({tuple(rng.randrange(rng.choice([2, 4, 9])) for _ in cols) for _ in range(rng.choice([6, 25, 60]))})
    df = spark.createDataFrame(rows, ", ".join(f"{c} bigint" for c in cols)).cache()
    n, want = len(rows), set()
    for size in (1, 2, 3):
        want = {s for s in combinations(range(len(cols)), size) if len({tuple(r[i] for i in s) for r in rows}) == n}
        if want:
            break
    found = K.logical_keys(df, [Row(c, i, n, len({r[i] for r in rows})) for i, c in enumerate(cols)], BARE)
    assert {tuple(cols.index(c) for c in k.columns) for k in found} == want


def test_agree_sets():
    m = np.array([[1, 1, 0], [1, 0, 0], [0, 0, 1], [0, 0, 1], [1, 1, 0]], bool)
    assert sorted(map(tuple, K.maximal(m).tolist())) == [(False, False, True), (True, True, False)]
    assert len(K.maximal(m[:0])) == 0


def test_sets_that_repeat_values_are_not_counted(spark, monkeypatch):
    """Two equal rows in a part of the values rule out sets that are unique but for a tenth of the rows."""
    df = spark.range(20_000).selectExpr("id % 2000 AS a_id", "floor(id / 2000) AS b_id", "pmod(hash(id, 1), 60000) AS x_id", "pmod(hash(id, 2), 4) AS y_id").cache()
    uniques = df.agg(*[F.count_distinct(c).alias(c) for c in df.columns]).first()
    counted, real = [], K.distinct_counts
    monkeypatch.setattr(K, "distinct_counts", lambda d, sets: counted.extend(sets) or real(d, sets))
    found = K.logical_keys(df, [Row(c, i, 20_000, uniques[c]) for i, c in enumerate(df.columns)], SHIPPED)
    assert ("a_id", "b_id") in [k.columns for k in found]
    assert df.select("x_id", "y_id").distinct().count() > 0.85 * 20_000 and ("x_id", "y_id") not in counted
    assert K.nearly_unique(df, [], 20_000) == [] and K.nearly_unique(df, [("x_id", "y_id"), ("a_id", "b_id")], 20_000, at_once=1) == [("a_id", "b_id")]
