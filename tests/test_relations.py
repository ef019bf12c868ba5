from types import SimpleNamespace as NS

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quernstone import storage
from quernstone.config import SHIPPED, RelationConfig
from quernstone.operators import decide as D
from quernstone.operators import metrics as M
from quernstone.operators.candidates import Candidate, Described, candidates, composite_candidates, match_as_set, single_candidates
from quernstone.operators.keys import LogicalKey, confidence, distinct_counts, logical_keys
from quernstone.plans import queries as core
from quernstone.plans.discover import discover
from quernstone.plans.profile import profile_catalog
from quernstone.sources.catalog import Catalog, Constraint, Table


def table(name, columns, **keys):
    return Described("public", name, {c: NS(data_type=t, role=r, uniqueness=1.0) for c, t, r in columns}, **keys)


def test_key_confidence():
    assert confidence(["o_orderkey"], ["bigint"], ("id", "code", "key")) == 0.91
    assert confidence(["r_name"], ["text"], ("id", "code", "key")) == 0.69


def test_minimal_keys(spark):
    df = spark.createDataFrame([(1, 1, 5), (1, 2, 5), (2, 1, 5), (2, 2, 6)], "a_id int, b_id int, c_id int")
    rows = [NS(column=c, ordinal=i, role="identifier", data_type="integer", sample_count=4, null_count=0, unique_count=2) for i, c in enumerate(df.columns)]
    found = logical_keys(df, rows)
    assert [k.columns for k in found] == [("a_id", "b_id")]
    assert logical_keys(df, rows, has_primary_key=True) == []


def test_estimates_do_not_prune_keys(spark):
    """A full grid, with distinct counts estimated too low."""
    df = spark.range(3600).selectExpr("id div 60 AS store_id", "id % 60 AS product_id", "1 AS n_id")
    rows = [NS(column=c, ordinal=i, role="identifier", data_type="bigint", sample_count=3600, null_count=0, unique_count=n) for i, (c, n) in enumerate(zip(df.columns, (59, 60, 1), strict=True))]
    assert [k.columns for k in logical_keys(df, rows)] == [("store_id", "product_id")]


def test_distinct_counts_hold_nulls_apart(spark):
    df = spark.createDataFrame([(1, None), (1, "null"), (1, None)], "a int, b string")
    assert distinct_counts(df, [("a", "b")]) == {("a", "b"): 2}


def test_overlap_drops_incomplete_keys(spark):
    s = spark.createDataFrame([(1, "x"), (2, None), (1, "x")], "a int, b string")
    t = spark.createDataFrame([(1, "x"), (1, "x"), (3, "y")], "a bigint, b string")
    m = M.overlap(s, ["a", "b"], t, ["a", "b"]).first()
    assert (m.source_rows, m.source_distinct, m.target_distinct, m.common, m.joined_rows, m.inclusion_rate, m.jaccard_index, m.multiplicity) == (2, 1, 2, 1, 4, 1.0, 0.5, 2.0)


def test_empty_side(spark):
    m = M.overlap(spark.createDataFrame([(None,)], "a int"), ["a"], spark.createDataFrame([(1,)], "a int"), ["a"]).first()
    assert (m.inclusion_rate, m.jaccard_index, m.source_uniqueness, m.multiplicity) == (0.0, 0.0, 0.0, 1.0)


def test_texts_never_equal_numbers(spark):
    m = M.overlap(spark.createDataFrame([("1",)], "a string"), ["a"], spark.createDataFrame([(1,)], "a int"), ["a"]).first()
    assert (m.common, m.source_distinct, m.target_distinct) == (0, 1, 1)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=12), st.lists(st.integers(0, 6), max_size=12))
def test_overlap_properties(spark, a, b):
    s, t = spark.createDataFrame([(x,) for x in a], "k int"), spark.createDataFrame([(x,) for x in b], "k int")
    m, r = M.overlap(s, ["k"], t, ["k"]).first(), M.overlap(t, ["k"], s, ["k"]).first()
    assert m.jaccard_index == r.jaccard_index and m.jaccard_index <= m.inclusion_rate <= 1 and m.common <= min(m.source_distinct, m.target_distinct)
    assert m.joined_rows == sum(x == y for x in a for y in b)


def test_score_golden(spark):
    row = spark.createDataFrame([(1.0, 1.0, 0.566, 0.8057)], "name_similarity double, type_compatibility double, jaccard_index double, inclusion_rate double")
    weights = {"inclusion_rate": 0.55, "jaccard_index": 0.10, "name_similarity": 0.20, "type_compatibility": 0.15}
    assert round(row.select(D.score(weights)).first()[0], 4) == 0.8497


@pytest.mark.parametrize(("su", "tu", "m", "want"), [(1, 1, 1, "1:1"), (1, 0.5, 3, "1:N"), (0.5, 1, 1, "N:1"), (0.9, 0.5, 1.0, "1:1"), (0.4, 0.5, 0.0, "N:1"), (0.9, 0.85, 2, "1:N"), (0.5, 0.5, 2, "M:N"), (0.9, 0.9, 1.3, "M:N")])
def test_cardinality(spark, su, tu, m, want):
    got = spark.range(1).select(D.inferred_cardinality(F.lit(float(su)), F.lit(float(tu)), F.lit(float(m)))).first()[0]
    assert got == want
    assert D.needs_join(su, tu) or got in ("1:1", "1:N", "N:1")


def test_ids_do_not_depend_on_column_order(spark):
    make = lambda a, b: spark.range(1).select(D.relationship_id(F.lit("p.a"), F.array(*map(F.lit, a)), F.lit("p.b"), F.array(*map(F.lit, b)))).first()[0]
    assert make(["x", "y"], ["u", "v"]) == make(["y", "x"], ["v", "u"]) and make(["x"], ["u"]).startswith("rel_")


def test_suppression(spark):
    rows = [("a", "b", ["x", "y"], 0.9, False), ("a", "b", ["x"], 0.9, False), ("a", "b", ["y"], 0.9, True), ("b", "a", ["x"], 0.9, False), ("a", "c", ["x", "y"], 0.1, False), ("a", "c", ["x"], 0.7, False)]
    df = spark.createDataFrame(rows, "source string, target string, source_columns array<string>, composite_score double, exempt boolean")
    got = [(r.source, r.target, r.source_columns, r.reason) for r in D.decide(df).orderBy("source", "target", "source_columns").collect()]
    assert [g[3] for g in got] == ["suppressed_by_composite", None, None, None, "below_threshold", None]


def test_weights_are_checked():
    with pytest.raises(ValueError):
        RelationConfig(weights={"inclusion_rate": 1.0})


def test_single_candidates():
    orders = table("orders", [("o_orderkey", "bigint", "identifier")], primary_keys=[("o_orderkey",)])
    lines = table("lineitem", [("l_orderkey", "bigint", "identifier"), ("l_partkey", "bigint", "identifier")])
    part = table("part", [("p_partkey", "bigint", "identifier")], primary_keys=[("p_partkey",)])
    got = {(c.source, c.target_columns) for c in single_candidates([orders, lines, part])}
    assert ("public.orders", ("l_orderkey",)) in got and ("public.part", ("l_partkey",)) not in got


def test_roles_exclude_unless_names_are_equal():
    a = table("a", [("amount", "bigint", "metric")], primary_keys=[("amount",)])
    same = table("b", [("amount", "bigint", "metric")])
    like = table("c", [("amounts", "bigint", "metric")])
    assert [c.target for c in single_candidates([a, same, like])] == ["public.b"]


def test_composites_match_in_any_order():
    a = table("a", [("order_id", "bigint", "identifier"), ("order_date", "date", "audit")], primary_keys=[("order_id", "order_date")])
    b = table("b", [("order_date", "date", "audit"), ("order_id", "bigint", "identifier")], indexes=[("order_date", "order_id")])
    found = composite_candidates([a, b])
    assert found == [Candidate("public.a", ("order_id", "order_date"), "public.b", ("order_id", "order_date"), "composite_physical")]
    assert match_as_set(a, ("order_id",), b, ("order_date",), RelationConfig()) is None


def test_foreign_keys_are_not_found_again():
    a = table("a", [("id", "bigint", "identifier")], primary_keys=[("id",)])
    b = table("b", [("id", "bigint", "identifier")], foreign_keys=[(("id",), "public", "a", ("id",))])
    assert candidates([a, b]) == [] and len(candidates([a, b], RelationConfig(legacy_fk_dedup=True))) == 1


def test_logical_sources():
    a = table("a", [("id", "bigint", "identifier")], logical_keys=[LogicalKey(("id",), 0.95)])
    b = table("b", [("id", "bigint", "identifier")])
    assert [c.kind for c in candidates([a, b])] == ["single_logical_key"]


def test_discovery_end_to_end(spark):
    head = spark.createDataFrame([(i, i % 3) for i in range(50)], "order_id bigint, kind int")
    items = spark.createDataFrame([(i, i // 2, 1) for i in range(100)], "item_id bigint, order_id bigint, qty int")
    c = Catalog(spark, [Table("order_header", head, constraints=[Constraint("pk", ("order_id",))]), Table("order_item", items, constraints=[Constraint("fk", ("item_id",), "made", ("public", "order_header", ("order_id",)))])])
    got = {(r.kind, r.source): r for r in discover(profile_catalog(c)).collect()}
    found = got["single_defined_constraint", "public.order_header"]
    assert (found.decision, found.cardinality, found.composite_score, found.source_constraint, found.discovery_method) == ("accepted", "1:N", 1.0, "single_field_primary_key", "active_search")
    fk = got["foreign_key", "public.order_item"]
    assert (fk.decision, fk.cardinality, fk.composite_score, fk.constraint_name) == ("accepted", "1:1", None, "made")


def test_overlaps_in_batches_are_those_of_one_plan(spark):
    a, b = spark.createDataFrame([(1, 2), (1, None), (3, 4)], "x int, y int"), spark.createDataFrame([(1, 4), (4, 4)], "x int, y int")
    pairs = [(f"{s}{t}", a, [s], b, [t]) for s in "xy" for t in "xy"] + [("both", a, ["x", "y"], b, ["x", "y"])]
    found = [sorted(map(str, M.overlaps(pairs, n).collect())) for n in (64, 2, 1)]
    assert len(found[0]) == 5 and found[0] == found[1] == found[2]
    assert M.overlaps([]) is None


def test_nearly_unique_keys_are_dealt_over_more_parts(spark, monkeypatch):
    """No task holds more keys because tables are larger; keys that repeat often are summed before the shuffle."""
    catalog = lambda: Catalog(spark, [Table(n, spark.range(rows).selectExpr("id AS order_id", "id % 7 AS part_id", "id * 10 AS line_id"), constraints=[Constraint("uk", ("order_id", "part_id"), "pair", unique=True)]) for n, rows in (("first", 1000), ("second", 900))])
    told = lambda df: sorted(map(str, df.select("source", "source_columns", "target", "target_columns", "composite_score", "decision").collect()))
    whole = told(discover(profile_catalog(catalog(), SHIPPED)))
    monkeypatch.setattr(storage, "KEYS", 20)
    seen, plain = [], M.overlap
    monkeypatch.setattr(M, "overlap", lambda *a: seen.append(a[4]) or plain(*a))
    assert told(discover(profile_catalog(catalog(), SHIPPED))) == whole
    assert whole and set(seen) == {64}
    counts = M.key_counts(catalog()["first"].frame, ["order_id", "part_id"], None, 64)
    assert max(r["count"] for r in counts.groupBy(F.spark_partition_id()).count().collect()) < 3 * 20
    assert storage.key_parts(spark, 1000, 1000) == 64
    assert storage.key_parts(spark, 1000, 5000) is None and storage.key_parts(spark, 50, 100) is None


def test_orders_are_told_apart_where_their_lines_are(spark, sf, monkeypatch):
    """More lines make more parts of each join, and no task tells apart the orders of all parts."""
    query = core.queries()["sql_corpus_three_tables"]
    plain = sorted(query(spark, sf).collect())
    monkeypatch.setattr(storage, "KEYS", 100)
    dealt = query(spark, sf)
    assert sorted(dealt.collect()) == plain
    plan = dealt._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == 4 and "distinct" not in plan
