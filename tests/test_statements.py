"""What statements read and join, by the analysed plan."""

import pytest

from quernstone.operators.statements import joins_of, statement, supported


@pytest.fixture(scope="module")
def views(spark):
    for name, columns in {"ord": "id bigint, cust int, total double, `odd name` string", "cust": "id int, name string, boss int", "line": "ord bigint, part bigint, qty int"}.items():
        spark.createDataFrame([], columns).createOrReplaceTempView(f"st_{name}")


O, C, L = "st_ord", "st_cust", "st_line"

CASES = {
    "SELECT o.total FROM st_ord o JOIN st_cust AS c ON o.cust = c.id": ([C, O], [((C, "id"), (O, "cust"))]),
    "select name from ST_CUST, st_ord where st_cust.id = cust and total > 3;": ([C, O], [((C, "id"), (O, "cust"))]),
    "SELECT count(*) FROM st_ord WHERE id IN (SELECT ord FROM st_line WHERE qty > 1)": ([L, O], [((L, "ord"), (O, "id"))]),
    "SELECT id FROM st_ord o WHERE EXISTS (SELECT 1 FROM st_line l WHERE l.ord = o.id)": ([L, O], [((L, "ord"), (O, "id"))]),
    "SELECT id FROM st_ord o WHERE total > (SELECT max(qty) FROM st_line l WHERE l.ord = o.id)": ([L, O], [((L, "ord"), (O, "id"))]),
    "WITH a AS (SELECT id AS k, cust AS c FROM st_ord), b AS (SELECT k, c FROM a) SELECT * FROM b JOIN st_cust ON b.c = st_cust.id": ([C, O], [((C, "id"), (O, "cust"))]),
    "SELECT * FROM (SELECT ord AS o, sum(qty) FROM st_line GROUP BY ord) x LEFT JOIN st_ord ON x.o = st_ord.id": ([L, O], [((L, "ord"), (O, "id"))]),
    "SELECT a.name FROM st_cust a JOIN st_cust b ON a.boss = b.id": ([C], [((C, "boss"), (C, "id"))]),
    "SELECT * FROM st_ord JOIN st_line ON st_ord.id = st_line.ord AND st_ord.cust = st_line.part": ([L, O], [((L, "ord"), (O, "id")), ((L, "part"), (O, "cust"))]),
    "SELECT * FROM st_ord o JOIN st_line l ON o.id = l.ord OR o.cust = l.part": ([L, O], []),
    "SELECT * FROM st_ord o JOIN st_line l ON NOT (o.id = l.ord)": ([L, O], []),
    "SELECT * FROM st_cust JOIN (SELECT id FROM st_ord) USING (id)": ([C, O], [((C, "id"), (O, "id"))]),
    "SELECT * FROM st_ord o JOIN st_cust c ON CAST(o.cust AS string) = CAST(c.id AS string) AND o.id + 1 = c.id": ([C, O], [((C, "id"), (O, "cust"))]),
    "SELECT 'FROM st_line' AS x, `odd name` FROM st_ord": ([O], []),
    "SELECT id FROM st_ord UNION ALL SELECT ord FROM st_line": ([L, O], []),
    "SELECT 1 AS one": ([], []),
}


@pytest.mark.parametrize("sql", CASES)
def test_tables_and_joins(spark, views, sql):
    got = statement(spark, sql)
    assert (got.tables, got.joins) == CASES[sql]


def test_columns_of_a_statement(spark, views):
    got = statement(spark, "SELECT c.name AS n FROM (SELECT cust AS k FROM st_ord WHERE total > 1) o JOIN st_cust c ON o.k = c.id")
    assert set(got.columns) == {(C, "name"), (C, "id"), (O, "cust"), (O, "total")}
    assert (O, "odd name") in statement(spark, "SELECT `odd name` FROM st_ord").columns
    for bad in ("SELECT nothing FROM st_ord", "SELECT * FROM st_none", "DROP VIEW st_ord"):
        with pytest.raises(Exception, match=r"UNRESOLVED|NOT_FOUND|PARSE|SYNTAX"):
            statement(spark, bad)


def test_joins_beside_edges(spark, views):
    joins = joins_of(spark, {"a": "SELECT 1 FROM st_ord o, st_cust c WHERE o.cust = c.id", "b": "SELECT 1 FROM st_ord o, st_line l WHERE o.id = l.part"})
    edges = spark.createDataFrame([("public.st_ord", "public.st_cust", ["cust"], ["id"], "rel_1", "N:1"), ("public.st_ord", "public.st_line", ["id", "cust"], ["ord", "part"], "rel_2", "1:1")], "src string, dst string, source_columns array<string>, target_columns array<string>, relationship_id string, cardinality string")
    got = {r.statement: (r.left, r.right, r.relationship_id, r.cardinality) for r in supported(joins, edges).collect()}
    assert got == {"a": (C, O, "rel_1", "N:1"), "b": (L, O, None, None)}
    assert joins_of(spark, {}).count() == 0
