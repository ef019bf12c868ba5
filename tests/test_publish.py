import json
from pathlib import Path

import pytest

from quernstone.config import BARE
from quernstone.operators import dimvalues as V
from quernstone.operators import domains as D
from quernstone.operators import export as E
from quernstone.operators import external as X
from quernstone.operators import graph as G
from quernstone.operators import retrieval as Q
from quernstone.operators import sqlcheck as C
from quernstone.operators import vectors as W
from quernstone.plans.profile import profile_catalog
from quernstone.sources import ddl, documents
from quernstone.sources.catalog import Catalog, Column, Constraint, Table, excluded, head_sample, pg_array, preview_sample, row_estimate, schemas, table_exists
from quernstone.streaming.profile import drift, windowed_profile


def described() -> Table:
    return Table(
        "item", None, "shop", "db", "It's here",
        [Column("id", "character varying", 32, nullable=False, comment="key"), Column("day", "date"), Column("price", "numeric", None, 10, 2, default="0", comment="what's paid"), Column("n", "integer")],
        [Constraint("pk", ("id", "day"), "item_pkey", unique=True), Constraint("fk", ("day", "n"), "fk1", ("shop", "days", ("d", "m"))), Constraint("uk", ("n",), "item_n", unique=True), Constraint("index", ("n", "day"), "item_i", unique=True)],
    )


def test_ddl_round_trip():
    t = described()
    back = ddl.parse(E.ddl(t, [{"id": "a", "n": "1"}]))
    assert (back.full_name, back.comment, back.columns, back.samples) == (t.full_name, t.comment, t.columns, [{"id": "a", "n": "1"}])
    facts = lambda x: sorted((c.kind, c.columns, c.ref, c.unique) for c in x.constraints)
    assert facts(back) == facts(t)


def test_ddl_quotes_and_brackets():
    t = ddl.parse("""CREATE TABLE s.t ("a b" numeric(10, 2) NOT NULL DEFAULT 0.5, c varchar(9) DEFAULT 'x, (y' NOT NULL, d timestamp(3) with time zone NULL, e int[] DEFAULT ARRAY[1,2], f text CHECK (f IN ('a', 'b')) DEFAULT concat('a', 'NOT NULL'), g int UNIQUE PRIMARY KEY)""")
    got = [(c.name, c.data_type, c.char_length, c.precision, c.scale, c.nullable, c.default) for c in t.columns]
    assert got == [
        ("a b", "numeric", None, 10, 2, False, "0.5"), ("c", "varchar", 9, None, None, False, "'x, (y'"), ("d", "timestamp with time zone", None, None, None, True, None),
        ("e", "int[]", None, None, None, True, "ARRAY[1,2]"), ("f", "text", None, None, None, True, "concat('a', 'NOT NULL')"), ("g", "int", None, None, None, False, None),
    ]
    assert [(c.kind, c.columns) for c in t.constraints] == [("pk", ("g",)), ("uk", ("g",))]


def test_ddl_inline_and_alter():
    text = 'CREATE TABLE s.t (a serial PRIMARY KEY, b varchar(5) UNIQUE, c int NOT NULL REFERENCES x(y)); ALTER TABLE s.t ADD CONSTRAINT f FOREIGN KEY (a, c) REFERENCES s.u (p, q); CREATE INDEX i ON s.t USING hash (b);'
    t = ddl.parse(text)
    assert [(c.kind, c.columns) for c in t.constraints] == [("pk", ("a",)), ("uk", ("b",)), ("fk", ("c",)), ("fk", ("a", "c")), ("index", ("b",))]
    assert t.constraints[2].ref == ("s", "x", ("y",)) and t.constraints[4].method == "hash" and not t.columns[0].nullable


def test_ddl_files(tmp_path):
    Path(tmp_path, "db.shop.item.sql").write_text(E.ddl(described()))
    assert ddl.load(str(tmp_path), "shop", "item", "db").name == "item"
    Path(tmp_path, "db.shop.other.sql").write_text(E.ddl(described()))
    with pytest.raises(ValueError):
        ddl.load(str(tmp_path), "shop", "other", "db")


def test_markdown_round_trip(spark):
    text = E.markdown(described(), [{"id": "a"}, {"id": "b"}, {"id": "c"}])
    assert "[示例: a, b]" in text and "精确到小数点后2位" in text
    rows = documents.column_comments(spark.createDataFrame([("shop", "item", text)], "schema string, table string, text string")).collect()
    assert {r.column: r.comment for r in rows} == {"id": "key", "day": "无注释", "price": "what's paid", "n": "无注释"}


def test_profile_documents(spark, tmp_path):
    t = Table("t", spark.createDataFrame([(1, "x"), (2, "y")], "id int, flag string"), constraints=[Constraint("pk", ("id",))])
    p = profile_catalog(Catalog(spark, [t]), BARE)
    doc = E.profile_json(t, p.columns.orderBy("ordinal").collect(), p.tables.first(), (), E.sample_rows(t.frame, by=["id"]))
    Path(tmp_path, "t.json").write_text(json.dumps(doc))
    Path(tmp_path, "_template.json").write_text("{}")
    assert list(documents.profiles(str(tmp_path))) == ["public.t"]
    assert doc["sample_records"] == [{"id": 1, "flag": "x"}, {"id": 2, "flag": "y"}]
    Path(tmp_path, "_template.json").unlink()
    rows = documents.profile_rows(spark, str(tmp_path)).orderBy("column").collect()
    assert [(r.column, r.role) for r in rows] == [("flag", "attribute"), ("id", "identifier")]
    seen = X.prompt_view(doc)
    assert "table_profile" not in seen and "structure_flags" not in seen["column_profiles"]["id"]


def test_settings(tmp_path):
    Path(tmp_path, "a.json").write_text('{"u": "${HOST:local}/${NAME}"}')
    doc = documents.settings(str(tmp_path / "a.json"))
    assert documents.with_variables(doc, {"NAME": "n"}) == {"u": "local/n"}
    with pytest.raises(KeyError):
        documents.with_variables(doc, {})
    dims = documents.dim_tables({"databases": {"db": {"tables": {"public.a": {"embedding_col": "x, y"}, "b": None}}}})
    assert [(d.schema, d.table, d.columns) for d in dims] == [("public", "a", ("x", "y")), ("public", "b", ())]
    assert X.merged_settings({"a": {"b": 1, "c": [1]}}, {"a": {"c": [2]}}) == {"a": {"b": 1, "c": [2]}}


def test_catalog_helpers(spark):
    assert excluded("public", "tmp_a", ["tmp_*"]) and excluded("public", "a", ["public.a"]) and not excluded("public", "a", ["x.public.a", "other.a"])
    assert "default" in schemas(spark) and not table_exists(spark, "default", "nothing")
    df = spark.createDataFrame([(None, None), (3, "c"), (1, "a")], "a int, b string")
    assert [r.a for r in preview_sample(df, ["a"]).collect()] == [1, 3]
    assert head_sample(df, 1, ["a"]).first().a is None
    got = spark.createDataFrame([("{a,\"b\"}",), ("{}",), (None,)], "x string").select(pg_array(__import__("pyspark.sql.functions", fromlist=["col"]).col("x")).alias("p")).collect()
    assert [r.p for r in got] == [["a", "b"], [], []]


def test_replies():
    one = {"type": "single_column", "from_table": {"schema": "public", "table": "A"}, "to_table": {"schema": "public", "table": "b"}, "from_column": "Id", "to_column": "a_id"}
    text = "see {not json} ```json\n" + json.dumps({"relationships": [one, "x"]}) + "\n``` and {\"relationships\": []}"
    assert X.relationships_in(text) == [one] and X.relationships_in("{}") == [] == X.relationships_in(None)
    assert X.relationships_in('noise {"a": "}"} {"relationships": [{"k": "{"}]}') == [{"k": "{"}]
    assert X.list_in("x [1, 2] y") == [1, 2]
    assert X.ask(["a", "b"], lambda p: p.upper() if p == "a" else 1 / 0) == ["A", ""]


def test_external_candidates(spark):
    one = {"from_table": {"schema": "public", "table": "A"}, "to_table": {"schema": "public", "table": "b"}, "from_column": "Id", "to_column": "a_id"}
    loop = {"from_table": {"schema": "public", "table": "a"}, "to_table": {"schema": "public", "table": "a"}, "from_columns": ["x", "y"], "to_columns": ["Y", "X"]}
    far = one | {"to_table": {"schema": "public", "table": "z"}}
    found = X.candidate_rows(spark, [(("public.a", "public.b"), json.dumps({"relationships": [one, loop, far]}))])
    assert found.count() == 1
    columns = spark.createDataFrame([("public", "a", "id", "integer"), ("public", "b", "a_id", "text")], "schema string, table string, column string, data_type string")
    named = X.canonical_names(found, columns)
    r = named.first()
    assert (r.source, r.source_columns, r.target, r.target_columns) == ("public.a", ["id"], "public.b", ["a_id"])
    lattice = spark.createDataFrame([("integer", "text", 0.0)], "a string, b string, score double")
    assert X.known_types(named, columns, lattice, 0.8).count() == 0 and X.known_types(found, columns, lattice, 0.8).count() == 1
    roles = spark.createDataFrame([("public", "b", "a_id", "metric")], "schema string, table string, column string, role string")
    assert X.known_roles(named, roles, ["metric"]).count() == 0 and X.known_roles(named, roles, ["audit"]).count() == 1
    stated = Catalog(spark, [Table("b", spark.range(1), constraints=[Constraint("fk", ("a_id",), "k", ("public", "a", ("id",)))])]).constraints_frame()
    assert X.without_stated(named, stated).count() == 0


def test_domains(spark):
    tables = spark.createDataFrame([("db", "public", t, None) for t in ("A", "b", "c", "d")], "database string, schema string, table string, comment string")
    d = D.domain_rows(spark, [("x", ["db.public.a", "b"]), ("y", ["public.b", "C"])])
    pairs = lambda *a, **k: {(r.left, r.right, r.domain) for r in D.table_pairs(*a, **k).collect()}
    assert len(pairs(tables)) == 6
    assert pairs(tables, d) == {("public.A", "public.b", "x"), ("public.b", "public.c", "y")}
    assert pairs(tables, d, cross=True) - pairs(tables, d) == {("public.A", "public.c", None)}
    texts = spark.createDataFrame([("p", "b", "# b\nmore"), ("p", "a", "x" * 300)], "schema string, table string, text string")
    assert D.domain_context(texts).first().context == "p.a: " + "x" * 200 + "\np.b: # b" and D.domain_context(texts, "name").first().context == "p.a\np.b"
    assert D.chosen(d, "y").count() == 2 and D.chosen(d, "all").count() == 4
    assert D.normalised_domains([{"name": "n", "tables": ["A", "a", "zz"]}], ["a", "b"]) == [(D.UNSORTED, "", ["b"]), ("n", "", ["a"])]


def test_sql_checks(spark, sf):
    spark.read.parquet(f"{sf}/nation.parquet").createOrReplaceTempView("nation")
    good = C.validate(spark, "SELECT n_name, count(*)::numeric AS n FROM nation GROUP BY n_name HAVING count(*) > 0 ORDER BY 2 LIMIT 3;")
    bad = C.validate(spark, "SELECT company_no FROM nation")
    assert good.valid and not bad.valid and "UNRESOLVED_COLUMN" in bad.error_class
    assert not C.validate(spark, "DROP TABLE nation").valid and spark.table("nation").count() == 25
    assert C.validate(spark, "SELECT 1; SELECT 2").error_class == "NOT_ONE_STATEMENT" and not C.validate(spark, " ; ").valid
    verdicts = C.validate_all(spark, [("q1", "SELECT 1 AS a"), ("q2", "SELECT x")])
    assert [r.valid for r in verdicts.orderBy("position").collect()] == [True, False]
    fixed = C.repair(spark, verdicts, lambda q, s, e: "SELECT 2 AS x")
    assert [r.sql for r in C.kept_pairs(fixed).orderBy("position").collect()] == ["SELECT 1 AS a", "SELECT 2 AS x"]
    assert "valid: 1 (50.00 %)" in C.report(verdicts)
    assert C.table_names("select * from A join b on 1=1 JOIN a") == ["A", "b"]
    assert spark.createDataFrame([(" select\n 1 ",)], "s string").select(C.clean_pair(__import__("pyspark.sql.functions", fromlist=["col"]).col("s"))).first()[0] == "select 1;"
    assert C.generate_pairs([("d", "ctx")], 1, lambda d, c, n: [("q", "s"), ("r", "t")]) == [("d", "q", "s")]


def test_graph(spark, tmp_path):
    rel = spark.createDataFrame([("p.a", ["x", "y"], "p.b", ["u", "v"], "1:N", "r1"), ("p.a", ["x"], "p.b", ["u"], "1:N", "r2"), ("p.a", ["x"], "p.c", ["u"], "1:1", "r3")], "source string, source_columns array<string>, target string, target_columns array<string>, cardinality string, relationship_id string")
    edges = {r.relationship_id: r for r in G.join_edges(rel).collect()}
    assert (edges["r1"].src, edges["r1"].on, edges["r1"].cardinality) == ("p.b", "SRC.u = DST.x AND SRC.v = DST.y", "N:1") and edges["r3"].src == "p.a"
    assert {r.relationship_id for r in G.join_edges(rel, single=True).collect()} == {"r2", "r3"}
    t = Table("t", spark.createDataFrame([(1, "x"), (2, "y")], "id int, flag string"), constraints=[Constraint("pk", ("id",))])
    p = profile_catalog(Catalog(spark, [t]))
    nodes, cols = G.table_nodes(p.tables, p.catalog.constraints_frame(), p.keys), G.column_nodes(p.columns)
    assert nodes.first().pk == [["id"]] and cols.where("is_pk").count() == 1
    assert {r.kind: r["count"] for r in G.graph_statistics(nodes, cols, G.join_edges(rel)).collect()} == {"table": 1, "column": 2, "has_column": 2, "join_on": 3}
    script = E.cypher(nodes, cols, G.join_edges(rel))
    assert script.startswith("// 1 tables, 2 columns, 3 relationships") and "MERGE (s)-[r:JOIN_ON" in script
    assert E.write_graph(str(tmp_path / "g"), nodes, cols, G.join_edges(rel)) == {"tables": 1, "columns": 2, "edges": 3}
    f = __import__("pyspark.sql.functions", fromlist=["col"])
    got = spark.createDataFrame([('[["a","b"],["c"]]',), ('["a"]',), ("x",)], "t string").select(G.nested_arrays(f.col("t")).alias("k")).collect()
    assert [r.k for r in got] == [[["a", "b"], ["c"]], [["a"]], []]
    assert E.dim_config(p.tables) == {"databases": {"db": {"tables": {"public.t": {"embedding_col": None}}}}}


def test_config_files_round_trip(spark, tmp_path):
    import yaml

    dims = spark.createDataFrame([("shop", "s", "b", "dim"), ("shop", "s", "a", "dim"), ("shop", "s", "f", "fact"), ("other", "s", "a", "dim")], "database string, schema string, table string, category string")
    path = tmp_path / "new" / "dims.yaml"
    E.write_dim_config(dims, str(path))
    held = yaml.safe_load(path.read_text())
    assert list(held["databases"]) == ["other", "shop"] and list(held["databases"]["shop"]["tables"]) == ["s.a", "s.b"]
    held["databases"]["shop"]["tables"]["s.b"]["embedding_col"] = ["x", "y"]
    path.write_text(yaml.safe_dump(held))
    E.write_dim_config(dims, str(path))
    assert {(t.database, t.table): t.columns for t in documents.dim_tables(yaml.safe_load(path.read_text()))} == {("other", "a"): (), ("shop", "a"): (), ("shop", "b"): ("x", "y")}
    at = tmp_path / "domains.yaml"
    at.write_text("database: {name: old, description: kept}\nother: 1\n")
    some = D.normalised_domains([{"name": "主题", "description": "d", "tables": ["A"]}], ["a", "b"])
    E.write_domains(str(at), "shop", some)
    doc = yaml.safe_load(at.read_text())
    assert doc["database"] == {"name": "shop", "description": "kept"} and doc["other"] == 1 and doc["llm_inference"] == {"max_domains_per_table": 3}
    assert documents.domains(doc) == [(D.UNSORTED, ["b"]), ("主题", ["a"])] and [x.name for x in tmp_path.iterdir() if x.is_file()] == ["domains.yaml"]


def test_placeholder_tables_are_no_nodes(spark):
    names = spark.createDataFrame([("table_name",), ("placeholder",), ("example",), ("",), (None,), ("_own",), ("t",)], "table string")
    assert sorted(r.table for r in G.real_tables(names).collect()) == ["_own", "t"]


def test_dim_values(spark):
    df = spark.createDataFrame([(" a ",), ("a",), ("",), (None,), ("b" * 2000,), ("b" * 1500,)], "v string")
    assert sorted(r.value for r in V.dim_values(df, "t", "v").collect()) == ["a", "b" * 1024]
    r = V.dim_value_counts(df, "t", ["v"]).first()
    assert (r.loaded, r.skipped) == (2, 2)
    assert V.dim_values(df, "t", None).count() == 0 and V.dim_values(df, "t", "v", limit=1).count() == 1
    out = V.embedded(V.dim_values(df, "t", "v"), "value", lambda xs: [[float(len(x))] for x in xs] if max(map(len, xs)) < 9 else 1 / 0, batch=1, retries=1)
    assert {r.value[0]: r.embedding for r in out.collect()} == {"a": [1.0], "b": None}


def test_row_estimate(spark, sf):
    assert row_estimate(spark.range(10)) == 10
    assert row_estimate(spark.read.parquet(f"{sf}/lineitem.parquet")) > 0


def test_top_k(spark):
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 0.0]), (4, [0.0, 1.0]), (5, None), (6, [1.0])], "vec_id bigint, embedding array<float>")
    assert [r.vec_id for r in Q.top_k(v, [2.0, 0.0], 3).collect()] == [1, 2, 3]
    j = W.exact_top_k(v.where("vec_id IN (1, 4)").selectExpr("vec_id AS query_id", "embedding"), v, 2)
    assert sorted((r.query_id, r.vec_id) for r in j.collect()) == [(1, 1), (1, 2), (4, 1), (4, 4)]
    assert W.exact_top_k(v.where("false").selectExpr("vec_id AS query_id", "embedding"), v, 2).count() == 0
    up = Q.upsert(v, spark.createDataFrame([(1, [9.0]), (7, [1.0])], v.schema), "vec_id")
    assert {r.vec_id: r.embedding for r in up.collect()}[1] == [9.0] and up.count() == 7


def test_retrieval_objects(spark):
    tables = spark.createDataFrame([("p", "t", "dim")], "schema string, table string, category string")
    columns = spark.createDataFrame([("p", "t", "a", 1, "date", "when"), ("p", "t", "b", 2, "text", " ")], "schema string, table string, column string, ordinal int, data_type string, comment string")
    texts = spark.createDataFrame([("p", "t", "# t")], "schema string, table string, text string")
    got = Q.retrieval_objects(tables, columns, texts).orderBy("object_id").collect()
    assert [(r.object_id, r.time_col_hint) for r in got] == [("p.t", "a"), ("p.t.a", None)]
    rel = spark.createDataFrame([("p.t", "p.u"), ("q.x", "q.y")], "source string, target string")
    assert Q.relevant_relations(rel, ["p.u"]).count() == 1 and Q.relevant_relations(rel, ["other.x"]).count() == 1


def test_stream_profile(spark, sf, tmp_path):
    events = spark.read.parquet(f"{sf}/events.parquet")
    stream = spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    q = windowed_profile(stream, "ts", ["value"], "1 day").writeStream.outputMode("complete").format("memory").queryName("seen").trigger(availableNow=True).option("checkpointLocation", str(tmp_path)).start()
    q.awaitTermination()
    key = lambda r: (r.window_start, r.rows, r.nulls)
    assert sorted(map(key, spark.table("seen").collect())) == sorted(map(key, windowed_profile(events, "ts", ["value"], "1 day").collect()))
    known = spark.createDataFrame([("value", 0.5, "1000000")], "column string, null_rate double, mean_value string")
    assert drift(spark.table("seen"), known).where("null_drift AND mean_drift").count() == spark.table("seen").count()
