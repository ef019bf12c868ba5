"""The metadata data source, and stateful profiles of streams."""

import datetime as dt
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from quernstone.operators import export as E
from quernstone.sources import files as FS
from quernstone.sources.catalog import Catalog, Column, Constraint, Table
from quernstone.storage import shared_folder
from quernstone.streaming import stateful as ST


@pytest.fixture(scope="module")
def folder(spark):
    """DDL, JSON and Markdown of three tables, and files that are none."""
    FS.register(spark)
    path = shared_folder(spark)
    tables = [
        Table("a", None, "public", "db", "first, 'quoted'", [Column("id", "bigint", nullable=False), Column("code", "varchar", 32, comment="the code"), Column("price", "numeric", None, 10, 2)], [Constraint("pk", ("id",), "a_pk", unique=True), Constraint("index", ("code", "id"), "a_i")]),
        Table("b", None, "public", "db", None, [Column("a_id", "bigint"), Column("day", "date")], [Constraint("fk", ("a_id",), "b_fk", ("public", "a", ("id",))), Constraint("uk", ("a_id", "day"), "b_uk", unique=True)]),
        Table("c", None, "other", "db2", "third", [Column("x", "text")], []),
    ]
    spark.createDataFrame([(f"{t.database}.{t.full_name}.sql", E.ddl(t)) for t in tables] + [(f"{t.database}.{t.full_name}.md", E.markdown(t)) for t in tables], "file string, text string").repartition(3).write.format("table_metadata").option("path", path).mode("append").save()
    at = Path(path.removeprefix("file:"))
    (at / "_template.sql").write_text("not a table")
    (at / "notes.txt").write_text("no")
    assert not (at / "_temporary").exists()
    return path, tables


def read(spark, folder, kind, of="columns"):
    return spark.read.format("table_metadata").option("path", folder[0]).option("kind", kind).option("object", of).load()


def test_ddl_files_as_a_table(spark, folder):
    catalog = Catalog(spark, folder[1])
    got = read(spark, folder, "ddl").drop("role", "sample_count", "null_count", "unique_count")
    assert sorted(map(str, got.collect())) == sorted(map(str, catalog.columns_frame().select(*got.columns).collect()))
    assert sorted(map(str, read(spark, folder, "ddl", "constraints").collect())) == sorted(map(str, catalog.constraints_frame().collect()))
    assert {(r.table, r.comment) for r in read(spark, folder, "ddl", "tables").collect()} == {("a", "first, 'quoted'"), ("b", None), ("c", "third")}


def test_markdown_files_as_a_table(spark, folder):
    got = {(r.database, r.table, r.column): (r.ordinal, r.data_type, r.comment) for r in read(spark, folder, "markdown").collect()}
    assert got == {("db", "a", "id"): (1, "bigint", None), ("db", "a", "code"): (2, "varchar", "the code"), ("db", "a", "price"): (3, "numeric", None), ("db", "b", "a_id"): (1, "bigint", None), ("db", "b", "day"): (2, "date", None), ("db2", "c", "x"): (1, "text", None)}
    assert read(spark, folder, "markdown", "constraints").count() == 0


def test_filters_leave_out_files(spark, folder):
    ddl = read(spark, folder, "ddl")
    assert ddl.rdd.getNumPartitions() == 3
    one = ddl.where((F.col("table") == "a") & (F.col("schema") == "public")).select("column")
    assert one.rdd.getNumPartitions() == 1 and one.count() == 3
    assert ddl.where(F.col("table").isin("a", "c")).rdd.getNumPartitions() == 2
    assert ddl.where("table = 'nowhere'").count() == 0
    few = spark.read.format("table_metadata").schema("column string, table string").option("path", folder[0]).option("kind", "ddl").load()
    assert few.columns == ["column", "table"] and few.count() == 6


def test_json_files_as_a_table(spark, tmp_path):
    FS.register(spark)
    doc = {
        "table_info": {"database": "d", "schema_name": "s", "table_name": "t", "comment": "c", "total_rows": 4},
        "column_profiles": {"x": {"ordinal_position": 1, "data_type": "bigint", "is_nullable": True, "statistics": {"sample_count": 4, "null_count": 1, "unique_count": 3}, "semantic_analysis": {"semantic_role": "identifier"}}, "y": {}},
        "table_profile": {"table_category": "dim", "physical_constraints": {"primary_key": {"constraint_name": "k", "columns": ["x"]}, "foreign_keys": [{"constraint_name": "f", "source_columns": ["x"], "target_schema": "s", "target_table": "u", "target_columns": ["z"]}]}, "indexes": [{"index_name": "i", "columns": ["y"]}]},
    }
    (tmp_path / "d.s.t.json").write_text(json.dumps(doc))
    at = (str(tmp_path), None)
    assert {(r.column, r.role, r.unique_count) for r in read(spark, at, "json").collect()} == {("x", "identifier", 3), ("y", None, None)}
    assert {(r.kind, r.name, tuple(r.columns), r.ref_table) for r in read(spark, at, "json", "constraints").collect()} == {("pk", "k", ("x",), None), ("fk", "f", ("x",), "u"), ("index", "i", ("y",), None)}
    assert [(r.category, r.total_rows) for r in read(spark, at, "json", "tables").collect()] == [("dim", 4)]
    (tmp_path / "bad.json").write_text("{}")
    with pytest.raises(Exception, match="names no schema and table"):
        read(spark, at, "json").collect()
    with pytest.raises(Exception, match="kind is one of"):
        read(spark, at, "yaml").collect()


def test_names_of_files_are_checked(spark, tmp_path):
    FS.register(spark)
    write = lambda rows: spark.createDataFrame(rows, "file string, text string").write.format("table_metadata").option("path", str(tmp_path)).mode("append").save()
    for rows, said in (([("../x.sql", "")], "not a name"), ([("a.sql", "1"), ("a.sql", "2")], "two rows")):
        with pytest.raises(Exception, match=said):
            write(rows)
    assert not list(tmp_path.glob("*.sql"))


# Streams ----------------------------------------------------------------------------------------------------------------

DAY = dt.datetime(2024, 3, 1)


def at(day: int, hour: int = 1):
    return DAY + dt.timedelta(days=day, hours=hour)


def arriving(spark, tmp_path, batches):
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, "ts timestamp_ntz, v double, s string").coalesce(1).write.parquet(f"{tmp_path}/in/{k}")
    return spark.readStream.schema("ts timestamp_ntz, v double, s string").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")


def plain(rows):
    out = {}
    for t, v, s in rows:
        if t is None:
            continue
        for c, x in (("v", None if v is None or v != v else v), ("s", s)):
            out.setdefault((t.date(), c), []).append(x)
    held = {k: [x for x in xs if x is not None] for k, xs in out.items()}
    return {k: (len(xs), len(xs) - len(held[k]), len(set(held[k])), round(sum(held[k]) / len(held[k]), 6) if k[1] == "v" and held[k] else None) for k, xs in out.items()}


def got(df):
    return {(r.window_start.date(), r.column): (r.rows, r.nulls, r.distinct_values, None if r["mean"] is None else round(r["mean"], 6)) for r in df.collect()}


BATCHES = [
    [(at(0), 1.0, "a"), (at(0, 2), 2.0, None), (at(1), None, "b"), (None, 9.0, "never")],
    [(at(0, 5), 1.0, "a"), (at(1, 3), float("nan"), "c"), (at(2), -0.0, ""), (at(2, 1), 0.0, "")],
    [(at(1, 9), 4.0, "b"), (at(2, 2), 7.5, "z")],
]


def test_batches_of_a_stream_add_up(spark, tmp_path):
    stream = arriving(spark, tmp_path, BATCHES)
    emitted = ST.run_profile(ST.profile_stream(stream, "ts", ["v", "s"], late="10 days"), f"{tmp_path}/out")
    assert got(ST.merged(emitted)) == plain([r for b in BATCHES for r in b])
    assert emitted.where("NOT closed").select("part").distinct().count() > 1


def test_state_starts_from_a_stored_profile(spark, tmp_path):
    before = spark.createDataFrame(BATCHES[0], "ts timestamp_ntz, v double, s string")
    stored = ST.stored_profile(before, "ts", ["v", "s"])
    emitted = ST.run_profile(ST.profile_stream(arriving(spark, tmp_path, BATCHES[1:]), "ts", ["v", "s"], late="10 days", stored=stored), f"{tmp_path}/out")
    known = stored.withColumn("distinct_values", F.size("values").cast("bigint")).drop("values").withColumn("closed", F.lit(False))
    assert got(ST.merged(known.unionByName(emitted))) == plain([r for b in BATCHES for r in b])


def test_windows_close_and_late_rows_stay_out(spark, tmp_path):
    late = [[(at(0), 1.0, "a")], [(at(9), 2.0, "b")], [(at(9, 2), 3.0, "c")], [(at(0, 3), 5.0, "late"), (at(9, 4), 3.0, "c")], [(at(9, 5), 3.0, "c")]]
    emitted = ST.run_profile(ST.profile_stream(arriving(spark, tmp_path, late), "ts", ["v", "s"], late="1 hour"), f"{tmp_path}/out")
    closed = emitted.where("closed").select("window_start").distinct().collect()
    assert [r.window_start.date() for r in closed] == [DAY.date()]
    assert got(ST.merged(emitted)) == plain([r for b in late for r in b if r[2] != "late"])
