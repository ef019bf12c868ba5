import pytest
from pyspark.sql import functions as F

from quernstone.config import BARE, SHIPPED
from quernstone.operators import roles as R
from quernstone.operators import stats as S
from quernstone.plans import queries
from quernstone.plans.profile import profile_catalog
from quernstone.sources.catalog import Catalog, Constraint, Table


def by_column(df):
    return {r["column"]: r for r in df.collect()}


def test_nan_is_null_and_zero_has_no_sign(spark):
    df = spark.createDataFrame([(float("nan"),), (0.0,), (-0.0,), (None,)], "x double")
    p = by_column(S.profile(df, exact="all"))["x"]
    assert (p.sample_count, p.null_count, p.unique_count) == (4, 2, 1)


def test_several_columns_count_null_as_a_value(spark):
    df = spark.createDataFrame([(1, None), (1, 2), (None, 2), (1, 2)], "a int, b int")
    assert S.uniqueness(df, ["a", "b"]).first().distinct == 3
    assert S.uniqueness(df, ["a"]).first().distinct == 1
    assert S.null_rate(df, ["a", "b"]).first().null_rate == 0.5


def test_empty_table(spark):
    p = by_column(S.profile(spark.createDataFrame([], "a int, s string"), exact="all"))
    assert (p["a"].sample_count, p["a"].null_rate, p["s"].avg_length) == (0, 0.0, None)


def test_lengths_of_one_value(spark):
    p = by_column(S.profile(spark.createDataFrame([("abc",)], "s string"), exact="all"))["s"]
    assert (p.avg_length, p.length_std, p.median_length, p.value_distribution) == (3.0, 0.0, 3.0, {"abc": 1})


def test_complex_values_are_compared_in_canonical_form(spark):
    df = spark.sql("SELECT map('a', 1, 'b', 2) AS m, array(1, 2) AS l UNION ALL SELECT map('b', 2, 'a', 1), array(2, 1) UNION ALL SELECT NULL, NULL")
    p = by_column(S.profile(df, exact="all"))
    assert p["m"].unique_count == 1 and p["l"].unique_count == 2 and p["m"].null_count == 1


def test_needed_mode_agrees_where_it_decides(spark):
    df = spark.range(5000).select(F.col("id"), (F.col("id") % 2).alias("two"), (F.col("id") % 1000).alias("many"))
    p = by_column(S.profile(df))
    assert p["id"].unique_count == 5000 and p["two"].unique_count == 2 and abs(p["many"].unique_count - 1000) < 100
    assert p["two"].value_distribution == {"0": 2500, "1": 2500}


def test_profile_is_one_scan_in_the_first_pass(spark):
    df = spark.range(10).select("id", F.col("id").cast("string").alias("s"))
    one = df.agg(*[S._moments(df, c) for c in df.columns])
    assert one._jdf.queryExecution().executedPlan().toString().count("Range (") == 1


FLAGS = dict.fromkeys(R.FLAGS, False)
BASE = {"schema": "s", "table": "t", "ordinal": 1, "char_length": None, "scale": None, "sample_count": 100, "null_count": 0, "null_rate": 0.0, "unique_count": 50, "uniqueness": 0.5, "avg_length": None, "min_length": None, "max_length": None, "length_std": None, "least_count": None, "longest_value": None}


def role_of(spark, config=BARE, **values):
    row = BASE | FLAGS | values
    schema = "schema string, table string, ordinal int, char_length int, scale int, sample_count bigint, null_count bigint, null_rate double, unique_count bigint, uniqueness double, avg_length double, min_length bigint, max_length bigint, length_std double, least_count bigint, longest_value bigint, " + ", ".join(f"{f} boolean" for f in R.FLAGS) + ", column string, data_type string"
    df = spark.createDataFrame([tuple(row[n.split()[0]] for n in schema.split(", "))], schema)
    return df.select(R.role(config).alias("r")).first().r


@pytest.mark.parametrize(
    ("values", "role", "confidence"),
    [
        ({"column": "tags", "data_type": "text[]"}, "complex", 0.95),
        ({"column": "ref", "data_type": "uuid"}, "complex", 0.95),
        ({"column": "count_date", "data_type": "date"}, "audit", 0.95),
        ({"column": "ts", "data_type": "timestamp"}, "datetime", 1.0),
        ({"column": "ts", "data_type": "timestamp without time zone"}, "attribute", 0.7),
        ({"column": "birth_day", "data_type": "text"}, "datetime", 0.85),
        ({"column": "o_orderkey", "data_type": "bigint", "uniqueness": 1.0, "unique_count": 100}, "identifier", 0.95),
        ({"column": "l_linenumber", "data_type": "integer", "uniqueness": 0.01, "unique_count": 7}, "identifier", 0.75),
        ({"column": "store_id", "data_type": "integer"}, "identifier", 0.85),
        ({"column": "x", "data_type": "integer", "is_primary_key": True}, "identifier", 1.0),
        ({"column": "x", "data_type": "numeric", "scale": 2, "is_primary_key": True}, "metric", 0.7),
        ({"column": "price", "data_type": "integer", "uniqueness": 1.0, "unique_count": 100}, "metric", 0.95),
        ({"column": "l_discount", "data_type": "double precision"}, "metric", 0.95),
        ({"column": "text", "data_type": "text"}, "description", 0.85),
        ({"column": "body", "data_type": "text", "uniqueness": 0.9, "avg_length": 80.0, "length_std": 30.0, "min_length": 1, "max_length": 200}, "description", 0.85),
        ({"column": "flag", "data_type": "text", "unique_count": 2, "least_count": 2, "longest_value": 1}, "enum", 0.85),
        ({"column": "flag", "data_type": "text", "unique_count": 2, "least_count": 1, "longest_value": 1}, "attribute", 0.7),
        ({"column": "flag_name", "data_type": "text", "unique_count": 2, "least_count": 2, "longest_value": 1}, "attribute", 0.7),
        ({"column": "total", "data_type": "text"}, "metric", 0.6),
        ({"column": "colour", "data_type": "text"}, "attribute", 0.7),
    ],
)
def test_roles(spark, values, role, confidence):
    r = role_of(spark, **values)
    assert (r.role, r.confidence) == (role, confidence)


def test_presets_differ_in_complex_types(spark):
    assert role_of(spark, SHIPPED, column="ref", data_type="uuid").role == "identifier"


def test_star_schema(spark):
    sales = spark.createDataFrame([(1, "a", 1.5), (1, "b", 2.5), (2, "a", 3.5), (2, "b", 4.0)], "store_id int, date_day string, amount double")
    stores = spark.createDataFrame([(1, "x"), (2, "y")], "store_id int, title string")
    c = Catalog(spark, [
        Table("fact_sales", sales, constraints=[Constraint("pk", ("store_id", "date_day")), Constraint("fk", ("store_id",), "fk", ("public", "dim_store", ("store_id",)))]),
        Table("dim_store", stores, constraints=[Constraint("pk", ("store_id",))]),
    ])
    p = profile_catalog(c)
    rows = {(r.table, r.column): r for r in p.columns.collect()}
    key = rows["fact_sales", "store_id"]
    assert (key.role, key.is_foreign_key, key.is_composite_primary_key_member, key.is_surrogate) == ("identifier", True, True, False)
    assert rows["fact_sales", "amount"].role == "metric" and rows["fact_sales", "amount"].metric_category == "amount"
    cats = {r.table: r.category for r in p.tables.collect()}
    assert cats == {"fact_sales": "fact", "dim_store": "dim"}


def test_bridge_and_overrides(spark):
    counts = spark.createDataFrame([("s", "link", 2, 2, 0, 0, 2, None, True)], "schema string, table string, total_columns bigint, identifier_count bigint, metric_count bigint, datetime_count bigint, foreign_key_count bigint, comment string, has_key boolean")
    got = R.table_category(counts)
    assert got.first().category == "bridge"
    over = R.override_category(got, spark.createDataFrame([("s", "link", " DIM ", 1.7)], "schema string, table string, category string, confidence double")).first()
    assert (over.category, over.confidence, over.category_rule_based) == ("dim", 1.0, "bridge")


def test_failed_tables_have_one_status(spark):
    bad = spark.createDataFrame([("x",)], "a string").select(F.raise_error(F.lit("boom")).alias("a"))
    p = profile_catalog(Catalog(spark, [Table("bad", bad), Table("good", spark.range(3).toDF("id"))]))
    assert list(p.failed) == ["public.bad"] and [r.table for r in p.tables.collect()] == ["good"]


def test_queries_fail_with_a_failed_table(spark, monkeypatch):
    bad = spark.createDataFrame([("x",)], "a string").select(F.raise_error(F.lit("boom")).alias("a"))
    monkeypatch.setattr(queries, "star_catalog", lambda *_: Catalog(spark, [Table("bad", bad), Table("good", spark.range(3).toDF("id"))]))
    for query in (queries.column_roles, queries.table_categories, queries.logical_keys):
        with pytest.raises(RuntimeError, match="public.bad"):
            query(spark, "")
