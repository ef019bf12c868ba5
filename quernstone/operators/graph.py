"""Graph view of a catalog: table and column nodes, has-column and join edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Names that stand for a table in metadata that is still to be filled in.
PLACEHOLDERS = ("table_name", "placeholder", "example")


def real_tables(df: DataFrame) -> DataFrame:
    """Rows whose `table` is a name: not null, not empty and no placeholder."""
    return df.where((F.length("table") > 0) & ~F.col("table").isin(*PLACEHOLDERS))


def join_text(source_columns: Column, target_columns: Column) -> Column:
    """SRC.a = DST.b AND ..."""
    pairs = F.arrays_zip(source_columns.alias("a"), target_columns.alias("b"))
    return F.array_join(F.transform(pairs, lambda p: F.concat(F.lit("SRC."), p["a"], F.lit(" = DST."), p["b"])), " AND ")


def one_database(tables: DataFrame) -> DataFrame:
    """tables, or an error at run time if they are of several databases."""
    low, high = F.min("database").over(Window.partitionBy()), F.max("database").over(Window.partitionBy())
    checked = tables.withColumns({"_low": low, "_high": high})
    return checked.withColumn("database", F.when(F.col("_low") == F.col("_high"), F.col("database")).otherwise(F.raise_error(F.lit("tables are of several databases")))).drop("_low", "_high")


def table_nodes(tables: DataFrame, constraints: DataFrame, keys: DataFrame, domains: DataFrame | None = None, least_key: float = 0.8) -> DataFrame:
    """Nodes with keys as arrays of arrays; logical keys count from a confidence of least_key on."""
    real = real_tables(tables)
    of = lambda kind, name: constraints.where(F.col("kind") == kind).groupBy("schema", "table").agg(F.array_sort(F.collect_list("columns")).alias(name))
    out = real.select(F.concat_ws(".", "schema", "table").alias("id"), "*")
    for kind, name in (("pk", "pk"), ("uk", "uk"), ("fk", "fk"), ("index", "indexes")):
        out = out.join(F.broadcast(of(kind, name)), ["schema", "table"], "left")
    logical = keys.where(F.col("confidence") >= least_key).groupBy("schema", "table").agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("confidence")).alias("c"), "columns"))), lambda k: k["columns"]).alias("logic_pk"))
    out = out.join(F.broadcast(logical), ["schema", "table"], "left")
    if domains is not None:
        own = domains.groupBy("schema", "table").agg(F.array_sort(F.collect_set("domain")).alias("domains"))
        out = out.join(F.broadcast(own), ["schema", "table"], "left")
    else:
        out = out.withColumn("domains", F.lit(None).cast("array<string>"))
    none = F.array().cast("array<array<string>>")
    return out.withColumns({n: F.coalesce(n, none) for n in ("pk", "uk", "fk", "indexes", "logic_pk")}).withColumn("domains", F.coalesce("domains", F.array().cast("array<string>")))


def column_nodes(roles: DataFrame) -> DataFrame:
    """One node for each column, with its role and memberships."""
    flag = lambda n: (F.col(f"is_{n}") | F.col(f"is_composite_{n}_member"))
    return real_tables(roles).select(
        F.concat_ws(".", "schema", "table", "column").alias("id"), F.concat_ws(".", "schema", "table").alias("table_id"), "schema", "table", "column", "data_type", "comment", "role",
        flag("primary_key").alias("is_pk"), flag("unique_constraint").alias("is_uk"), flag("foreign_key").alias("is_fk"), (F.col("role") == "datetime").alias("is_time"),
        (F.col("role") == "metric").alias("is_measure"), F.round("uniqueness", 4).alias("uniqueness"), F.round("null_rate", 4).alias("null_rate"),
    )


def has_column_edges(columns: DataFrame) -> DataFrame:
    return columns.select(F.col("table_id").alias("src"), F.col("id").alias("dst"))


def flipped(relations: DataFrame) -> DataFrame:
    """relations (source, target, both columns, cardinality) with edges towards the one side: 1:N turns into N:1."""
    turn = F.col("cardinality") == "1:N"
    pick = lambda a, b: F.when(turn, F.col(b)).otherwise(F.col(a))
    return relations.withColumns(
        {"source": pick("source", "target"), "target": pick("target", "source"), "source_columns": pick("source_columns", "target_columns"), "target_columns": pick("target_columns", "source_columns"), "cardinality": F.when(turn, "N:1").otherwise(F.col("cardinality"))}
    )


def join_edges(relations: DataFrame, single: bool = False) -> DataFrame:
    """JOIN_ON edges; single keeps one edge for each ordered pair of tables, the last written."""
    f = flipped(relations)
    edges = f.select(F.col("source").alias("src"), F.col("target").alias("dst"), "cardinality", F.lit("INNER JOIN").alias("join_type"), join_text(F.col("source_columns"), F.col("target_columns")).alias("on"), "source_columns", "target_columns", "relationship_id")
    if single:
        last = Window.partitionBy("src", "dst").orderBy(F.desc("relationship_id"))
        edges = edges.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n")
    return edges


def graph_statistics(tables: DataFrame, columns: DataFrame, edges: DataFrame) -> DataFrame:
    kind = lambda df, name: df.select(F.lit(name).alias("kind"))
    return kind(tables, "table").unionAll(kind(columns, "column")).unionAll(kind(has_column_edges(columns), "has_column")).unionAll(kind(edges, "join_on")).groupBy("kind").count()


def nested_arrays(text: Column) -> Column:
    """A JSON text of a list of lists (or of one list) as array<array<string>>; anything else is empty."""
    lists, one = F.from_json(text, "array<array<string>>"), F.from_json(text, "array<string>")
    return F.when(F.trim(text).rlike(r"^\[\s*\["), lists).when(F.trim(text).rlike(r"^\[\s*\""), F.array(one)).otherwise(F.array().cast("array<array<string>>"))


def best_keys(pk: Column, logic_pk: Column) -> Column:
    """The primary key's columns, else the first logical key's."""
    return F.when(F.size(pk) > 0, F.element_at(pk, 1)).when(F.size(logic_pk) > 0, F.element_at(logic_pk, 1)).otherwise(F.array().cast("array<string>"))
