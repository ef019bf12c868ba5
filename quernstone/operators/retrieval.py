"""Objects to search in, and the vectors most like one vector; operators/vectors.py searches for sets of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .roles import contains_any

TIME_WORDS = ("date", "time", "datetime", "timestamp", "timestamptz", "interval", "year")


def time_hints(columns: DataFrame) -> DataFrame:
    """(schema, table, time_col_hint): columns whose type holds a time word, in order."""
    timed = columns.where(contains_any(F.lower(F.trim("data_type")), TIME_WORDS))
    return timed.groupBy("schema", "table").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "column"))), lambda x: x["column"]), ",").alias("time_col_hint"))


def retrieval_objects(tables: DataFrame, columns: DataFrame, texts: DataFrame) -> DataFrame:
    """One object for each table and one for each column with a comment.

    texts: schema, table, text (the whole Markdown of the table).  Objects
    with blank texts are left out.
    """
    name = F.concat_ws(".", "schema", "table")
    none = F.lit(None).cast("string")
    t = tables.join(F.broadcast(texts), ["schema", "table"]).join(F.broadcast(time_hints(columns)), ["schema", "table"], "left")
    of_tables = t.select(F.lit("table").alias("object_type"), name.alias("object_id"), name.alias("parent_id"), F.trim("text").alias("object_desc"), "time_col_hint", F.col("category").alias("table_category"))
    of_columns = columns.select(F.lit("column").alias("object_type"), F.concat_ws(".", "schema", "table", "column").alias("object_id"), name.alias("parent_id"), F.trim("comment").alias("object_desc"), none.alias("time_col_hint"), none.alias("table_category"))
    return of_tables.unionAll(of_columns).where("object_desc <> ''")


def cosine(a: Column, b: Column) -> Column:
    """0.0 where a vector has no length; null for vectors of different lengths."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(F.size(a) == F.size(b), F.when(norm > 0, dot(a, b) / norm).otherwise(0.0))


def top_k(vectors: DataFrame, query: Sequence[float], k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", where: Column | None = None) -> DataFrame:
    """The k most similar rows to one vector; ties go by id.  The filter comes before the ranking."""
    v = vectors if where is None else vectors.where(where)
    q = F.array(*[F.lit(float(x)) for x in query])
    return v.withColumn("similarity", cosine(F.col(vector_col), q)).where("similarity IS NOT NULL").orderBy(F.desc("similarity"), id_col).limit(k)


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """old without the keys of new, and new."""
    return old.join(new.select(key).distinct(), key, "left_anti").unionByName(new)


def example_id(database: Column, question: Column, sql: Column) -> Column:
    return F.concat(database, F.lit(":"), F.substring(F.sha2(F.concat(question, sql), 256), 1, 8))


def relevant_relations(relations: DataFrame, tables: Sequence[str]) -> DataFrame:
    """Relations that touch one of the tables: by full name, or by the bare name if no full one does."""
    full = relations.where(F.col("source").isin(*tables) | F.col("target").isin(*tables))
    bare = [t.split(".")[-1] for t in tables]
    last = lambda c: F.element_at(F.split(c, r"\."), -1)
    return full if full.take(1) else relations.where(last("source").isin(*bare) | last("target").isin(*bare))
