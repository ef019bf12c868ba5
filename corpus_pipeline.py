"""A training-data pipeline of five corpus operators.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of documents, with fewer rows.  Ids may be null or
repeat; stages that drop copies then judge rows by their place in a table.  Rows are
dropped by an anti join with the keys that a stage removes: these are few next
to the texts, so up to a checked size they are broadcast and no text is
shuffled.

Every stage takes documents with any further columns and hands them on; a
column row_key, held_out, lang_pred, score or one that decontaminate adds is an
error.  Null texts are no language and go in the first stage; an empty table
gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.llm.common import BROADCAST_ROWS, NO_ID, shared_folder, stash, table
from quernstone.llm.decontaminate import decontaminate
from quernstone.llm.exact_dedup import exact_dedup
from quernstone.llm.language_id import identify
from quernstone.llm.ngram_join import ngram_jaccard_join
from quernstone.llm.packing import best_fit_pack, tokenizer_path


def _keyed(docs: DataFrame) -> DataFrame:
    """docs with row_key, a bigint of its own for each row: the id if none is null or repeats, else the row's place in a table that is written for it."""
    if "row_key" in docs.columns:
        raise ValueError("column row_key is taken")
    odd = docs.where("doc_id IS NULL").take(1) or docs.groupBy("doc_id").count().where("count > 1").take(1)
    return stash(docs.withColumn("row_key", F.monotonically_increasing_id())) if odd else docs.withColumn("row_key", F.col("doc_id").cast("bigint"))


def _few(keys: DataFrame) -> DataFrame:
    return F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys


def _firsts(keyed: DataFrame, moved: DataFrame, *order: Column) -> DataFrame:
    """keyed without all rows of a group but the first by order, then id (null comes last).

    moved: row_key and group of the rows whose group is the key of another row.
    """
    moved = stash(moved.distinct())
    members = stash(moved.unionByName(moved.select(F.col("group").alias("row_key"), "group").distinct()))
    place = F.struct(*order, F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)), "row_key")
    members = stash(keyed.select("row_key", place.alias("place")).join(_few(members), "row_key"))
    first = stash(members.groupBy("group").agg(F.min("place")["row_key"].alias("first")))
    removed = stash(members.join(_few(first), "group").where("row_key <> first").select("row_key").distinct())
    return keyed.join(_few(removed), "row_key", "left_anti")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no language (no text, or no letter in it) go."""
    return identify(docs).where("lang_pred <> 'und'").select(*docs.columns)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The longest of equal texts stays, then the one with the smallest id."""
    keyed = _keyed(docs)
    verdict = stash(exact_dedup(keyed.select("row_key", "text"), "row_key"))
    moved = verdict.where("NOT kept").select(F.col("doc_id").alias("row_key"), F.col("keep_id").alias("group"))
    return _firsts(keyed, moved, -F.coalesce(F.length("text"), F.lit(0))).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by five-word shingles at 0.8 the smallest id stays."""
    keyed = _keyed(docs)
    groups = ngram_jaccard_join(keyed.select("row_key", "text"), shingle=5, percent=80, id_col="row_key")
    moved = groups.where("doc_id <> component_id").select(F.col("doc_id").alias("row_key"), F.col("component_id").alias("group"))
    return _firsts(keyed, moved).select(*docs.columns)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark")).where("NOT contaminated").select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 1024 tokens."""
    return best_fit_pack(docs.select("doc_id", "text"), tokenizer_path())


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_copies),
    ("ngram_join", near_copies),
    ("decontaminate", benchmark_free),
    ("best_fit_packing", packed),
]

#: Language ID and packing are not expressible in SQL; tests/llm compares run() with a plain version of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = table(spark, sf_dir, "documents"), shared_folder(spark)
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        docs = out if k == len(STAGES) - 1 else stash(out, f"{folder}/{k}")
    return docs
