"""Exact deduplication with stateful streaming (operator 3), DataFrame operations only.

A first pass turns the documents into small records: digest of the normalised
text, identifier, code points and a content locator (file, row and column).  Structured
Streaming reads the records into an aggregation keyed by digest whose state
lives in RocksDB on the executors' disks, is checkpointed to shared storage and
never expires: no watermark, and a later call with the same folder goes on from
it, so a copy that arrives years later still meets its keeper.  Every
micro-batch hands its changed keys on, in a folder named by the batch, so a
batch that runs twice replaces itself.  At the end every hit is checked on full
bytes against the text that its keeper's locator names; where digests agree but
bytes do not, rows are grouped anew by their texts.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, NO_ID, shared_folder, stash, table

SPACES = " \t\n\x0b\f\r"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), SPACES, "")


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def _file_column(docs: DataFrame, text_col: str) -> str | None:
    """The column of Parquet files that text_col is, where docs is a bare scan: rows of files one by one, their text as it stands there."""
    plan = docs._jdf.queryExecution().analyzed()
    listed = lambda seq: [seq.apply(i) for i in range(seq.size())]
    kind = lambda node: node.getClass().getSimpleName()
    text = [a for a in listed(plan.output()) if a.name() == text_col]
    while kind(plan) in ("Project", "SubqueryAlias"):
        plan = plan.children().apply(0)
    if len(text) != 1 or kind(plan) != "LogicalRelation" or kind(plan.relation()) != "HadoopFsRelation" or "Parquet" not in plan.relation().fileFormat().toString():
        return None
    stored = set(plan.relation().dataSchema().fieldNames())
    return next((a.name() for a in listed(plan.output()) if a.exprId().equals(text[0].exprId()) and a.name() in stored and a.dataType().simpleString() == "string"), None)


def _locator(column: str) -> Column:
    return F.concat_ws("#", "_metadata.file_path", F.col("_metadata.row_index").cast("string"), F.lit(column))


def _located(docs: DataFrame, id_col: str, text_col: str, folder: str) -> DataFrame:
    """(id, text, locator) of docs.  A locator names a file, a row and a column; documents that are no rows of Parquet files are written to the folder first."""
    if "_metadata" in docs.columns:
        raise ValueError("column _metadata is taken")
    kept = docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(NO_ID)).alias("id"), F.col(text_col).cast("string").alias("text"))
    column = _file_column(docs, text_col)
    if column is None:
        return stash(kept, f"{folder}/content-{uuid.uuid4().hex}").select("id", "text", _locator("text").alias("locator"))
    return docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(NO_ID)).alias("id"), F.col(text_col).alias("text"), _locator(column).alias("locator"))


def keeper_state(spark: SparkSession, folder: str, max_files: int = 64) -> DataFrame:
    """Streams new records through the folder's keyed state: digest, keeper (points, id, locator), n."""
    records = spark.read.parquet(f"{folder}/records/*")
    source = spark.readStream.schema(records.schema).option("maxFilesPerTrigger", max_files).parquet(f"{folder}/records/*")
    state = source.groupBy("digest").agg(F.min(F.struct((-F.col("points")).alias("less"), "id", "locator")).alias("keeper"), F.count("*").alias("n"))

    def changed(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/changed/batch={number}")

    # Without allowFAllocate=false each state partition reserves 4 MB of disk for its manifest.
    rocksdb = "spark.sql.streaming.stateStore.rocksdb"
    settings = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB, f"{rocksdb}.boundedMemoryUsage": "true", f"{rocksdb}.maxMemoryUsageMB": "128", f"{rocksdb}.allowFAllocate": "false"}
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        query = state.writeStream.outputMode("update").foreachBatch(changed).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return _keepers(spark, folder, state.schema)


def _keepers(spark: SparkSession, folder: str, schema) -> DataFrame:
    """Within a key the keeper only falls and the count only grows from batch to batch."""
    every = spark.read.schema(schema).parquet(f"{folder}/changed/*") if _exists(spark, f"{folder}/changed") else spark.createDataFrame([], schema)
    return every.groupBy("digest").agg(F.min("keeper").alias("keeper"), F.max("n").alias("n"))


def _contents(own: DataFrame, wanted: DataFrame, resumed: bool) -> DataFrame:
    """(locator, bytes) of the wanted locators (distinct, stashed): of this call's documents, and of files that earlier calls read."""
    spark, few = own.sparkSession, F.broadcast(wanted) if wanted.count() <= BROADCAST_ROWS // 8 else wanted
    found = own.join(few, "locator", "left_semi").select("locator", normalised(F.col("text")).alias("bytes"))
    if not resumed:
        return found
    place = lambda df: df.select(F.substring_index("locator", "#", 1).alias("file"), F.substring_index("locator", "#", -1).alias("column")).distinct()
    files = {}
    for r in place(wanted).join(place(own), ["file", "column"], "left_anti").collect():
        files.setdefault(r.column, []).append(r.file)
    for column, some in files.items():
        older = spark.read.parquet(*some).select(_locator(column).alias("locator"), normalised(F.col(f"`{column}`").cast("string")).alias("bytes"))
        found = found.unionByName(older.join(few, "locator", "left_semi"))
    return found


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest=lambda t: F.sha2(t, 256), folder: str | None = None, max_files: int = 64) -> DataFrame:
    """One row per document that has arrived so far: id, keep_id, group_size, kept, text_digest.

    Texts are equal if they are identical without space, tab, LF, VT, FF and
    CR; null is empty, and empty texts are one group.  Of equal texts the one
    with the most code points stays, then the smallest id; a null id comes
    last and is returned as null.  Rows that repeat an id with the same text
    are one group; the id stays, so each of them is kept.  No documents make
    no rows; other columns of docs are not looked at, but a column _metadata
    is an error.

    Where docs is a plain scan of Parquet files, locators name those; any other
    DataFrame (of a join, of exploded rows, with a derived text) is written to
    the folder first.

    folder keeps the state: a call with a folder of earlier calls adds its
    documents to theirs, and returns the verdicts on all.  The files of earlier
    documents must still be there, as hits are checked on them.
    """
    spark = docs.sparkSession
    folder = folder or shared_folder(spark)
    resumed = _exists(spark, f"{folder}/records")
    own = _located(docs, id_col, text_col, folder)
    before = stash(_keepers(spark, folder, _STATE).select("digest", F.col("keeper.locator").alias("old")), f"{folder}/before-{uuid.uuid4().hex}") if resumed else None
    records = own.select("id", F.coalesce(F.length("text"), F.lit(0)).alias("points"), digest(normalised(F.col("text"))).alias("digest"), "locator")
    records = stash(records, f"{folder}/records/{uuid.uuid4().hex}")
    state = stash(keeper_state(spark, folder, max_files), f"{folder}/keepers-{uuid.uuid4().hex}")
    groups = state.select("digest", F.col("keeper.id").alias("keep_id"), F.col("n").alias("group_size"), F.col("keeper.locator").alias("keeper"))
    everything = spark.read.schema(records.schema).parquet(f"{folder}/records/*")
    out = everything.join(groups.drop("keeper"), "digest").select("id", "keep_id", "group_size", "digest")

    # Full bytes are compared on hits only: new members of groups of two or more, and keepers that have been replaced.
    hits = stash(groups.where("group_size > 1").select("digest", "keeper"), f"{folder}/hits-{uuid.uuid4().hex}")
    few = F.broadcast(hits) if hits.count() <= BROADCAST_ROWS // 8 else hits
    members = own.select("locator", digest(normalised(F.col("text"))).alias("digest"), normalised(F.col("text")).alias("bytes")).join(few, "digest").where("locator <> keeper")
    wanted = hits.select(F.col("keeper").alias("locator"))
    if resumed:
        replaced = stash(before.join(hits, "digest").where("old <> keeper").select("digest", "keeper", F.col("old").alias("locator")), f"{folder}/replaced-{uuid.uuid4().hex}")
        texts = _contents(own, stash(replaced.select("locator").distinct()), True)
        members = members.select("locator", "digest", "bytes", "keeper").unionByName(texts.join(replaced, "locator").select("locator", "digest", "bytes", "keeper"))
    keepers = _contents(own, stash(wanted.distinct()), resumed).select(F.col("locator").alias("keeper"), F.col("bytes").alias("keeper_bytes"))
    keepers = keepers.join(few, "keeper").select("digest", "keeper_bytes")
    # Made distinct only when read again, so that Spark may split a large group in the join.
    members.join(keepers, "digest").where("bytes <> keeper_bytes").select("digest").write.parquet(f"{folder}/false/{uuid.uuid4().hex}")
    split = stash(spark.read.schema("digest string").parquet(f"{folder}/false/*").distinct())
    if split.take(1):
        out = _regroup(own, everything, out, split, resumed)
    return out.select(F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id"), F.when(F.col("keep_id") != NO_ID, F.col("keep_id")).alias("keep_id"), F.col("group_size").cast("bigint").alias("group_size"), (F.col("id") == F.col("keep_id")).alias("kept"), F.col("digest").alias("text_digest"))


_STATE = "digest string, keeper struct<less: int, id: bigint, locator: string>, n bigint"


def _regroup(own: DataFrame, everything: DataFrame, out: DataFrame, split: DataFrame, resumed: bool) -> DataFrame:
    """Digests under which different texts met: their documents are grouped by the texts themselves."""
    again = stash(everything.join(split, "digest", "left_semi"))
    again = again.join(_contents(own, stash(again.select("locator")), resumed), "locator")
    best = again.groupBy("digest", "bytes").agg(F.min(F.struct((-F.col("points")).alias("less"), "id")).alias("keeper"), F.count("*").alias("n"))
    fixed = again.join(best, ["digest", "bytes"]).select("id", F.col("keeper.id").alias("keep_id"), F.col("n").alias("group_size"), "digest")
    return out.join(split, "digest", "left_anti").select("id", "keep_id", "group_size", "digest").unionByName(fixed)


def op3_exact_dedup(spark, sf_dir: str) -> DataFrame:
    out = exact_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "keep_id", "group_size", "kept", F.col("text_digest").alias("text_sha256"))
