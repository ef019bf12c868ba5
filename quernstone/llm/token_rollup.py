"""Token counts as delta-maintained rollups (operator 10).

A rollup is a folder of signed deltas, one subfolder per committed batch, and a
manifest that names those that count.  Totals are additive: they are the sums
of all deltas.  Inserts add, deletes subtract, a revision takes the old count
from the old key and adds the new one to the new key.  A commit writes a new
subfolder and then renames a new manifest over the old one, so readers see
either all of it or nothing, and a batch that is delivered again replaces
itself in one step.  compact() folds committed batches into one subfolder.
"""

from __future__ import annotations

import json
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shared_folder, stash, table
from .packing import tokenizer_path
from .textscan import released
from .tokens import encoded

KEYS = ["source", "lang", "tokenizer"]
DELTA = "source string, lang string, tokenizer string, docs bigint, tokens bigint"


def token_counts(docs: DataFrame, tokenizer: str, text_col: str = "text") -> DataFrame:
    """docs without their text and with n_tokens; null is the empty text."""
    if "n_tokens" in docs.columns:
        raise ValueError("column n_tokens is taken")
    kept = [c for c in docs.columns if c != text_col]
    source = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text_col}`").cast("string").alias(text_col))

    def run(batches):
        for batch in batches:
            n = np.zeros(batch.num_rows, np.int64)
            for row, _, at in encoded(batch.column(len(kept)), tokenizer):
                n[row : row + len(at) - 1] = np.diff(at)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(n)], names=[*kept, "n_tokens"])

    schema = source.select(*[F.col(f"`{c}`") for c in kept], F.lit(0).cast("bigint").alias("n_tokens")).schema
    return source.mapInArrow(released(run), schema)


class TokenRollup:
    """Additive totals by source, language and tokenizer version, kept in `folder`.  One writer at a time."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._fs = spark._jvm.org.apache.hadoop.fs
        top = self._fs.Path(folder)
        self._files = self._fs.FileContext.getFileContext(top.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(top).toUri(), spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._fs.Path(f"{self.folder}/{name}")

    def manifest(self) -> dict:
        """version; batches: folder of each open batch; folded: ids of compacted ones; base: their folder, or null; digests of what batches held; gone: folders that the last version still named."""
        if not self._files.util().exists(self._path("manifest")):
            return {"version": 0, "batches": {}, "folded": [], "base": None, "digests": {}, "gone": []}
        return json.loads(self.spark.read.text(f"{self.folder}/manifest", wholetext=True).first()[0])

    def _switch(self, manifest: dict) -> None:
        """Puts a manifest in the place of the version it was made from by one rename.

        Folders that it no longer names stay for readers of the old manifest
        and are deleted at the next switch.  Another version in its place, from
        a second writer, is an error.
        """
        old = self.manifest()
        if old["version"] != manifest["version"]:
            raise RuntimeError(f"the rollup was at version {manifest['version']} and another writer made it {old['version']}")
        kept = {*manifest["batches"].values(), manifest["base"]}
        gone = sorted({*old["batches"].values(), old["base"]} - kept - {None})
        manifest = manifest | {"version": old["version"] + 1, "gone": gone}
        jvm, name = self.spark._jvm, f"manifest-{uuid.uuid4().hex}"
        out = self._path(name).getFileSystem(self.spark._jsc.hadoopConfiguration()).create(self._path(name))
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        self._files.rename(self._path(name), self._path("manifest"), options)
        for folder in old["gone"]:
            self._files.delete(self._path(folder), True)

    def commit(self, batch: str, changes: DataFrame) -> None:
        """Applies a batch of changes; a batch id that was committed before is replaced, not added.

        changes: op (insert, delete, revise), source, lang, tokenizer, n_tokens,
        and for a revision old_source, old_lang, old_tokenizer, old_n_tokens.
        Null keys are a group of their own, null counts are 0.  Any other op
        fails the commit and leaves the rollup as it was.  A batch that was
        compacted is closed: delivered again as it was, it is left out, and
        with other sums it is an error.
        """
        if not batch or set(batch) - set("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._-"):
            raise ValueError(f"not a batch id: {batch!r}")
        manifest = self.manifest()
        for c, kind in (("old_source", "string"), ("old_lang", "string"), ("old_tokenizer", "string"), ("old_n_tokens", "bigint")):
            if c not in changes.columns:
                changes = changes.withColumn(c, F.lit(None).cast(kind))

        def signed(sign: int, prefix: str = ""):
            n = F.coalesce(F.col(f"{prefix}n_tokens").cast("bigint"), F.lit(0))
            return F.struct(*[F.col(prefix + k).cast("string").alias(k) for k in KEYS], F.lit(sign).cast("bigint").alias("docs"), (sign * n).alias("tokens"))

        wrong = F.raise_error(F.concat(F.lit("not a kind of change: "), F.coalesce("op", F.lit("null"))))
        deltas = F.when(F.col("op") == "insert", F.array(signed(1))).when(F.col("op") == "delete", F.array(signed(-1))).when(F.col("op") == "revise", F.array(signed(-1, "old_"), signed(1))).otherwise(wrong)
        sums = changes.select(F.inline(deltas)).groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        folder = f"deltas-{uuid.uuid4().hex}"
        sums.write.parquet(f"{self.folder}/{folder}")
        # What the batch comes to, whatever the order of its rows.
        stored = self.spark.read.schema(DELTA).parquet(f"{self.folder}/{folder}")
        digest = str(stored.agg(F.sum(F.xxhash64(*stored.columns).cast("decimal(38,0)"))).first()[0])
        if batch in manifest["folded"]:
            self._files.delete(self._path(folder), True)
            if digest != manifest["digests"][batch]:
                raise ValueError(f"batch {batch!r} was compacted and now holds something else; commit the difference as a batch of its own")
            return
        manifest["batches"][batch], manifest["digests"][batch] = folder, digest
        self._switch(manifest)

    def compact(self) -> None:
        """Folds all committed batches into one folder, so that reading totals does not grow with their number."""
        manifest, folder = self.manifest(), f"base-{uuid.uuid4().hex}"
        if manifest["batches"]:
            self.totals().write.parquet(f"{self.folder}/{folder}")
            manifest |= {"batches": {}, "folded": sorted({*manifest["folded"], *manifest["batches"]}), "base": folder}
        if manifest["base"] == folder or manifest["gone"]:
            self._switch(manifest)

    def totals(self) -> DataFrame:
        """docs and tokens of each key that still has documents; no rows before the first commit."""
        manifest = self.manifest()
        folders = [f"{self.folder}/{x}" for x in (manifest["base"], *manifest["batches"].values()) if x]
        all_ = self.spark.read.schema(DELTA).parquet(*folders) if folders else self.spark.createDataFrame([], DELTA)
        return all_.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).where("docs <> 0 OR tokens <> 0")


def op10_token_rollup(spark, sf_dir: str) -> DataFrame:
    """Totals of all documents, reached through inserts, deletes and revisions over thirds of them.

    All documents are inserted, one third of them under a first version that
    counts bytes; another third is deleted; the first is revised to the
    tokenizer's counts, a batch that is delivered twice; the deleted third is
    inserted again.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", F.coalesce(F.octet_length(F.col("text").cast("string")), F.lit(0)).cast("bigint").alias("n_bytes"), "text")
    counts = stash(token_counts(docs, tokenizer_path()).withColumn("third", F.pmod(F.xxhash64("doc_id"), F.lit(3))))
    now = counts.withColumn("tokenizer", F.lit("byte_bpe_50k"))
    first = now.withColumns({"tokenizer": F.lit("bytes"), "n_tokens": F.col("n_bytes")})
    op = lambda df, name: df.withColumn("op", F.lit(name))
    revised = now.withColumns({"old_source": F.col("source"), "old_lang": F.col("lang"), "old_tokenizer": F.lit("bytes"), "old_n_tokens": F.col("n_bytes")}).where("third = 2")

    rollup = TokenRollup(spark, shared_folder(spark))
    rollup.commit("inserted", op(now.where("third IS NULL OR third < 2").unionByName(first.where("third = 2")), "insert"))
    rollup.commit("deleted", op(now.where("third = 1"), "delete"))
    for _ in range(2):
        rollup.commit("revised", op(revised, "revise"))
    rollup.compact()
    rollup.commit("inserted-again", op(now.where("third = 1"), "insert"))
    return rollup.totals()
