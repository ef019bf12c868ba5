"""Tables that batches of rows are merged into: graph nodes, edges and vectors.

Rows are in buckets by a hash of their key, each bucket a folder.  A batch
brings its keys' new rows; the buckets that it touches are written anew beside
the old ones, all others stay as they are, and a manifest names the folders
that count.  The manifest is written under a temporary name and renamed, so a
batch is there as a whole or not at all, and readers of the old manifest keep
their folders.  The manifest also names the batches it has taken in: one that
comes again changes nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 64


class Conflict(RuntimeError):
    """Another writer has committed since this one began."""


@dataclass(frozen=True)
class MergedTable:
    """A table at path, with one row for each key."""

    spark: SparkSession
    path: str

    @property
    def _fs(self):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def _version(self) -> int:
        """Manifests are numbered; the last one counts."""
        if not self._fs.exists(self._at("manifests")):
            return 0
        names = [f.getPath().getName() for f in self._fs.listStatus(self._at("manifests"))]
        return max((int(n.removesuffix(".json")) for n in names if n.endswith(".json")), default=0)

    def manifest(self, version: int | None = None) -> dict:
        version = version or self._version()
        if not version:
            raise FileNotFoundError(f"no table at {self.path}")
        text = self.spark.read.option("wholetext", True).text(f"{self.path}/manifests/{version:08d}.json").first().value
        return json.loads(text)

    def _commit(self, manifest: dict, version: int) -> None:
        """Manifest number version, unless someone else has written it: a rename fails where its target is."""
        temporary, final = self._at(f"manifests/_{uuid.uuid4().hex}"), self._at(f"manifests/{version:08d}.json")
        out = self._fs.create(temporary)
        try:
            out.write(bytearray(json.dumps(manifest).encode()))
        finally:
            out.close()
        if self._fs.exists(final) or not self._fs.rename(temporary, final):
            self._fs.delete(temporary, False)
            raise Conflict(f"version {version} of {self.path} is there already")

    def read(self, version: int | None = None) -> DataFrame:
        """All rows, of the last version or of an earlier one that is not cleaned up."""
        m = self.manifest(version)
        schema = T.StructType.fromJson(m["schema"])
        folders = sorted(set(m["buckets"].values()))
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{f}" for f in folders]) if folders else self.spark.createDataFrame([], schema)

    def merge(self, rows: DataFrame, batch: str, deletes: DataFrame | None = None) -> dict:
        """Takes in rows, which replace those of their keys, and leaves out the keys of deletes that rows do not bring.

        Of rows that repeat a key in a batch, one stays: the largest, column by
        column.  A null in a key is a value like any other.  Returns counts:
        rows before and after, buckets touched, and whether the batch was new.
        A batch that was taken in before is not looked at.  With a second
        writer at work, one of the two fails with Conflict and can come again.
        """
        version = self._version()
        m = self.manifest(version)
        if batch in m["batches"]:
            return {"new": False, "before": m["rows"], "after": m["rows"], "touched": 0}
        schema, key = T.StructType.fromJson(m["schema"]), m["key"]
        if deletes is not None and set(deletes.columns) != set(key):
            raise ValueError(f"deletes are rows of {key}")
        bucket = F.pmod(F.xxhash64(*key), F.lit(m["n"])).cast("int")
        rows = rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema])
        stage = f"data/{version + 1:08d}-{uuid.uuid4().hex}"
        # One row for each key, marked by its bucket; deletes bring none.
        rest = [c for c in schema.names if c not in key]
        fresh = rows.groupBy(*key).agg(F.max(F.struct(*rest)).alias("_row")).select(*key, *[F.col("_row")[c].alias(c) for c in rest], F.lit(True).alias("_stays")) if rest else rows.distinct().withColumn("_stays", F.lit(True))
        if deletes is not None:
            gone = deletes.select(*[F.col(f"`{k}`").cast(schema[k].dataType).alias(k) for k in key]).distinct()
            on = [F.col(f"g.{k}").eqNullSafe(F.col(f"f.{k}")) for k in key]
            gone = gone.alias("g").join(fresh.select(*key).alias("f"), on, "left_anti")
            fresh = fresh.unionByName(gone.withColumn("_stays", F.lit(False)), allowMissingColumns=True)
        fresh.withColumn("_bucket", bucket).write.parquet(f"{self.path}/{stage}-batch")
        fresh = self.spark.read.parquet(f"{self.path}/{stage}-batch")
        touched = sorted(r[0] for r in fresh.select("_bucket").distinct().collect())  # n at most
        old = [m["buckets"][str(b)] for b in touched if str(b) in m["buckets"]]
        out = fresh.where("_stays").select(*schema.names, "_bucket")
        if old:
            kept = self.spark.read.schema(schema).parquet(*[f"{self.path}/{f}" for f in old])
            on = [F.col(f"o.{k}").eqNullSafe(F.col(f"f.{k}")) for k in key]
            kept = kept.alias("o").join(fresh.select(*key).alias("f"), on, "left_anti").withColumn("_bucket", bucket)
            out = out.unionByName(kept)
        out.repartition("_bucket").write.partitionBy("_bucket").parquet(f"{self.path}/{stage}")
        sizes = {r[0]: r[1] for r in self.spark.read.schema(T.StructType([*schema, T.StructField("_bucket", T.IntegerType())])).parquet(f"{self.path}/{stage}").groupBy("_bucket").count().collect()}
        buckets = {b: f for b, f in m["buckets"].items() if int(b) not in touched} | {str(b): f"{stage}/_bucket={b}" for b in sizes}
        counts = {b: n for b, n in m["counts"].items() if int(b) not in touched} | {str(b): n for b, n in sizes.items()}
        after = sum(counts.values())
        self._commit(m | {"buckets": buckets, "counts": counts, "rows": after, "batches": [*m["batches"], batch]}, version + 1)
        self._fs.delete(self._at(f"{stage}-batch"), True)
        return {"new": True, "before": m["rows"], "after": after, "touched": len(touched)}

    def clean_up(self, keep: int = 2) -> None:
        """Deletes folders that none of the last `keep` manifests names, and older manifests."""
        last = self._version()
        used = {f.split("/")[1] for v in range(max(1, last - keep + 1), last + 1) for f in self.manifest(v)["buckets"].values()}
        for v in range(1, last - keep + 1):
            self._fs.delete(self._at(f"manifests/{v:08d}.json"), False)
        if self._fs.exists(self._at("data")):
            for f in self._fs.listStatus(self._at("data")):
                name = f.getPath().getName()
                if name not in used and int(name.split("-")[0]) <= last:
                    self._fs.delete(f.getPath(), True)


def merged_table(spark: SparkSession, path: str, schema: T.StructType | str, key: Sequence[str], buckets: int = BUCKETS) -> MergedTable:
    """The table at path; a new one of no rows if there is none."""
    t = MergedTable(spark, path)
    schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    if not set(key) <= set(schema.names) or not key:
        raise ValueError(f"not a key of {schema.names}: {list(key)}")
    if not t._version():
        t._commit({"schema": schema.jsonValue(), "key": list(key), "n": buckets, "buckets": {}, "counts": {}, "rows": 0, "batches": []}, 1)
    m = t.manifest()
    if m["key"] != list(key) or T.StructType.fromJson(m["schema"]).names != schema.names:
        raise ValueError(f"the table at {path} has another key or other columns")
    return t
