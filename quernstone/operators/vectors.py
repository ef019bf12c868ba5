"""Cosine top-k of sets of vectors: exact, and by an index of inverted lists.

Vectors are compared in blocks: a chunk of vectors and a block of queries that
share a list meet in one group of bounded size, as two matrices, and leave k
rows for each query.  Without an index all vectors of one length are a list.
With one, a vector stands in the list of its nearest centre, and a query meets
the lists of its nearest centres only; the lists are folders of one table, so
Spark reads no others.  What a list can hold at best follows from the angle
between its centre and its farthest vector, so a search can also go on until no
list left can better the result, which is then exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..storage import removed, shared_folder, written

#: Vectors of a chunk and queries of a block: their similarities take 16 MB.
CHUNK, BLOCK = 4096, 512
#: Vectors that centres are fitted on, and centres at most: 64 MB with 1,024 components.
SAMPLE, LISTS = 1 << 16, 1 << 13
#: Components that a task compares with centres, or hands on, at once: 32 MB.
STEP = 1 << 22
#: Vectors without a length: they are alike to nothing, and nothing is their centre.
NOWHERE = -1
_SLACK = 1e-9


def _usable(vector: str):
    """Neither null nor with a component that is null or NaN."""
    return F.col(vector).isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")))


def _unit(column: pd.Series) -> np.ndarray:
    m = np.array(column.tolist(), np.float64)
    return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)


def _steps(frames: Iterator[pd.DataFrame], centres: np.ndarray) -> Iterator[pd.DataFrame]:
    """The frames in parts of so few rows that a copy of each row for each centre has STEP components at most (or in single rows)."""
    rows = max(1, STEP // max(1, centres.size))
    for f in frames:
        for i in range(0, len(f), rows):
            yield f.iloc[i : i + rows]


def _best(queries: np.ndarray, names: np.ndarray, s: np.ndarray, k: int) -> pd.DataFrame:
    """The k largest of each row of s and all that equal the last of them, cut to k by name."""
    k, s = min(k, s.shape[1]), s + 0.0  # no -0.0, which sorts below 0.0
    least = -np.partition(-s, k - 1, axis=1)[:, k - 1]
    row, col = np.nonzero(s >= least[:, None])
    order = np.lexsort((names[col], -s[row, col], row))
    row, col = row[order], col[order]
    kept = np.arange(len(row)) - np.searchsorted(row, row) < k
    row, col = row[kept], col[kept]
    return pd.DataFrame({"query_id": queries[row], "id": names[col], "similarity": s[row, col]})


def _meet(queries: DataFrame, vectors: DataFrame, chunks: DataFrame, k: int) -> DataFrame:
    """(query_id, id, similarity), k rows for each query, list and chunk.  queries: list, query_id, embedding; vectors: list, chunk, id, embedding; chunks: list, chunks."""
    # A cogroup does not bring keys to one type.
    queries, vectors, chunks = (df.withColumn("list", F.col("list").cast("bigint")) for df in (queries, vectors, chunks))
    per = queries.groupBy("list").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    q = queries.join(per, "list").join(chunks, "list")
    q = q.select("list", F.pmod(F.xxhash64("query_id"), "blocks").cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), "query_id", "embedding")
    v = vectors.join(per, "list").select("list", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "chunk", "id", "embedding")

    def both(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if a.empty or b.empty:
            return pd.DataFrame({"query_id": [], "id": [], "similarity": []})
        return _best(a["query_id"].to_numpy(), b["id"].to_numpy(), _unit(a["embedding"]) @ _unit(b["embedding"]).T, k)

    key = ["list", "block", "chunk"]
    return q.groupBy(*key).cogroup(v.groupBy(*key)).applyInPandas(both, "query_id bigint, id bigint, similarity double")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.desc("similarity"), "id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _chunked(vectors: DataFrame, chunks: DataFrame) -> DataFrame:
    """Vectors (list, id, embedding) with a chunk, dealt by id."""
    return vectors.join(chunks, "list").withColumn("chunk", F.pmod(F.xxhash64("id"), "chunks").cast("int")).drop("chunks")


def exact_top_k(queries: DataFrame, vectors: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, id_col, similarity, rank): the k vectors most like each query (query_id, embedding), all being compared.

    Ties go by id.  Vectors meet queries of their own length; null vectors, and
    those with null or NaN components, meet none.  A vector without a length
    has similarity 0.
    """
    q = queries.select("query_id", "embedding").where(_usable("embedding")).withColumn("list", F.size("embedding"))
    v = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("embedding")).where(_usable("embedding")).withColumn("list", F.size("embedding"))
    chunks = v.groupBy("list").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))
    found = _meet(q, _chunked(v, chunks), chunks, k)
    return _ranked(found, k).select("query_id", F.col("id").alias(id_col), "similarity", "rank")


@dataclass(frozen=True)
class VectorIndex:
    """Vectors by list at path/vectors, and path/lists, written last: list, centre, n, chunks, nearest (cosine of the farthest vector)."""

    spark: SparkSession
    path: str

    @property
    def lists(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/lists")

    @property
    def vectors(self) -> DataFrame:
        return self.spark.read.schema("id bigint, embedding array<double>, chunk int, list bigint").parquet(f"{self.path}/vectors")

    def targets(self, queries: DataFrame, probes: int, beyond: bool = False) -> DataFrame:
        """(list, query_id, embedding): the probes nearest lists of each query.

        With `beyond`, all other lists that can hold a vector more like the
        query than its column least, or as much.
        """
        rows = self.lists.where(F.col("list") != NOWHERE).orderBy("list").collect()  # LISTS at most
        names = np.array([r.list for r in rows], np.int64)
        centres = self.spark.sparkContext.broadcast((np.array([r.centre for r in rows], np.float64), np.arccos(np.clip([r.nearest for r in rows], -1, 1))))
        nowhere = bool(self.lists.where(F.col("list") == NOWHERE).take(1))

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            c, radius = centres.value
            for f in _steps(frames, c):
                u = _unit(f["embedding"])
                s = u @ c.T
                first = np.argsort(-s, axis=1, kind="stable")[:, :probes]
                hit = np.zeros(s.shape, bool)
                np.put_along_axis(hit, first, True, axis=1)
                if beyond:
                    away = np.maximum(np.arccos(np.clip(s, -1, 1)) - radius, 0)
                    # A query without a length is equally far from everything.
                    best = np.where(np.linalg.norm(u, axis=1) > 0.5, np.cos(away).T, 0.0).T
                    hit = ~hit & (best + _SLACK >= f["least"].to_numpy()[:, None])
                row, col = np.nonzero(hit)
                out = pd.DataFrame({"list": names[col], "query_id": f["query_id"].to_numpy()[row], "embedding": f["embedding"].to_numpy()[row]})
                if nowhere:
                    some = f[f["least"] <= 0] if beyond else f.iloc[:0]
                    out = pd.concat([out, pd.DataFrame({"list": NOWHERE, "query_id": some["query_id"], "embedding": some["embedding"]})])
                yield out

        return queries.mapInPandas(run, "list bigint, query_id bigint, embedding array<double>")

    def _look(self, targets: DataFrame, k: int) -> DataFrame:
        wanted = sorted(r.list for r in targets.select("list").distinct().collect())  # LISTS at most
        vectors = self.vectors.where(F.col("list").isin(wanted))
        return _ranked(_meet(targets, vectors, self.lists.select("list", "chunks"), k), k)

    def search(self, queries: DataFrame, k: int = 10, probes: int = 8, exact: bool = False) -> DataFrame:
        """(query_id, id, similarity, rank) of queries (query_id, embedding).

        A query compares itself with the vectors of `probes` lists; vectors
        without a length are only found by an exact search.  exact goes on to
        every list that may hold a better vector.  Queries that are null, or
        have null or NaN components, find nothing; other lengths than the
        index's are an error.
        """
        one = self.lists.where(F.col("list") != NOWHERE).first()
        if one is None:  # no vector has a length
            return exact_top_k(queries, self.vectors, k, "id")
        dims = len(one.centre)
        vector = F.when(F.size("embedding") == dims, F.col("embedding").cast("array<double>")).otherwise(F.raise_error(F.lit(f"vectors must have {dims} components")).cast("array<double>"))
        folder = shared_folder(self.spark)
        q = written(queries.where(_usable("embedding")).select(F.col("query_id").cast("bigint").alias("query_id"), vector.alias("embedding")), f"{folder}/queries")
        found = self._look(written(self.targets(q, probes), f"{folder}/targets"), k)
        if not exact:
            return found
        found = written(found, f"{folder}/found")
        least = found.where(F.col("rank") == k).select("query_id", F.col("similarity").alias("least"))
        open_ = q.join(least, "query_id", "left").fillna({"least": -2.0})
        more = self._look(written(self.targets(open_, probes, beyond=True), f"{folder}/beyond"), k)
        return _ranked(found.drop("rank").unionByName(more.drop("rank")), k)

    def compared(self, queries: DataFrame, probes: int) -> DataFrame:
        """(query_id, n): vectors that a search by that many probes compares with each query."""
        q = queries.where(_usable("embedding")).select("query_id", F.col("embedding").cast("array<double>").alias("embedding"))
        return self.targets(q, probes).select("list", "query_id").join(self.lists.select("list", "n"), "list").groupBy("query_id").agg(F.sum("n").alias("n"))


def build_index(vectors: DataFrame, path: str, id_col: str = "vec_id", vector_col: str = "embedding", lists: int | None = None, sample: int = SAMPLE, rounds: int = 8, seed: int = 1) -> VectorIndex:
    """Writes an index of all usable vectors to path.

    Centres are fitted by k-means on the `sample` vectors whose ids have the
    smallest hashes; every vector is put in the list of its nearest centre.
    lists is the square root of the number of vectors by default, LISTS at
    most.  A list of many vectors is dealt over chunks, each a file.  Vectors
    of different lengths are an error; null ones, and those with null or NaN
    components, are left out, as a search never finds them.
    """
    spark, stage = vectors.sparkSession, f"{path}/staging"
    v = vectors.where(_usable(vector_col)).select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("embedding"))
    fit = written(v.where(F.exists("embedding", lambda x: x != 0)).orderBy(F.xxhash64("id"), "id").limit(sample), f"{stage}/sample")
    n = v.count()
    head = fit.first()
    dims = len(head.embedding) if head else 0
    k = min(lists or max(1, round(math.sqrt(n))), LISTS, max(fit.count(), 1))
    centres = np.zeros((0, dims))
    if head and k > 1:
        model = KMeans(k=k, maxIter=rounds, seed=seed, distanceMeasure="cosine", featuresCol="features").fit(fit.select(array_to_vector("embedding").alias("features")))
        centres = np.array(model.clusterCenters())
    elif head:
        centres = np.array([head.embedding])
    centres = np.unique(centres / np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-300), axis=0)
    shared = spark.sparkContext.broadcast(centres)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in _steps(frames, shared.value):
            if (f["embedding"].map(len) != dims).any() and dims:
                raise ValueError(f"vectors must have {dims} components")
            u = _unit(f["embedding"]) if dims else np.zeros((len(f), 0))
            s = u @ shared.value.T if len(shared.value) else np.zeros((len(f), 1))
            at = s.argmax(axis=1)
            nowhere = np.linalg.norm(u, axis=1) < 0.5
            yield f.assign(list=np.where(nowhere, NOWHERE, at), near=np.where(nowhere, 0.0, s[np.arange(len(f)), at]))

    placed = written(v.mapInPandas(run, "id bigint, embedding array<double>, list bigint, near double"), f"{stage}/placed")
    about = placed.groupBy("list").agg(F.count("*").alias("n"), F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"), F.min("near").alias("nearest"))
    about = written(about, f"{stage}/about")
    rows = _chunked(placed.drop("near"), about.select("list", "chunks"))
    written(rows.repartition("list", "chunk"), f"{path}/vectors", partition_by="list")
    named = spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(centres)], "list bigint, centre array<double>")
    written(about.join(named, "list", "left").coalesce(1), f"{path}/lists")
    removed(spark, stage)
    return VectorIndex(spark, path)
