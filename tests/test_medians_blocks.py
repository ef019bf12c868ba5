"""Medians by selection and samples by row groups."""

import random
from statistics import median

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from quernstone.operators import stats as S
from quernstone.operators.medians import FINE, medians
from quernstone.sources import blocks as B


def test_medians_of_sizes_of_every_scale(spark):
    draw = random.Random(3)
    rows = [(g, draw.choice([draw.randrange(10), draw.randrange(FINE), draw.randrange(FINE, 1 << 18), draw.randrange(1 << 31)])) for g in "abcd" for _ in range(200)]
    rows += [("even", 1), ("even", (1 << 31) - 1), ("odd", FINE), ("odd", FINE - 1), ("odd", FINE + 1), ("none", None), (None, 5), (None, 8)]
    df = spark.createDataFrame(rows, "kind string, v bigint")
    got = {(r.kind, r.column): r.median for r in medians(df, {"v": F.col("v"), "tens": F.floor(F.col("v") / 10)}, ["kind"]).collect()}
    for g in {g for g, _ in rows} - {"none"}:
        v = [x for k, x in rows if k == g]
        assert got[g, "v"] == median(v) and got[g, "tens"] == median(x // 10 for x in v)
    assert not [k for k in got if k[0] == "none"]
    assert medians(df, {"v": F.col("v")}).first().median == median(x for _, x in rows if x is not None)


def test_medians_of_nothing_and_errors(spark):
    empty = spark.createDataFrame([], "kind string, v bigint")
    assert not medians(empty, {"v": F.col("v")}).collect() and not medians(empty, {"v": F.col("v")}, ["kind"]).collect()
    with pytest.raises(Exception, match="negative"):
        medians(spark.sql("SELECT -1 AS v"), {"v": F.col("v")}).collect()
    with pytest.raises(ValueError, match="groups"):
        medians(spark.sql("SELECT 1 AS median, 2 AS v"), {"v": F.col("v")}, ["median"])


def test_profile_takes_the_middle_of_long_texts_without_a_percentile(spark):
    df = spark.sql("SELECT repeat('a', n) AS t, array(n) AS l FROM VALUES (3), (70000), (70005), (400000), (NULL) AS v(n)")
    p = S.profile(df)
    assert {r.column: r.median_length for r in p.collect()}["t"] == 70002.5
    assert "percentile" not in p._jdf.queryExecution().toString().lower()
    assert S.profile(df, median=False).where("median_length IS NOT NULL").count() == 0


@pytest.fixture(scope="module")
def blocks_of(tmp_path_factory):
    """Two files of unlike row groups: 7 of 100 and 4 of 50 rows, some equal, some null."""
    folder = tmp_path_factory.mktemp("blocks")
    for name, n, size in (("a", 700, 100), ("b", 200, 50)):
        ids = [None if i % 31 == 0 else i // 2 for i in range(n)]
        table = pa.table({"id": pa.array(ids, pa.int64()), "name": [f"{name}{i}" for i in range(n)], "tags": [[i, i + 1] for i in range(n)], "at": pa.array(range(n), pa.timestamp("us", "UTC"))})
        pq.write_table(table, folder / f"{name}.parquet", row_group_size=size)
    return str(folder)


def test_block_sample_has_the_number_of_rows_and_no_others(spark, blocks_of):
    whole = spark.read.parquet(blocks_of)
    for fraction, rows in ((0.0, 0), (0.001, 1), (0.1, 90), (0.5, 450), (1.0, 900)):
        got = B.block_sample(spark, blocks_of, fraction, seed=5)
        assert got.schema == whole.schema and got.count() == rows and got.exceptAll(whole).count() == 0
    with pytest.raises(ValueError, match="fraction"):
        B.block_sample(spark, blocks_of, 1.5)


def test_block_sample_reads_what_it_needs_and_repeats_itself(spark, blocks_of):
    every = B.row_groups(spark, blocks_of)
    assert sorted(r.rows for r in every.collect()) == [50] * 4 + [100] * 7
    narrow = B.row_groups(spark, blocks_of, ["id"]).agg(F.sum("bytes")).first()[0]
    assert 0 < narrow < every.agg(F.sum("bytes")).first()[0] / 2
    every, seen = spark.createDataFrame(every.collect(), every.schema), set()
    for seed in range(30):
        chosen = B.choose_blocks(every, 0.2, seed).collect()
        assert sum(r.take for r in chosen) == 180 and sum(r.take < r.rows for r in chosen) <= 1 and all(0 <= r.start <= r.rows - r.take for r in chosen)
        seen |= {(r.path, r.block) for r in chosen}
    assert len(seen) == 11
    one, two = (sorted(r.name for r in B.block_sample(spark, blocks_of, 0.3, 9, ["name"]).collect()) for _ in range(2))
    assert one == two and one != sorted(r.name for r in B.block_sample(spark, blocks_of, 0.3, 10, ["name"]).collect())


def test_block_sample_of_odd_tables(spark, tmp_path):
    spark.createDataFrame([], "a int").write.parquet(f"{tmp_path}/empty")
    assert B.block_sample(spark, f"{tmp_path}/empty", 0.5).count() == 0
    spark.range(4).selectExpr("id", "id % 2 AS part", "id AS `a b.c`").write.partitionBy("part").parquet(f"{tmp_path}/parts")
    with pytest.raises(ValueError, match="partitioned"):
        B.block_sample(spark, f"{tmp_path}/parts", 0.5)
    got = B.block_sample(spark, f"{tmp_path}/parts/part=0", 1, columns=["a b.c"]).collect()
    assert sorted(r[0] for r in got) == [0, 2]


def test_a_task_opens_a_file_once(spark, tmp_path):
    """200 row groups of two files are read with two files opened."""
    for name in "ab":
        pq.write_table(pa.table({"id": range(1000)}), tmp_path / f"{name}.parquet", row_group_size=10)
    chosen = B.choose_blocks(B.row_groups(spark, str(tmp_path)), 1.0)
    plan = B.read_blocks(spark, str(tmp_path), chosen)
    assert plan.count() == 2000 and plan.agg(F.sum("id")).first()[0] == 999_000
    opened = []

    class Counting:
        def __init__(self, uri):
            opened.append(uri)
            self.file = pq.ParquetFile(uri.removeprefix("file://"))

        def __getattr__(self, name):
            return getattr(self.file, name)

    run = B._runs(plan.schema, Counting)
    rows = chosen.select("path", "block", "start", "take").orderBy("path", "block").toPandas()
    assert sum(b.num_rows for b in run([pa.RecordBatch.from_pandas(rows)])) == 2000 and len(opened) == 2
