"""Merged tables against a dictionary."""

import random

import pytest

from quernstone.operators import upserts as U
from quernstone.storage import shared_folder

SCHEMA = "k bigint, part string, v double"


def rows_of(table):
    return {(r.k, r.part): r.v for r in table.read().collect()}


def test_batches_replace_and_delete(spark):
    rng, want = random.Random(5), {}
    table = U.merged_table(spark, shared_folder(spark), SCHEMA, ["k", "part"], buckets=8)
    assert rows_of(table) == {}
    for i in range(4):
        batch = {(rng.choice([None, *range(12)]), rng.choice(["a", None])): float(rng.randrange(100)) for _ in range(10)}
        gone = [] if i % 2 else [k for k in list(want)[:3] if k not in batch] + [(99, "never")]
        df = spark.createDataFrame([(*k, v) for k, v in batch.items()], SCHEMA)
        deletes = spark.createDataFrame(gone, "k bigint, part string") if gone else None
        before = len(want)
        want = {k: v for k, v in want.items() if k not in gone} | batch
        done = table.merge(df, f"b{i}", deletes)
        assert rows_of(table) == want and (done["before"], done["after"], done["new"]) == (before, len(want), True)
        again = table.merge(df, f"b{i}", deletes)
        assert not again["new"] and rows_of(table) == want


def test_only_touched_buckets_are_written(spark):
    table = U.merged_table(spark, shared_folder(spark), SCHEMA, ["k"], buckets=16)
    table.merge(spark.range(200).selectExpr("id AS k", "'x' AS part", "0D AS v"), "all")
    before = table.manifest()["buckets"]
    done = table.merge(spark.createDataFrame([(7, "y", 1.0), (7, "z", 0.5)], SCHEMA), "one")
    after = table.manifest()["buckets"]
    assert done == {"new": True, "before": 200, "after": 200, "touched": 1} and sum(before[b] != after[b] for b in before) == 1
    assert rows_of(table)[7, "z"] == 0.5  # of two rows of one key, the larger one
    assert table.read(2).where("k = 7").first().part == "x"  # the earlier version is still there
    table.clean_up(keep=1)
    assert len(rows_of(table)) == 200
    with pytest.raises(Exception, match="No such|not exist|PATH_NOT_FOUND"):
        table.manifest(2)


def test_failed_and_late_commits_leave_the_table(spark, monkeypatch):
    path = shared_folder(spark)
    table = U.merged_table(spark, path, SCHEMA, ["k"], buckets=4)
    one = spark.createDataFrame([(1, "a", 1.0)], SCHEMA)
    table.merge(one, "first")
    with monkeypatch.context() as m:
        m.setattr(U.MergedTable, "_commit", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            table.merge(spark.createDataFrame([(1, "b", 2.0), (2, "b", 2.0)], SCHEMA), "second")
    assert rows_of(table) == {(1, "a"): 1.0}
    version = table._version()
    with pytest.raises(U.Conflict):
        table._commit(table.manifest(), version)
    assert table.merge(spark.createDataFrame([(2, "b", 2.0)], SCHEMA), "second")["after"] == 2
    table.clean_up()
    assert len(rows_of(U.merged_table(spark, path, SCHEMA, ["k"]))) == 2
    for key, schema in ((["part"], SCHEMA), (["k"], "k bigint, other string"), (["z"], SCHEMA), ([], SCHEMA)):
        with pytest.raises(ValueError):
            U.merged_table(spark, path, schema, key)
    with pytest.raises(ValueError, match="deletes"):
        table.merge(one, "x", spark.createDataFrame([(1.0,)], "v double"))
