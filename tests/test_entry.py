"""The driver's contract: every query runs, and gives what its SQL gives in DuckDB."""

import math
import os
import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from quernstone.plans import queries as core


@pytest.fixture(scope="session")
def duck(sf):
    con = duckdb.connect()
    for f in Path(sf).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def plain(v):
    return (None if math.isnan(v) else round(v, 4) + 0.0) if isinstance(v, float) else v


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_sql_is_for_known_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(core.oracle_sql()))
def test_sql_twin(spark, duck, sf, name):
    df = core.queries()[name](spark, sf)
    cols = sorted(df.columns)
    ours = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=str)
    got = duck.execute(core.oracle_sql()[name])
    names = [x[0] for x in got.description]
    assert sorted(names) == cols
    theirs = sorted((tuple(plain(r[names.index(c)]) for c in cols) for r in got.fetchall()), key=str)
    assert ours == theirs


def test_every_query_has_a_twin():
    assert set(core.queries()) == set(core.oracle_sql())


@pytest.mark.parametrize("pipeline", [True, False])
def test_entry_without_the_corpus_operators(tmp_path, pipeline):
    root = Path(entry.__file__).parent
    shutil.copytree(root / "quernstone", tmp_path / "quernstone", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    (tmp_path / "quernstone/llm/__pycache__").mkdir(parents=True)  # what may be left of it
    for name in ["__spark_entry__.py", *["corpus_pipeline.py"] * (pipeline and (root / "corpus_pipeline.py").exists())]:
        shutil.copy(root / name, tmp_path)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(sorted(e.queries()) and sorted(e.oracle_sql()))"], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert said.returncode == 0, said.stderr
    assert "row_counts" in said.stdout and "op1_" not in said.stdout and "pipeline" not in said.stdout
