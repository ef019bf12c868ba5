"""The pipeline against a plain version of its stages."""

import corpus_pipeline
from pyspark.sql import functions as F

from quernstone.llm import decontaminate, language_id, ngram_join, packing
from quernstone.llm.common import stash


def test_stages_against_plain_version(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    odd = spark.createDataFrame([(10_001, None, "en", "s", 0), (10_002, "12 ; 34", "en", "s", 7)], docs.schema)
    docs = docs.union(odd)
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    text = {r.doc_id: r.text for r in docs.collect()}
    kept = sorted(text)
    for (name, stage), want in zip(corpus_pipeline.STAGES[:-1], (no_letters, copies, near, tainted), strict=True):
        docs = stash(stage(spark, docs, sf))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        kept = want(kept, text, bench)
        assert sorted(r.doc_id for r in docs.select("doc_id").collect()) == kept, name
    out = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    assert sorted({r.doc_id for r in out}) == kept


def no_letters(ids, text, bench):
    return [d for d in ids if any(c.isalpha() for c in text[d] or "")]


def copies(ids, text, bench):
    best = {}
    for d in ids:
        key = "".join(c for c in text[d] if c not in " \t\n\x0b\f\r")
        best[key] = min(best.get(key, (0, 1 << 60)), (-len(text[d]), d))
    return sorted(d for _, d in best.values())


def near(ids, text, bench):
    return [d for d, _, c in ngram_join.brute_force([(d, text[d]) for d in ids], 5, 80) if d == c]


def tainted(ids, text, bench):
    return [r[0] for r in decontaminate.brute_force([(d, text[d]) for d in ids], bench) if not r[5]]


def test_run_is_the_stages(spark, sf):
    assert corpus_pipeline.run(spark, sf).count() > 0
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "ngram_join", "decontaminate", "best_fit_packing"]


def test_empty_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").where(F.lit(False))
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        assert out.count() == 0
        docs = out if "text" in out.columns else docs


def test_repeated_rows(spark, sf):
    row = (1, "the same text in two rows of one id", "en", "s", 5)
    docs = spark.createDataFrame([row, row], spark.read.parquet(f"{sf}/documents.parquet").schema)
    assert corpus_pipeline.exact_copies(spark, docs, sf).count() == 1
    assert packing.END == 2 and language_id.SAMPLE > 0


def test_null_and_repeated_ids(spark, sf):
    """Rows are judged one by one where ids are null or repeat."""
    words = [" ".join(f"{c}{i}" for i in range(40)) for c in "abcde"]
    a, b, c, d, e = words
    near_c = c.replace("c39", "other")
    rows = [(5, a), (5, b), (3, a), (None, a), (None, a), (None, a.replace(" ", "\t")), (None, c), (9, near_c), (9, d), (None, near_c + " more"), (7, e), (7, e.replace(" ", "\n")), (7, e)]
    schema = spark.read.parquet(f"{sf}/documents.parquet").schema
    docs = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in rows], schema)
    out = corpus_pipeline.exact_copies(spark, docs, sf)
    got = [(r.doc_id, r.text) for r in out.collect()]
    assert out.columns == docs.columns and len(got) == 7
    assert {x for x in got if x[0] != 7} == {(5, b), (3, a), (None, c), (9, near_c), (9, d), (None, near_c + " more")}
    got = [(r.doc_id, r.text) for r in corpus_pipeline.near_copies(spark, stash(out), sf).collect()]
    assert len(got) == 5 and {x for x in got if x[0] != 7} == {(5, b), (3, a), (9, near_c), (9, d)}


def test_row_keys_are_places(spark, sf):
    """No texts can be written whose rows share a key."""
    rows = [(7, "a b"), (7, "c d"), (8, "a b"), (None, "e f"), (None, "e f")]
    docs = spark.createDataFrame([(k, t, "en", "s", 3) for k, t in rows], spark.read.parquet(f"{sf}/documents.parquet").schema)
    keyed = corpus_pipeline._keyed(docs)
    assert keyed.select("row_key").distinct().count() == len(rows) == keyed.count()
    single = docs.where("text = 'a b'")
    assert sorted(r.row_key for r in corpus_pipeline._keyed(single).collect()) == [7, 8]
