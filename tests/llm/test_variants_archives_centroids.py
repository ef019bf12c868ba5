"""Spelling variants, WARC archives and centroid clustering, against brute force on small rows with awkward ones."""

import hashlib
import json
import math
import random
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from quernstone.llm import centroids, spelling, warc
from quernstone.llm.common import shared_folder
from quernstone.llm.queries import queries

rng = random.Random(11)


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


# Spelling variants ------------------------------------------------------------------------------------------------------

SPELLING = ("word", "form", "root", "n", "n_near", "form_n")


def neighbourhood(word: str, letters: str) -> set[str]:
    """All strings one inserted, deleted or replaced letter away, and the word."""
    out = {word}
    for i in range(len(word) + 1):
        out |= {word[:i] + c + word[i:] for c in letters}
        if i < len(word):
            out |= {word[:i] + word[i + 1 :]} | {word[:i] + c + word[i + 1 :] for c in letters}
    return out


@pytest.mark.parametrize("symbols", [2, 3, 8])
@pytest.mark.parametrize("at_once", [7, 1 << 20])
def test_neighbourhood_is_full_and_each_once(monkeypatch, symbols, at_once):
    monkeypatch.setattr(spelling, "_AT_ONCE", at_once)
    reducer, letters = spelling.Reducer(symbols), "abcdefgh"[:symbols]
    code = lambda w: int(reducer.code(np.array([[ord(c) - 97 for c in w]], np.int64).reshape(1, len(w)))[0])
    for word in ["a", "aa", "ab", "abba", "aabbaab", "".join(rng.choice(letters) for _ in range(30))]:
        near = [int(x) for _, some in reducer.neighbours(np.array([[ord(c) - 97 for c in word]])) for x in some]
        assert sorted(near) == sorted(code(w) for w in neighbourhood(word, letters))


def test_spelling_query_against_brute_force(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert rows(queries()["op11_reduced_alphabet"](spark, sf), *SPELLING) == sorted(spelling.brute_force(docs), key=str)


def test_spelling_awkward_documents(spark, tmp_path):
    base = ["banane", "bananes", "banana", "Zürich", "zürich", "ÉCOLES", "écoles", "x" * 3000, "x" * 3001, "x" * 2999 + "y", "kurz", "lettre", "letter", "lettér"]
    texts = [" ".join(rng.choices(base, k=60)) for _ in range(60)] + [None, "", "123 --", "banane" * 2000, "banane;" * 5000]
    docs = [(i, t) for i, t in enumerate(texts)] + [(None, "banane bananes"), (3, "banana"), (3, "banana")]
    spark.createDataFrame([(*d, "w", 1) for d in docs], "doc_id bigint, text string, word string, n int").write.parquet(f"{tmp_path}/documents.parquet")
    got = rows(spelling.op11_reduced_alphabet(spark, str(tmp_path)), *SPELLING)
    assert got == sorted(spelling.brute_force(docs), key=str)
    assert any(r[0] == "x" * 3000 and r[4] >= 2 for r in got)


def test_spelling_chains_and_edges(spark):
    words = [("abcdefg", 1), ("abcdefh", 5), ("abcdeih", 25), ("abcdjih", 125), ("zzzzzzz", 3), ("abcdefgg", 1), ("a", 9), ("b", 9), ("", 4), (None, 2)]
    got = {r.word: (r.form, r.root, r.n_near) for r in spelling.spelling_groups(spark.createDataFrame(words, "word string, n int"), symbols=2).collect()}
    assert got["abcdefg"] == ("abcdefh", "abcdjih", 2) and got["abcdeih"] == ("abcdjih", "abcdjih", 2) and got["zzzzzzz"] == (None, "zzzzzzz", 0)
    assert got["a"][0] is None and got["a"][2] == 1 and got[""] == (None, "", 0) and got[None] == (None, None, 0)
    assert spelling.spelling_groups(spark.createDataFrame([], "word string, n bigint")).count() == 0
    with pytest.raises(ValueError):
        spelling.spelling_groups(spark.createDataFrame(words, "word string, n int"), factor=1)
    tie = spark.createDataFrame([("foxes", 1), ("boxes", 7), ("aoxes", 7)], "word string, n int")
    assert {r.word: r.form for r in spelling.spelling_groups(tie).collect()}["foxes"] == "aoxes"


# Archives ---------------------------------------------------------------------------------------------------------------

PAGES = "page_id bigint, url string, html string, payload string, shard int"


def page_rows():
    long, other = "<p>é" * 60, "<b>" * 400
    out = [(i, f"http://a.example/{i}", long if i % 3 == 0 else f"{other}{i}", "x", 1) for i in range(40)]
    out += [(100, "http://a/\r\nWARC-Type: response", long, "x", 1), (101, None, "short", "x", 1), (102, "", "short", "x", 1), (103, "http://ü/%41", None, "x", 1), (104, "u", "", "x", 1)]
    out += [(None, "null", other + "n", "x", 1), (None, "null", other + "n", "x", 1), (None, None, "tiny", "x", 1)]
    out += [(7, "http://again", long, "x", 1)] * 30 + [(200, "big", "\r\n\r\nWARC/1.1" * 200_000, "x", 1)]
    return out


def expected(pages):
    """Of the contract: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    body = [(i, u, (h or "").encode()) for i, u, h, *_ in pages]
    groups = {}
    for k, (i, u, b) in enumerate(body):
        if len(b) >= 100:
            groups.setdefault(b, []).append((i is None, i or 0, u is not None, u or "", k))
    first = {b: min(g) for b, g in groups.items()}
    out = []
    for k, (i, _, b) in enumerate(body):
        again = b in first and first[b][4] != k
        out.append((i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", (None if first[b][0] else first[b][1]) if again else None))
    return sorted(out, key=str)


ARCHIVE = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@pytest.mark.parametrize(("shard_bytes", "file_bytes"), [(1 << 30, 1 << 30), (9_000, 2_000)])
def test_archive_round_trip(spark, monkeypatch, shard_bytes, file_bytes):
    monkeypatch.setattr(warc, "COPIES", 4)
    pages, path = page_rows(), shared_folder(spark)
    warc.write_warc(spark.createDataFrame(pages, PAGES).repartition(3), path, shard_bytes=shard_bytes, file_bytes=file_bytes)
    every = warc.read_warc(spark, path, payloads=True)
    assert rows(every, *ARCHIVE) == expected(pages)
    kept = every.collect()
    assert sorted(map(str, ((r.page_id, r.url) for r in kept))) == sorted(map(str, ((i, u) for i, u, *_ in pages)))
    assert len({r.record_id for r in kept}) == len(kept)
    body = {(r.page_id, r.url): r.payload for r in kept if r.record_type == "response"}
    assert bytes(body[(200, "big")]).decode() == pages[-1][2] and all((r.payload is None) == (r.record_type == "revisit") for r in kept)
    files = sorted(p.name for p in Path(path.removeprefix("file:")).glob("shard-*"))
    assert (len(files) > 5) == (file_bytes < 1 << 20)
    assert not (Path(path.removeprefix("file:")) / "_temporary").exists()


def test_archive_is_the_same_however_rows_are_dealt(spark):
    pages = page_rows()

    def digests(df):
        path = shared_folder(spark)
        warc.write_warc(df, path, shard_bytes=20_000, file_bytes=4_000)
        return json.loads((Path(path.removeprefix("file:")) / warc.MANIFEST).read_text())["files"]

    df = spark.createDataFrame(pages, PAGES)
    assert digests(df.repartition(2, "page_id")) == digests(df.repartition(5, "url").orderBy(F.desc("url")))


def test_archive_commits_as_a_whole(spark):
    pages, path = spark.createDataFrame(page_rows()[:10], PAGES), shared_folder(spark)
    folder = Path(path.removeprefix("file:"))
    (folder / "_temporary/earlier").mkdir(parents=True)  # what an attempt that was lost leaves behind
    (folder / "_temporary/earlier/shard-000000-00000.warc.gz").write_bytes(b"half a rec")
    with pytest.raises(Exception, match=r"MANIFEST|not exist|No such"):
        warc.read_warc(spark, path).count()
    warc.write_warc(pages, path)
    assert warc.read_warc(spark, path).count() == 10 and not (folder / "_temporary").exists()
    with pytest.raises(Exception, match="holds an archive"):
        warc.write_warc(pages, path)
    file = next(folder.glob("shard-*"))
    file.write_bytes(file.read_bytes()[:-40])
    with pytest.raises(Exception, match=r"ends within|differs"):
        warc.read_warc(spark, path, payloads=True).collect()


def test_archive_of_nothing(spark):
    path = shared_folder(spark)
    warc.write_warc(spark.createDataFrame([], PAGES), path)
    assert warc.read_warc(spark, path).count() == 0


def test_bounds_deal_heavy_keys_over_several_shards():
    sample = [((k,), 1.0) for k in range(50)] + [((50,), 100.0)] + [((k,), 1.0) for k in range(51, 100)]
    bounds = warc.bounds_of(sample, 10)
    heavy = next(b for b in bounds if b[0] == (50,))
    assert heavy[2] - heavy[1] >= 4 and bounds[0][1] == 0 and max(b[2] for b in bounds) == 9
    assert [b[0] for b in bounds] == sorted(b[0] for b in bounds)


# Centroids --------------------------------------------------------------------------------------------------------------

CENTROIDS = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
VECTORS = "vec_id bigint, embedding array<float>, cluster string"


def vectors():
    r = np.random.default_rng(5)
    out = [(i, [float(np.float32(x)) for x in r.normal(0, 0.2, 64)]) for i in range(120)]
    out += [(200 + i, out[3][1]) for i in range(60)] + [(5, out[9][1]), (5, out[9][1]), (None, out[11][1]), (None, [0.0] * 64), (300, [-0.0] * 64)]
    bad = [(400, None), (401, []), (402, [0.1] * 63), (403, [0.1] * 65), (404, [0.1] * 63 + [None]), (405, [0.1] * 63 + [math.nan]), (406, [0.1] * 63 + [math.inf]), (407, [-math.inf] + [0.1] * 63)]
    return out + bad


def write(spark, tmp_path, some):
    spark.createDataFrame([(*v, "c") for v in some], VECTORS).repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    return str(tmp_path)


def test_centroid_query_against_brute_force(spark, sf, tmp_path):
    got = rows(queries()["op13_subvector_centroids"](spark, sf), *CENTROIDS)
    assert got == centroids.brute_force([(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()])
    folder = write(spark, tmp_path, vectors())
    assert rows(centroids.op13_subvector_centroids(spark, folder), *CENTROIDS) == centroids.brute_force(vectors())


@pytest.mark.parametrize("codes", [1, 40])
def test_rare_subvectors_stay_plain(spark, tmp_path, codes):
    df = spark.read.parquet(write(spark, tmp_path, vectors()) + "/embeddings.parquet")
    few, some = centroids.cluster(df, codes=codes)
    all_, every = centroids.cluster(df)
    assert some == every and rows(few, "id", "cluster", "distance") == rows(all_, "id", "cluster", "distance")


def test_centroids_of_odd_and_few_vectors(spark, tmp_path):
    some = [(1, [0.5, -0.25, 1.0]), (2, [0.5, -0.26, 1.0]), (3, [9.0, 9.0, -9.0])]
    df = spark.createDataFrame([(*v, "c") for v in some], VECTORS)
    found, cents = centroids.cluster(df, dims=3, k=2, rounds=2)
    want = centroids.brute_force(some, dims=3, k=2, rounds=2)
    assert rows(found, "id", "cluster", "distance") == [r[:3] for r in want] and len(cents) == 2
    none, cents = centroids.cluster(df.limit(0))
    assert none.count() == 0 and cents == []
    assert centroids.op13_subvector_centroids(spark, write(spark, tmp_path, [(1, None)])).count() == 0
    with pytest.raises(Exception, match="when scaled"):
        centroids.cluster(spark.createDataFrame([(1, [3e30] * 3, "c")], VECTORS), dims=3)


def test_packed_components():
    x = np.array([[-(2**26) + 1, 2**26 - 1, -1], [0, -1, 5]])
    hi, lo = centroids.unpack(centroids.pack(x))
    assert hi.tolist() == [[-(2**26) + 1, -1], [0, 5]] and lo.tolist() == [[2**26 - 1, 0], [-1, 0]]
