"""Each operator against a brute-force version, on small documents with awkward rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quernstone.llm import decontaminate, exact_dedup, language_id, ngram_join, packing, pii, sharding, substring_dedup, token_rollup, url_rules
from quernstone.llm.common import components, shared_folder
from quernstone.llm.queries import oracle_sql, queries
from quernstone.llm.textscan import SPACED, words, text_bytes

DOCS = "doc_id bigint, text string, lang string, source string, extra string"
rng = random.Random(3)
VOCABULARY = [f"w{i}" for i in range(300)]


def sentence(n: int) -> str:
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


def frame(spark, texts, **more):
    rows = [(i, t, "en", "s", "x") for i, t in (texts.items() if isinstance(texts, dict) else enumerate(texts))]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def texts():
    base = [sentence(rng.choice([3, 30, 120, 400])) for _ in range(40)]
    passage = sentence(70)
    out = [*base, *base[:10], None, "", " \t ", "one", "One", "a b c", "A\tB\nC", "é " * 60, "x " * 500]
    for t in base[10:25]:  # near copies
        w = t.split()
        w[rng.randrange(len(w))] = "changed"
        out.append(" ".join(w))
    out += [f"{sentence(20)} {passage} {sentence(rng.choice([0, 5, 60]))}" for _ in range(12)]
    out += [" ".join(passage.split()[5:66]), " ".join(passage.split()[:49]), passage + " " + passage]
    return out


def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_words_match_plain_splitting(texts):
    import pyarrow as pa

    data, offsets = text_bytes(pa.array(texts).slice(1))
    s, e, first, _ = words(data, offsets, SPACED, 7)
    for i, t in enumerate(texts[1:]):
        assert [data[a:b].tobytes() for a, b in zip(s[first[i] : first[i + 1]], e[first[i] : first[i + 1]], strict=True)] == (t or "").encode().split()


def thue_morse(n: int) -> tuple[str, str]:
    """Two strings of 2**n letters that collide under every polynomial hash modulo 2**64, from n = 10 on."""
    a, b = "a", "b"
    for _ in range(n):
        a, b = a + b, b + a
    return a, b


def test_hashes_of_words_and_runs(texts):
    import numpy as np
    import pyarrow as pa

    from quernstone.llm.textscan import runs, shingles

    odd = [*texts, *thue_morse(10), "q" * 63, "q" * 64, "q" * 65, " ".join(thue_morse(6)[0]), " ".join(thue_morse(6)[1])]
    data, offsets = text_bytes(pa.array(odd))
    s, e, first, h, h2 = words(data, offsets, SPACED, 7, 2)
    seen: dict = {}
    plain = [data[a:b].tobytes() for a, b in zip(s, e, strict=True)]
    assert all(seen.setdefault(w, x) == x for w, x in zip(plain, zip(h.tolist(), h2.tolist(), strict=True), strict=True))
    assert len({x for x, _ in seen.values()}) == len({x for _, x in seen.values()}) == len(seen)
    for k in (1, 4, 5, 13, 50):
        g, at = shingles(h, first, k)
        own: dict = {}
        for i in range(len(odd)):
            w = plain[first[i] : first[i + 1]]
            want = [tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))] if w else []
            assert len(want) == at[i + 1] - at[i] and all(own.setdefault(x, y) == y for x, y in zip(want, g[at[i] : at[i + 1]].tolist(), strict=True))
        assert len(set(own.values())) == len(own)
    start = np.array([rng.randrange(len(h)) for _ in range(2000)])
    end = np.minimum(start + np.array([rng.randrange(1, 130) for _ in start]), len(h))
    own = {}
    assert all(own.setdefault(tuple(plain[a:b]), x) == x for a, b, x in zip(start, end, runs(h, start, end).tolist(), strict=True))
    assert len(set(own.values())) == len(own)


def test_strings_made_to_collide(spark):
    """Different words, windows and pieces are different, whatever someone writes."""
    a, b = thue_morse(10)
    docs = [f"{a} " * 60, f"{b} " * 60, " ".join([a, *"xyz"] * 30), " ".join([b, *"xyz"] * 30), *thue_morse(11)]
    data = list(enumerate(docs))
    assert sorted(map(tuple, ngram_join.ngram_jaccard_join(frame(spark, docs), 4, 85).collect())) == sorted(ngram_join.brute_force(data))
    bench = [(1, f"{a} " * 20), (2, " ".join(thue_morse(6)[0]))]
    got = decontaminate.decontaminate(frame(spark, docs), spark.createDataFrame(bench, "item_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_hit, r.n_items) for r in got) == sorted((x[0], x[2], x[3]) for x in decontaminate.brute_force(data, bench))
    assert sorted(map(tuple, substring_dedup.substring_dedup(frame(spark, docs)).drop("factors").collect())) == sorted(substring_dedup.brute_force(data))
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.tokenizer_path())
    rows = token_rollup.token_counts(frame(spark, docs), packing.tokenizer_path()).collect()
    assert {r.doc_id: r.n_tokens for r in rows} == {i: len(tok.encode(t, add_special_tokens=False).ids) for i, t in data}


def test_texts_beyond_a_slice(spark):
    """Texts above the slice of 2 MB, beside short ones."""
    huge = sentence(500_000)
    assert len(huge) > 2 << 20
    docs = [sentence(20), huge, huge + " end", sentence(30), huge[100_000:400_000]]
    data = list(enumerate(docs))
    assert sorted(map(tuple, ngram_join.ngram_jaccard_join(frame(spark, docs), 4, 85).collect())) == sorted(ngram_join.brute_force(data))
    assert sorted(map(tuple, substring_dedup.substring_dedup(frame(spark, docs)).drop("factors").collect())) == sorted(substring_dedup.brute_force(data))
    item = " ".join(huge.split()[250_000:250_040])
    got = decontaminate.decontaminate(frame(spark, docs), spark.createDataFrame([(1, item)], "item_id long, text string")).collect()
    assert {r.doc_id for r in got if r.n_hit >= 40} == {1, 2} and all(r.n_words == len(docs[r.doc_id].split()) for r in got)
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.tokenizer_path())
    counts = {r.doc_id: r.n_tokens for r in token_rollup.token_counts(frame(spark, docs), packing.tokenizer_path()).collect()}
    assert counts == {i: len(tok.encode(t, add_special_tokens=False).ids) for i, t in data}
    assert {r.doc_id: r.lang_pred for r in language_id.identify(frame(spark, docs)).collect()} == dict.fromkeys(range(5), "en")


# 1 ----------------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize(("k", "percent"), [(4, 85), (5, 80), (1, 50)])
def test_ngram_join(spark, texts, k, percent):
    got = ngram_join.ngram_jaccard_join(frame(spark, texts), k, percent)
    assert sorted(map(tuple, got.collect())) == sorted(ngram_join.brute_force(list(enumerate(texts)), k, percent))


@pytest.mark.parametrize("direct", [1.0, -1.0])
def test_ngram_join_chains_and_hot_groups(spark, monkeypatch, direct):
    """A long chain of near copies, and many copies of one text with one word changed, with one hub for each list and with several."""
    monkeypatch.setattr(ngram_join, "DIRECT", direct)
    w = sentence(60).split()
    chain = []
    for i in range(25):
        w = list(w)
        w[2 * i] = f"new{i}"
        chain.append(" ".join(w))
    hub = sentence(200).split()
    near = [" ".join([*hub[:i], f"edit{i}", *hub[i + 1 :]]) for i in range(60)]
    far = []  # copies with so many edits that some are linked with others only, or with none
    for i in range(150):
        w = list(hub)
        for j in rng.sample(range(0, 200, rng.choice([1, 10])), rng.choice([2, 4, 5, 6, 7, 9])):
            w[j] = f"e{rng.randrange(3)}" if i % 3 else f"e{i}-{j}"
        far.append(" ".join(w[rng.randrange(15) : 200 - rng.randrange(15)]))
    docs = [*chain, *near, *near[:20], *far, " ".join(hub)]
    got = ngram_join.ngram_jaccard_join(frame(spark, docs), 4, 85)
    assert sorted(map(tuple, got.collect())) == sorted(ngram_join.brute_force(list(enumerate(docs))))


def test_ngram_join_edges(spark):
    assert ngram_join.ngram_jaccard_join(empty(spark)).count() == 0
    t = sentence(30)
    rows = spark.createDataFrame([(None, t, "", "", ""), (5, t, "", "", ""), (5, t, "", "", ""), (7, "other words entirely here now", "", "", ""), (7, t, "", "", "")], DOCS)
    got = Counter((r.doc_id, r.component_id) for r in ngram_join.ngram_jaccard_join(rows).collect())
    assert got == Counter({(5, 5): 2, (7, 5): 2, (None, 5): 1})


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 20)] + [(40, 41), (42, 41), (50, 50)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert all(got[i] == 0 for i in range(1, 21)) and got[41] == got[42] == 40
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# 2 ----------------------------------------------------------------------------------------------------------------------


def items(texts):
    return [(1, texts[0]), (2, " ".join((texts[3] or "").split()[:20]).upper()), (3, "one"), (4, ""), (5, None), (6, "a-b c"), (10, sentence(40)), (2, "w1 w2 w3")]


def test_decontaminate(spark, texts):
    tests = items(texts)
    bench = spark.createDataFrame(tests, "item_id long, text string")
    for size in (8 << 20, 200):  # in one block, and in several that one stage searches
        got = decontaminate.decontaminate(frame(spark, texts), bench, block_bytes=size)
        assert got._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
        rows = [(r.doc_id, r.n_words, r.n_hit, r.n_items, hashlib.sha256(",".join(r["items"]).encode()).hexdigest(), r.contaminated) for r in got.collect()]
        assert sorted(rows) == sorted(map(tuple, decontaminate.brute_force(list(enumerate(texts)), tests)))


def test_decontaminate_edges(spark, texts):
    none = spark.createDataFrame([], "item_id long, text string")
    out = decontaminate.decontaminate(frame(spark, texts), none)
    assert out.where("contaminated OR n_hit > 0").count() == 0 and {"lang", "source", "extra"} <= set(out.columns)
    bench = spark.createDataFrame([(1, sentence(40)), (None, "x y")], "item_id long, text string")
    text = bench.first().text
    inside = f"{sentence(10)} {' '.join(text.split()[3:30])} {sentence(5)}"
    r = decontaminate.decontaminate(frame(spark, [inside, None]), bench).orderBy("doc_id").collect()
    assert (r[0].n_hit, r[0].longest_match, r[0].hit_spans) == (27, 27, [[10, 37]]) and (r[1].n_words, r[1].contaminated) == (0, False)
    assert [tuple(m) for m in r[0].matches] == [("1", 10, 3, 27)]
    with pytest.raises(ValueError, match="n_hit"):
        decontaminate.decontaminate(frame(spark, [inside]).withColumn("n_hit", F.lit(1)), bench)
    assert decontaminate.decontaminate(empty(spark), bench).count() == 0


# 3 ----------------------------------------------------------------------------------------------------------------------


def plain_dedup(docs):
    groups = {}
    for d, t in docs:
        groups.setdefault("".join(c for c in t or "" if c not in " \t\n\x0b\f\r"), []).append((-len(t or ""), d))
    return sorted((d, min(g)[1], len(g), d == min(g)[1], hashlib.sha256(n.encode()).hexdigest()) for n, g in groups.items() for _, d in g)


def test_exact_dedup(spark, texts):
    docs = [*texts, "o n\te", "o\u00a0ne", "on e "]
    got = exact_dedup.exact_dedup(frame(spark, docs).repartition(5), max_files=2)
    assert sorted(map(tuple, got.collect())) == plain_dedup(list(enumerate(docs)))


def test_exact_dedup_checks_bytes(spark, texts):
    """With a digest that collides the texts themselves decide."""
    got = exact_dedup.exact_dedup(frame(spark, texts), digest=lambda t: F.substring(F.sha2(t, 256), 1, 1))
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in got.collect()) == [x[:4] for x in plain_dedup(list(enumerate(texts)))]


@pytest.mark.parametrize("digits", [64, 1])
def test_exact_dedup_goes_on(spark, texts, digits):
    """Two arrivals in one state folder give the verdicts of all documents at once; with one digit digests collide."""
    digest = lambda t: F.substring(F.sha2(t, 256), 1, digits)
    folder, docs = shared_folder(spark), [*texts[::2], *texts[::-1], "o n e ", "w1 w2"]
    rows = frame(spark, docs)
    first = exact_dedup.exact_dedup(rows.where("doc_id % 3 = 0"), digest=digest, folder=folder)
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in first.collect()) == [x[:4] for x in plain_dedup([(i, t) for i, t in enumerate(docs) if i % 3 == 0])]
    later = exact_dedup.exact_dedup(rows.where("doc_id % 3 > 0"), digest=digest, folder=folder)
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in later.collect()) == [x[:4] for x in plain_dedup(list(enumerate(docs)))]


def test_exact_dedup_splits_repeated_ids(spark):
    """Rows are told apart by their places: an id that repeats with other texts under one digest is counted once a row."""
    rows = spark.createDataFrame([(1, "a", "", "", ""), (1, "b", "", "", ""), (2, "a", "", "", ""), (1, "b", "", "", "")], DOCS)
    got = exact_dedup.exact_dedup(rows, digest=lambda t: F.lit("x"))
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.kept) for r in got.collect()) == Counter({(1, 1, 2, True): 3, (2, 1, 2, False): 1})


def test_exact_dedup_reads_keepers_by_their_place(spark, sf):
    """The state's locators are files and rows of the input."""
    folder = shared_folder(spark)
    exact_dedup.exact_dedup(spark.read.parquet(f"{sf}/documents.parquet"), folder=folder).count()
    records = spark.read.parquet(f"{folder}/records/*").collect()
    assert all(r.locator.split("#")[0].endswith("documents.parquet") for r in records) and sorted(int(r.locator.split("#")[1]) for r in records) == list(range(len(records)))


def verdicts(df):
    return sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in df.collect())


def test_exact_dedup_of_derived_rows(spark, tmp_path):
    """Rows that come from files through explode, a join or an expression are not rows of those files."""
    spark.createDataFrame([(0, ["a b", "ab", "c"], "x"), (10, ["c", "d"], "X")], "base long, parts array<string>, name string").coalesce(1).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    exploded = df.select("base", F.posexplode("parts").alias("at", "text")).select((F.col("base") + F.col("at")).alias("doc_id"), "text")
    want = [x[:4] for x in plain_dedup([(0, "a b"), (1, "ab"), (2, "c"), (10, "c"), (11, "d")])]
    assert verdicts(exact_dedup.exact_dedup(exploded)) == want
    joined = df.join(spark.createDataFrame([(0, 1), (0, 2), (10, 3)], "base long, doc_id long"), "base").select("doc_id", F.col("name").alias("text"))
    assert verdicts(exact_dedup.exact_dedup(joined)) == [x[:4] for x in plain_dedup([(1, "x"), (2, "x"), (3, "X")])]
    lower = df.select(F.col("base").alias("doc_id"), F.lower("name").alias("text"))
    assert verdicts(exact_dedup.exact_dedup(lower)) == [x[:4] for x in plain_dedup([(0, "x"), (10, "x")])]
    with pytest.raises(ValueError, match="_metadata"):
        exact_dedup.exact_dedup(lower.withColumn("_metadata", F.lit(1)))


def test_exact_dedup_goes_on_with_derived_and_renamed_texts(spark, tmp_path):
    """Each arrival is compared with what earlier ones took as text, from whatever column."""
    for k, rows in enumerate([[(1, "AB", "q"), (2, "cd", "r")], [(3, "ab", "cd"), (4, "xy", "zz")], [(5, "aB", "longer  "), (6, "x y", "q")]]):
        spark.createDataFrame(rows, "id long, body string, other string").coalesce(1).write.parquet(f"{tmp_path}/{k}")
    folder, read = shared_folder(spark), lambda k: spark.read.parquet(f"{tmp_path}/{k}")
    digest = lambda t: F.lit("one")  # noqa: E731  all meet under one digest, so that bytes decide
    exact_dedup.exact_dedup(read(0).select("id", F.lower("body").alias("text")), "id", digest=digest, folder=folder)
    exact_dedup.exact_dedup(read(1), "id", "other", digest=digest, folder=folder)
    out = exact_dedup.exact_dedup(read(2).select("id", "body"), "id", "body", digest=digest, folder=folder)
    assert verdicts(out) == [x[:4] for x in plain_dedup([(1, "ab"), (2, "cd"), (3, "cd"), (4, "zz"), (5, "aB"), (6, "x y")])]


def test_exact_dedup_edges(spark):
    assert exact_dedup.exact_dedup(empty(spark)).count() == 0
    rows = spark.createDataFrame([(None, "a", "", "", ""), (3, "a ", "", "", ""), (3, "a ", "", "", "")], DOCS)
    assert Counter((r.doc_id, r.keep_id, r.kept) for r in exact_dedup.exact_dedup(rows).collect()) == Counter({(3, 3, True): 2, (None, 3, False): 1})


# 4 ----------------------------------------------------------------------------------------------------------------------

PII = [
    "mail a.b@c.de, x@y.co.uk. or u@nowhere and é@x.org a@b.c_d@e.f @z.q",
    "1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8.9 001.02.3.255 1.2.3 99999999999.1.1.1",
    "4111 1111 1111 1111, 4111-1111-1111-1112 and 378282246310005 5 12 4111111111111111111111",
    "+49 (0)30 1234567-8). +1 23 +123456789012345678 ++44 20 7946 0958 +9",
    None, "", "+" * 300, "a" * 3000 + "@", "1" * 5000, "1." * 2000, "+1" * 2000, "x@a." * 500, "Ünï +33 1 22 33 44 55 cödé a@ü.de",
]


def test_pii_base_spans(spark):
    got = pii.sanitise(frame(spark, PII)).select("doc_id", *[F.size(F.filter("base", f)).alias(k) for k, f in {k: (lambda k: lambda s: s["kind"] == k)(k) for k in pii.KINDS}.items()], pii.span_text(F.col("base")).alias("spans"))
    assert sorted(map(tuple, got.collect())) == sorted(pii.brute_force(list(enumerate(PII))))


def test_pii_masks_terms_that_disclose(spark):
    places = ["office", "harbour", "garden", "station", "library"]
    docs = [f"The {p} of Zorblax can be reached at z@corp.example or so, said the {p} keeper number {i}" for i, p in enumerate(places)]
    docs += [f"nothing here, only the {p} and some words about number {i}" for i, p in enumerate(places * 20)]
    docs += [docs[5] + " w@other.example"]
    out = {r.doc_id: r for r in pii.sanitise(frame(spark, docs), with_text=True).collect()}
    assert "Zorblax" not in out[0].text_clean and "[TERM]" in out[0].text_clean and "[EMAIL]" in out[0].text_clean and "office" in out[0].text_clean
    assert out[5].text_clean == docs[5] and out[5].spans == [] and [s.kind for s in out[len(docs) - 1].spans] == ["email"]
    copies = pii.sanitise(frame(spark, [docs[0]] * 30 + docs[5:])).where("size(spans) > size(base)")
    assert copies.count() == 0  # copies of one passage are no evidence


def plain_entities(kind, value):
    digits = re.sub("[^0-9]", "", value)
    of = {"email": value.split("@")[-1], "ip": ".".join(value.split(".")[:2]), "card": digits[:6], "phone": digits[:4]}[kind]
    return {(kind, "value", value), (kind, "class", of), (kind,)}


def plain_disclosing(docs, threshold=0.5, least=3, level=0.05):
    """{text: masked terms}, counting distinct texts."""
    held, words_of = {}, {}
    for t in {t or "" for t in docs}:
        spans = [(k, int(a), int(b)) for k, a, b in (x.split(":") for x in pii.brute_force([(0, t)])[0][5].split(",") if x)]
        held[t] = {e for k, a, b in spans for e in plain_entities(k, t[a:b].lower())}
        outside = "".join(" " if any(a <= i < b for _, a, b in spans) else c for i, c in enumerate(t))
        words_of[t] = set(re.findall(r"[^\W\d_]{3,}", outside.lower()))
    n, d_e, d_t = len(held), Counter(e for t in held for e in held[t]), Counter(w for t in held for w in words_of[t])
    both = Counter((e, w) for t in held for e in held[t] for w in words_of[t])
    chars, of = sum(map(len, held)), Counter()
    for t in held:
        of.update({e: len(t) for e in held[t]})
    under = {e for e in d_e if least <= d_e[e] < n}
    pairs = len(under) * len({w for t in held if held[t] & under for w in words_of[t]})

    def surely(e, w, c):
        p, share = c / d_t[w], of[e] / chars
        return p > share > 0 and d_t[w] * (p * math.log(p / share) + ((1 - p) * math.log((1 - p) / (1 - share)) if p < 1 else 0)) >= math.log(pairs / level)

    told = {(e, w) for (e, w), c in both.items() if c >= least and d_e[e] < n and math.log2(n * c / (d_e[e] * d_t[w])) >= threshold * math.log2(n / d_e[e]) and surely(e, w, c)}
    return {t: {w for e in held[t] for w in words_of[t] if (e, w) in told} for t in held}


def test_pii_masks_no_chance_words(spark, sf):
    """With personal data dealt at random among the texts, no term discloses it."""
    chance = random.Random(12)
    texts = sorted({r.text for r in spark.read.parquet(f"{sf.replace('sf0.001', 'sf0.01')}/documents.parquet").collect() if r.text and not any(pii.brute_force([(0, r.text)])[0][1:5])})
    marked = set(chance.sample(range(len(texts)), 60))
    docs = [t + chance.choice([" a.b@corp.example", " 10.1.2.3", " +49 30 1234 5678"]) if i in marked else t for i, t in enumerate(texts)]
    assert pii.sanitise(frame(spark, docs)).where("size(spans) > size(base)").count() == 0


def test_pii_long_text(spark):
    """10,000 spans in a text take time in proportion; spans and text come out right."""
    text = "".join(f"w{i} a{i}@b.example " for i in range(10_000))
    out = pii.sanitise(frame(spark, [text]), with_text=True).first()
    assert len(out.base) == 10_000 and [(s.start, s.end) for s in out.base[-2:]] == [m.span() for m in list(re.finditer(r"\S+@\S+", text))[-2:]]
    assert out.text_clean == "".join(f"w{i} [EMAIL] " for i in range(10_000))


def test_pii_counts_whole_documents(spark):
    """Terms far from the entity count, in all documents that they share with it; equal texts count once."""
    far = " ".join(VOCABULARY[:60])
    docs = [f"Zorblax came early. {far} {i}. Write to z@corp.example, it said. {sentence(40)} Quuxly" for i in range(15)]
    docs += [f"Near Plugh z@corp.example {sentence(30)}" if i < 3 else f"z@corp.example {sentence(30)} plugh" for i in range(6)]
    docs += [f"{'天' * 50}a{i}@b.example{'天' * 50}" for i in range(4)]
    docs += [f"{'語' * 50}x@y.example{'語' * 50} {i}" for i in range(4)]
    docs += ["Twice told by q@r.example"] * 9 + [sentence(30) for _ in range(200)] + [None, ""]
    docs += docs[:5] + docs[:2]
    frame_ = spark.createDataFrame([(None if i % 7 == 0 else i % 90, t, "", "", "") for i, t in enumerate(docs)], DOCS)
    want = plain_disclosing(docs)
    assert "zorblax" in want[docs[0]] and "語" * 50 in want[docs[25]] and not want["Twice told by q@r.example"]
    rows = Counter((r.doc_id, tuple((s.kind, s.start, s.end) for s in r.spans)) for r in pii.sanitise(frame_).collect())
    assert rows == Counter((None if i % 7 == 0 else i % 90, plain_spans(t or "", want)) for i, t in enumerate(docs))


def plain_spans(t, want):
    base = [(a, pii.KINDS.index(k), b, k) for k, a, b in ((k, int(a), int(b)) for k, a, b in (x.split(":") for x in pii.brute_force([(0, t)])[0][5].split(",") if x))]
    terms = [(m.start(), 9, m.end(), "term") for m in re.finditer(r"[^\W\d_]{3,}", t) if m[0].lower() in want[t]]
    return tuple((k, a, b) for a, _, b, k in sorted(base + terms))


def test_pii_query_against_plain_version(spark, sf):
    """The registered query masks the terms that a plain count finds in the given documents."""
    docs = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = plain_disclosing([t for _, t in docs])
    got = {r.doc_id: r.spans for r in queries()["op4_pii"](spark, sf).collect()}
    assert got == {d: ",".join(f"{k}:{a}:{b}" for k, a, b in plain_spans(t, want)) for d, t in docs}


def test_pii_edges(spark):
    assert pii.sanitise(empty(spark)).count() == 0
    rows = spark.createDataFrame([(None, "a@b.c", "", "", ""), (1, "a@b.c", "", "", ""), (1, "a@b.c", "", "", "")], DOCS)
    assert Counter(r.doc_id for r in pii.sanitise(rows, with_text=True).where("text_clean = '[EMAIL]'").collect()) == Counter({1: 2, None: 1})


# 5 ----------------------------------------------------------------------------------------------------------------------


def test_language_id(spark, sf):
    out = queries()["op5_language_id"](spark, sf)
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = out.collect()
    test = [r for r in rows if r.held_out]
    assert len(rows) == len(lang) and sum(lang[r.doc_id] == r.lang_pred for r in test) >= 0.95 * len(test)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)


def test_language_id_edges(spark):
    rows = [(i, ("the cat sat on the mat " if i % 2 else "le chat est sur la table ") * 3, "en" if i % 2 else "fr", "s", "x") for i in range(60)]
    odd = [(100, None, "en", "", ""), (101, "12 34 !!", None, "", ""), (None, "the cat", "en", "", ""), (102, "LE CHAT EST LÀ", None, "", ""), (103, "日本", None, "", "")]
    docs = spark.createDataFrame([*rows, *odd], DOCS)
    got = {r.doc_id: r for r in language_id.identify(docs).collect()}
    assert got[100].lang_pred == got[101].lang_pred == "und" and got[102].lang_pred == "fr" and got[None].lang_pred == "en" and got[103].lang_pred in ("en", "fr")
    assert got[None].held_out is False
    und = language_id.identify(docs.union(spark.createDataFrame([(104, "½ ² Ⅳ 12", None, "", "")], DOCS))).where("doc_id = 104").first()
    assert (und.lang_pred, und.score) == ("und", 0.0)  # numbers are no letters
    unlabelled = language_id.identify(docs.withColumn("lang", F.lit(None).cast("string")))
    assert unlabelled.where("lang_pred <> 'und'").count() == 0 and language_id.identify(empty(spark)).count() == 0


def test_language_id_sees_only_text(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = language_id.fit(docs.where("lang IS NOT NULL").select(F.col("doc_id").cast("string").alias("key"), "lang", "text"))
    a = language_id.predict(docs.select("doc_id", "text"), model).collect()
    b = language_id.predict(docs.select((F.col("doc_id") * 7).alias("doc_id"), "text"), model).collect()
    assert sorted((r.doc_id * 7, r.lang_pred, r.score) for r in a) == sorted(map(tuple, [(r.doc_id, r.lang_pred, r.score) for r in b]))


# 6 ----------------------------------------------------------------------------------------------------------------------


def test_communication_matrix():
    m = sharding.communication_matrix([5, 0, 7], [4, 4, 4], 1)
    assert m.sum(axis=1).tolist() == [5, 0, 7] and m.sum(axis=0).tolist() == [4, 4, 4]
    cell = Counter(int(sharding.communication_matrix([3, 3], [3, 3], s)[0, 0]) for s in range(4000))
    for k, p in {0: 1 / 20, 1: 9 / 20, 2: 9 / 20, 3: 1 / 20}.items():
        assert abs(cell[k] / 4000 - p) < 0.03


def test_hypergeometric_of_any_size():
    import numpy as np

    rng = np.random.default_rng(1)
    got = Counter(sharding.hypergeometric(rng, 5, 7, 6) for _ in range(20_000))
    for k in range(6):
        assert abs(got[k] / 20_000 - math.comb(5, k) * math.comb(7, 6 - k) / math.comb(12, 6)) < 0.015
    big = np.array([sharding.hypergeometric(rng, 10**12, 3 * 10**12, 40_000) for _ in range(2000)])
    assert abs(big.mean() - 10_000) < 10 and abs(big.std() - 7500**0.5) < 5
    m = sharding.communication_matrix([4 * 10**9, 10**9 + 5], [10**9 + 1, 10**9 + 1, 10**9 + 1, 2 * 10**9 + 2], 3)
    assert m.sum(axis=1).tolist() == [4 * 10**9, 10**9 + 5] and m.sum(axis=0).tolist() == [10**9 + 1, 10**9 + 1, 10**9 + 1, 2 * 10**9 + 2]


def test_shards_place_equal_rows_one_by_one(spark):
    """Equal rows are spread over the partitions, and each assignment of three rows to three shards comes up."""
    same = spark.createDataFrame([(None, 5)] * 600, "doc_id long, size long").repartition(3)
    got = sharding.shard_rows(same, 4, rows_per_task=50).collect()
    assert sorted(Counter(r.shard for r in got).values()) == [150] * 4 and all(sorted(r.slot for r in got if r.shard == s) == list(range(150)) for s in range(4))
    for name in ("shard", "slot"):
        with pytest.raises(ValueError, match=name):
            sharding.shard_rows(same.withColumn(name, F.lit(1)), 4)


def test_shard_query_against_plain_laws(spark, sf):
    """The registered query: each document once, its own size and checksum, counts one apart, slots without gaps."""
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries()["op6_uniform_shards"](spark, sf).collect()
    assert {r.doc_id: (r.size, r.text_crc32) for r in got} == {d: (len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in docs.items()} and len(got) == len(docs)
    n = Counter(r.shard for r in got)
    assert set(n) == set(range(16)) and max(n.values()) - min(n.values()) <= 1 and all(sorted(r.slot for r in got if r.shard == s) == list(range(n[s])) for s in n)
    assert {(r.law, r.grown_shard) for r in got} == {("rows", None)}


def test_shards(spark):
    rows = spark.range(1003).select(F.col("id").alias("doc_id"), (F.col("id") % 7).alias("size"))
    seen = set()
    for seed in (1, 2):
        got = sharding.shard_rows(rows, 16, seed, rows_per_task=50).collect()
        n = Counter(r.shard for r in got)
        assert set(n.values()) == {62, 63} and len({r.doc_id for r in got}) == 1003
        assert all(sorted(r.slot for r in got if r.shard == s) == list(range(n[s])) for s in n)
        seen.add(tuple(r.doc_id for r in sorted(got, key=lambda r: (r.shard, r.slot))))
    assert len(seen) == 2
    same = sharding.shard_rows(rows, 16, 1, rows_per_task=50).collect()
    assert tuple(r.doc_id for r in sorted(same, key=lambda r: (r.shard, r.slot))) in seen


def test_shards_edges(spark):
    assert sharding.shard_rows(spark.range(0).toDF("doc_id"), 4).count() == 0
    same = sharding.shard_rows(spark.createDataFrame([(None,)] * 9 + [(1,)], "doc_id long"), 4).collect()
    assert sorted(Counter(r.shard for r in same).values()) == [2, 2, 3, 3] and len({(r.shard, r.slot) for r in same}) == 10


# 7 ----------------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("window", [50, 12])
def test_substring_dedup(spark, texts, window):
    got = substring_dedup.substring_dedup(frame(spark, texts).repartition(3), window, gram=min(10, window // 2))
    w = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    rows = got.collect()
    for r in rows:  # factors are copies from smaller documents, in order, and make up what is removed
        assert sum(f.words for f in r.factors) == r.n_removed and all(f.ref < r.doc_id for f in r.factors)
        assert all(w[r.doc_id][f.start : f.start + f.words] == w[f.ref][f.ref_start : f.ref_start + f.words] for f in r.factors)
        assert all(a.start + a.words <= b.start for a, b in zip(r.factors, r.factors[1:], strict=False))
    assert max(f.words for r in rows for f in r.factors) > 2 * window  # one factor, not many windows
    assert sorted(map(tuple, got.drop("factors").collect())) == sorted(substring_dedup.brute_force(list(enumerate(texts)), window))


def test_substring_dedup_text_and_edges(spark):
    a, b = sentence(60), sentence(30)
    docs = spark.createDataFrame([(1, a, "", "", ""), (2, f"{b}\t{a}\n end", "", "", ""), (2, f"{b} {a}", "", "", ""), (None, a, "", "", "")], DOCS)
    got = Counter((r.doc_id, r.n_removed, r.kept_text) for r in substring_dedup.substring_dedup(docs, with_text=True).collect())
    assert got == Counter({(1, 0, a): 1, (2, 60, f"{b} end"): 1, (2, 60, b): 1, (None, 60, ""): 1})
    assert substring_dedup.substring_dedup(empty(spark)).count() == 0


# 8 ----------------------------------------------------------------------------------------------------------------------


def check_packing(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    return len(by)


def test_packing(spark, texts):
    from tokenizers import Tokenizer

    path = packing.tokenizer_path()
    tok = Tokenizer.from_file(path)
    odd = ["  two  spaces ", "a\n\n b\u00a0c", "né à où", "tab\t x", " lead", "trail ", "日本 語", "it's we'll  \n", "<|endoftext|>", "a <|endoftext|><|endoftext|> b<|endoftext|>c <|endof", "text|>"]
    docs = [*texts, *odd, sentence(3000)]
    rows = packing.best_fit_pack(frame(spark, docs), path, with_ids=True).collect()
    n = check_packing(rows, 1024)
    assert n <= -(-sum(r.length for r in rows) // 1024) + 4 * spark.sparkContext.defaultParallelism
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    for i, t in enumerate(docs):
        mine = sorted(by[i], key=lambda r: r.piece)
        ids = b"".join(bytes(r.ids) for r in mine)
        want = [*tok.encode(t or "", add_special_tokens=False).ids, 2]
        assert ids == b"".join(x.to_bytes(4, "little") for x in want)
        assert [r.piece for r in mine] == list(range(len(mine))) and [r.start for r in mine] == [sum(m.length for m in mine[:k]) for k in range(len(mine))]
        assert all(r.length == 1024 for r in mine[1:]) and (len(mine) == 1) == (len(want) <= 1024)
        assert all(r.ids_crc32 == zlib.crc32(bytes(r.ids)) for r in mine)


def test_bounded_best_fit():
    fit = packing.BestFit(10, 2)
    assert fit.place(6) == (0, 0) and fit.place(7) == (1, 0)
    assert fit.place(3) == (1, 7)  # the tightest bin
    assert fit.place(5) == (2, 0) and fit.open == 2
    assert fit.place(8) == (3, 0) and fit.open == 2  # the fullest closed: the new one itself
    assert fit.place(4) == (0, 6)
    assert packing.cut(2500, 1024) == [(0, 452), (452, 1024), (1476, 1024)] and packing.cut(1024, 1024) == [(0, 1024)]


def test_packing_edges(spark):
    path = packing.tokenizer_path()
    assert packing.best_fit_pack(empty(spark), path).count() == 0
    with pytest.raises(ValueError, match="offset"):
        packing.pack(spark.createDataFrame([(1, 2)], "length bigint, offset bigint"))
    rows = packing.best_fit_pack(spark.createDataFrame([(None, None, "", "", ""), (1, "a", "", "", ""), (1, "a", "", "", "")], DOCS), path).collect()
    assert sorted((r.doc_id or 0, r.length) for r in rows) == [(0, 1), (1, 2), (1, 2)]


# 9 ----------------------------------------------------------------------------------------------------------------------


def test_host_path_and_rules(spark):
    urls = ["HTTP://A.B.Example.ORG/es/x?q#f", "https://org", "https://org/", "x://example.org/en/1?a", "http://www.com/fr/1", "http://com/de/", "no scheme", None, "://h?x=/y", "a://b://c/d", "http://xcom/de/", "http://u@H.com:80/de/"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_rules.url_filter(df, spark.createDataFrame([], "url string, bad boolean")).collect()}
    assert got == {
        0: ("a.b.example.org", "/es/x", "example.org/es/", "block"), 1: ("org", "", None, "allow"), 2: ("org", "/", "org/", "allow"), 3: ("example.org", "/en/1", "example.org/en/1", "block"),
        4: ("www.com", "/fr/1", "com/fr/", "allow"), 5: ("com", "/de/", "com/de/", "block"), 6: ("", "", None, "allow"), 7: ("", "", None, "allow"), 8: ("h", "", None, "allow"),
        9: ("b:", "//c/d", None, "allow"), 10: ("xcom", "/de/", None, "allow"), 11: ("u@h.com:80", "/de/", None, "allow"),
    }


def test_mined_rules(spark):
    rows = []
    for i in range(300):
        host, path, bad = rng.choice([("spam.net", "buy", True), ("spam.net", "about", False), ("good.net", "buy", False), ("good.net", "about", False)])
        rows.append((i, f"http://{host}/{path}/{i}", bad))
    df = spark.createDataFrame(rows, "page_id long, url string, bad boolean")
    mined = url_rules.mine(df.select(url_rules.tokens(F.col("url")).alias("items"), "bad"), confidence=0.9).collect()
    assert mined and all({"host=spam", "path=buy"} <= set(r["items"]) and r.confidence == 1.0 for r in mined)
    assert all(not (set(a["items"]) < set(b["items"])) for a in mined for b in mined)
    got = url_rules.url_filter(df.select("page_id", "url"), df.select("url", "bad"), confidence=0.9).collect()
    assert {r.page_id for r in got if r.verdict == "block"} == {r[0] for r in rows if r[2]}


def plain_tokens(url):
    if url is None:
        return set()
    rest = url.split("://", 1)[1] if "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    query = re.match(r"[^#]*?\?([^#]*)", url)
    out = {f"host={x}" for x in host.lower().split(".") if x} | {f"path={x}" for x in re.sub("[0-9]+", "#", path).split("/") if x}
    return out | {f"query={x.split('=')[0]}" for x in (query[1] if query else "").split("&") if x.split("=")[0]} | {f"scheme={url.split('://')[0]}"}


def plain_rules(labelled, support=0.01, confidence=0.5, lift=1.5, z=3.29):
    """The rules' items, by counting every combination that a labelled URL holds; items that the same URLs hold stand together."""
    from itertools import combinations

    n, bad_rate, held, bad_held, where = len(labelled), sum(b for _, b in labelled) / len(labelled), Counter(), Counter(), {}
    for i, (url, bad) in enumerate(labelled):
        items = sorted(plain_tokens(url))
        for x in items:
            where.setdefault(x, set()).add(i)
        for k in range(1, len(items) + 1):
            held.update(combinations(items, k))
            bad_held.update(combinations(items, k) if bad else ())
    least = lambda p, m: (p + z * z / (2 * m) - z * math.sqrt(p * (1 - p) / m + z * z / (4 * m * m))) / (1 + z * z / m)
    found = {x: c / held[x] for x, c in bad_held.items() if c >= support * n and c / held[x] >= confidence and least(c / held[x], held[x]) >= lift * bad_rate}
    kept = [x for x, c in found.items() if not any(found.get(y, -1) >= c for k in range(1, len(x)) for y in combinations(x, k))]
    return {frozenset(y for i in x for y, at in where.items() if at == where[i]) for x in kept}


def test_url_query_against_plain_version(spark, sf):
    """The registered query's verdicts, where no given rule fits, are those of rules that plain counting finds."""
    sf = sf.replace("sf0.001", "sf0.01")  # fewer pages leave no rule beyond chance
    pages = spark.read.parquet(f"{sf}/pages.parquet").collect()
    marks = {r.doc_id: r.quality == 0 or r.toxic == 1 for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = {r.page_id: r for r in queries()["op9_url_rules"](spark, sf).collect()}
    labelled = [(r.url, got[r.page_id].verdict == "block" if got[r.page_id].rule else marks[r.page_id]) for r in pages if got[r.page_id].rule or r.page_id in marks]
    rules = plain_rules(labelled)
    free = [r for r in pages if not got[r.page_id].rule]
    assert {r.page_id: got[r.page_id].verdict for r in free} == {r.page_id: "block" if any(set(x) <= plain_tokens(r.url) for x in rules) else "allow" for r in free}
    assert len(got) == len(pages) and rules


def test_rules_of_templates(spark):
    """A template of 30 segments is one item of the search, and a rule holds it whole."""
    template = "/".join(f"seg{'abcdefghij'[i % 10] * (1 + i // 10)}" for i in range(30))
    rows = [(f"http://a.net/{template}/{i}", True) for i in range(100)] + [(f"http://b.net/x/{'uvwxyz'[i % 6]}/{i}", i % 4 == 0) for i in range(300)]
    df = spark.createDataFrame([*rows, (None, True), ("http://c", None)], "url string, bad boolean")
    mined = url_rules.mine(url_rules.baskets(df)).collect()
    assert {frozenset(r["items"]) for r in mined} == plain_rules_of_template(template)
    assert all(r.confidence == 1.0 and abs(r.support - 0.25) < 1e-9 for r in mined)


def plain_rules_of_template(template):
    return {frozenset([f"path={x}" for x in template.split("/")] + ["host=a"])}


def test_no_rules_by_chance(spark):
    """Labels that have nothing to do with the URLs give no rules; a few pages of one kind are not enough."""
    chance = random.Random(8)
    rows = [(f"http://h{'abcdefgh'[i % 8]}.net/{'klmnopqrst'[chance.randrange(10)]}/{'uvwxyz'[chance.randrange(6)]}?{'efgh'[chance.randrange(4)]}=1", chance.random() < 0.25) for i in range(600)]
    df = spark.createDataFrame(rows, "url string, bad boolean")
    assert url_rules.mine(url_rules.baskets(df)).count() == 0


def test_match_is_exact(spark):
    urls = spark.createDataFrame([("u1", ["a", "b"]), ("u2", ["a"]), ("u3", ["b", "c", "a"]), ("u4", [])], "url string, items array<string>")
    rules = spark.createDataFrame([(1, ["a", "b"]), (2, ["c"]), (3, ["z"])], "rule_id long, items array<string>")
    assert sorted(r.url for r in url_rules.match(urls, rules).collect()) == ["u1", "u3"]


# 10 ---------------------------------------------------------------------------------------------------------------------

CHANGES = "op string, source string, lang string, tokenizer string, n_tokens bigint, old_source string, old_lang string, old_tokenizer string, old_n_tokens bigint"


def test_rollup(spark):
    roll = token_rollup.TokenRollup(spark, shared_folder(spark))
    first = [("insert", "a", "en", "v1", 10, None, None, None, None), ("insert", "a", "en", "v1", 5, None, None, None, None), ("insert", None, "fr", "v1", 7, None, None, None, None)]
    roll.commit("1", spark.createDataFrame(first, CHANGES))
    second = spark.createDataFrame([("delete", "a", "en", "v1", 5, None, None, None, None), ("revise", "b", "en", "v2", 12, "a", "en", "v1", 10)], CHANGES)
    for _ in range(3):
        roll.commit("2", second)
    assert {(r.source, r.lang, r.tokenizer): (r.docs, r.tokens) for r in roll.totals().collect()} == {(None, "fr", "v1"): (1, 7), ("b", "en", "v2"): (1, 12)}
    with pytest.raises(Exception, match="not a kind of change"):
        roll.commit("3", spark.createDataFrame([("upsert", "a", "en", "v1", 5, None, None, None, None)], CHANGES))
    with pytest.raises(ValueError):
        roll.commit("../x", second)
    assert roll.totals().count() == 2 and set(roll.manifest()["batches"]) == {"1", "2"}
    roll.compact()
    version = roll.manifest()["version"]
    roll.commit("2", second.orderBy("n_tokens"))  # closed
    with pytest.raises(ValueError, match="something else"):
        roll.commit("2", second.limit(1))
    assert roll.manifest()["version"] == version
    roll.commit("3", spark.createDataFrame([("insert", "b", "en", "v2", None, None, None, None, None)], CHANGES))
    roll.compact()
    roll.compact()
    assert {(r.source, r.lang, r.tokenizer): (r.docs, r.tokens) for r in roll.totals().collect()} == {(None, "fr", "v1"): (1, 7), ("b", "en", "v2"): (2, 12)}
    from pathlib import Path

    folders = [x.name for x in Path(roll.folder.removeprefix("file:")).iterdir() if x.is_dir()]
    assert folders == [roll.manifest()["base"]] and roll.manifest()["folded"] == ["1", "2", "3"]


def test_rollup_keeps_old_readers_and_refuses_a_second_writer(spark):
    roll = token_rollup.TokenRollup(spark, shared_folder(spark))
    one = spark.createDataFrame([("insert", "a", "en", "v1", 4, None, None, None, None)], CHANGES)
    roll.commit("1", one)
    reader, stale = roll.totals(), roll.manifest()
    roll.compact()
    assert [(r.docs, r.tokens) for r in reader.collect()] == [(1, 4)]
    with pytest.raises(RuntimeError, match="another writer"):
        roll._switch(stale)
    roll.commit("2", one)
    assert roll.totals().first().docs == 2


def test_rollup_replaces_a_batch(spark):
    """A batch that comes again with other rows counts as it came last; an empty rollup has no totals."""
    roll = token_rollup.TokenRollup(spark, shared_folder(spark))
    assert roll.totals().count() == 0
    roll.compact()
    for n in (4, 9):
        roll.commit("1", spark.createDataFrame([("insert", "a", "en", "v1", n, None, None, None, None), ("revise", "a", "en", "v1", 1, None, None, None, None)], CHANGES))
    assert {(r.source, r.docs, r.tokens) for r in roll.totals().collect()} == {("a", 2, 10), (None, -1, 0)}


def test_rollup_of_documents(spark, sf):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.tokenizer_path())
    want: Counter = Counter()
    docs: Counter = Counter()
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        want[r.source, r.lang] += len(tok.encode(r.text or "", add_special_tokens=False).ids)
        docs[r.source, r.lang] += 1
    got = queries()["op10_token_rollup"](spark, sf).collect()
    assert {(r.source, r.lang): (r.tokens, r.docs, r.tokenizer) for r in got} == {k: (want[k], docs[k], "byte_bpe_50k") for k in docs} and len(got) == len(docs)


def test_counts_of_odd_rows(spark):
    rows = spark.createDataFrame([(1, None, None, None, "e"), (2, "", "en", "s", None)], DOCS)
    assert [r.n_tokens for r in token_rollup.token_counts(rows, packing.tokenizer_path()).collect()] == [0, 0]
    assert token_rollup.token_counts(empty(spark), packing.tokenizer_path()).count() == 0


# Whole tables -----------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_sql_twins(spark, sf, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    df = queries()[name](spark, sf)
    cols = sorted(df.columns)
    got = con.execute(oracle_sql()[name])
    names = [x[0] for x in got.description]
    assert sorted(names) == cols
    assert sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str) == sorted((tuple(r[names.index(c)] for c in cols) for r in got.fetchall()), key=str)


@pytest.fixture(scope="module")
def corpus(spark, sf):
    return sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())


def test_whole_table_against_brute_force(spark, sf, corpus):
    q = queries()
    rows = lambda name, *c: sorted(map(tuple, q[name](spark, sf).select(*c).collect()))
    assert rows("op1_ngram_join", "doc_id", "n_shingles", "component_id") == ngram_join.brute_force(corpus)
    assert rows("op7_relative_lz", "doc_id", "n_words", "n_removed", "kept_sha256") == substring_dedup.brute_force(corpus)
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert rows("op2_decontaminate", "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == sorted(map(tuple, decontaminate.brute_force(corpus, bench)))
    want = sorted((*r[:5], hashlib.sha256(r[5].encode()).hexdigest()) for r in pii.brute_force(corpus))
    assert rows("op4_pii", "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256") == want
    n = check_packing(q["op8_best_fit"](spark, sf).collect(), 1024)
    assert n < 400
