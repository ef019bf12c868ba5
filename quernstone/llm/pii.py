"""Personal data and the terms that give it away (operator 4), DataFrame operations only.

Base spans are patterns: email, ip, card, phone.  On top works
information-theoretic sanitisation.  Protected entities are each distinct
value, its class (an email's domain, an address's first two parts, the first
digits of a card or phone number) and its kind.  A term (a word outside all
spans) anywhere in a document that holds an entity discloses it in so far as
their pointwise mutual information over the documents comes close to the
entity's information content,

    PMI(t; e) = log2(N d(e, t) / (d(e) d(t))),   IC(e) = log2(N / d(e)).

N and all d count distinct texts, whole and exactly.  Terms with PMI >=
threshold * IC (by default, that reveal half of what there is to know) that
share enough different texts with the entity (copies of one text count once)
are masked in the documents that hold the entity, if chance does not explain
it: were the d(t) texts of a term dealt by length alone, each would hold the
entity with the probability w(e), the entity's share of all characters, and

    d(t) KL(d(e, t) / d(t) || w(e))

is a sure (Chernoff) bound of how unlikely so many or more are.  It must exceed
ln(pairs / level), so that all pairs of entities and terms together bring a
chance pair with a probability of `level` at most.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, among, shared_folder, small, stash, table

KINDS = ("email", "ip", "card", "phone")
#: The contract's patterns, with possessive repeats and with starts only where a
#: match can begin, so that they take time in proportion to the text.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without this has no match of the kind.
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IP = rf"^{_PART}(?:\.{_PART}){{3}}$"
WORD = r"\p{L}{3,}"
_SPAN = "struct<start:int,ord:int,end:int,kind:string,value:string>"


def _valid(kind: str, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    n = F.length(digits)
    if kind == "ip":
        return match.rlike(IP)
    if kind == "card":
        return n.between(14, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return n.between(10, 15)
    return F.lit(True)


#: Spans that are put together at a time: an array grows by copies, so growing it in blocks keeps long texts linear.
_BLOCK = 256


def _in_blocks(parts: Column, none: Column, step) -> Column:
    """(pos, out) after all parts: step(pos, part) gives the next pos and an array of what comes out, none being an empty one."""

    def block(state: Column, i: Column) -> Column:
        start = F.struct(state["pos"].alias("pos"), none.alias("out"))

        def one(inner: Column, part: Column) -> Column:
            pos, more = step(inner["pos"], part)
            return F.struct(pos.alias("pos"), F.concat(inner["out"], more).alias("out"))

        done = F.aggregate(F.slice(parts, i * _BLOCK + 1, F.lit(_BLOCK)), start, one)
        return F.struct(done["pos"].alias("pos"), F.concat(state["out"], F.array(done["out"])).alias("out"))

    start = F.struct(F.lit(0).alias("pos"), F.slice(F.array(none), 1, 0).alias("out"))
    blocks = F.sequence(F.lit(0), F.floor((F.size(parts) - 1) / _BLOCK).cast("int"))
    return F.aggregate(blocks, start, block, lambda s: F.struct(s["pos"].alias("pos"), F.flatten(s["out"]).alias("out")))


def located(text: Column, pattern: str, matches: Column, kind: str, order: int, keep) -> Column:
    """Matches with their places, from the pieces of text between them."""
    pieces = F.split(text, pattern, -1)
    parts = F.arrays_zip(pieces.alias("before"), matches.alias("match"))
    none = F.array().cast(f"array<{_SPAN}>")

    def step(pos: Column, part: Column) -> tuple[Column, Column]:
        at = pos + F.length(part["before"])
        end = at + F.length(part["match"])
        span = F.struct(at.alias("start"), F.lit(order).alias("ord"), end.alias("end"), F.lit(kind).alias("kind"), part["match"].alias("value"))
        return F.coalesce(end, at), F.when(part["match"].isNotNull() & keep(part["match"]), F.array(span)).otherwise(none)

    return F.when(F.size(matches) > 0, _in_blocks(parts, none, step)["out"]).otherwise(none)


def _short(text: Column) -> Column:
    return F.substring(F.unhex(F.sha2(text, 256)), 1, 16)


def base_spans(docs: DataFrame, text: str) -> DataFrame:
    """docs with `_base`: all valid spans by start and kind; text is a column without nulls."""
    for kind in KINDS:
        all_ = F.regexp_extract_all(text, F.lit(PATTERNS[kind]), 0)
        none = F.array().cast("array<string>")
        docs = docs.withColumn(f"_m_{kind}", F.when(F.col(text).contains(NEEDS[kind]), all_).otherwise(none) if NEEDS[kind] else all_)
    found = [located(F.col(text), PATTERNS[k], F.col(f"_m_{k}"), k, i, lambda m, k=k: _valid(k, m)) for i, k in enumerate(KINDS)]
    return docs.withColumn("_base", F.array_sort(F.concat(*found))).drop(*[f"_m_{k}" for k in KINDS])


def _entities(span: Column) -> Column:
    """What a span's value is protected as: the value, its class and its kind."""
    kind, value = span["kind"], F.lower(span["value"])
    digits = F.regexp_replace(value, "[^0-9]", "")
    of = F.when(kind == "email", F.substring_index(value, "@", -1)).when(kind == "ip", F.substring_index(value, ".", 2)).when(kind == "card", F.substring(digits, 1, 6)).otherwise(F.substring(digits, 1, 4))
    name = lambda level, *x: F.xxhash64(F.lit(13), F.lit(level), kind, *x)
    return F.array(name("value", value), name("class", of), name("kind"))


def _terms(text: str, spans: str) -> Column:
    """The distinct lower-cased words of a text outside its spans."""
    outside = F.when(F.size(spans) > 0, masked(F.col(text), F.col(spans), lambda s: F.lit(" "))).otherwise(F.col(text))
    return F.array_distinct(F.regexp_extract_all(F.lower(outside), F.lit(WORD), 0))


def _once(df: DataFrame, copies: DataFrame) -> DataFrame:
    """Rows of df (key, body, ...) of one key for each text, with `same`, the number of rows that this key has."""
    copies = F.broadcast(copies) if copies.count() <= BROADCAST_ROWS else copies
    return df.join(copies, "body", "left").where("keep IS NULL OR key = keep").withColumn("same", F.coalesce("same", F.lit(1))).drop("keep")


def _texts(df: DataFrame, by: list[str], name: str) -> DataFrame:
    """How many texts each `by` has, from rows of _once: equal rows hold the same, so their number divides the count."""
    return df.groupBy(*by, "same").count().groupBy(*by).agg(F.sum(F.expr("count div same")).alias(name))


def disclosing(rows: DataFrame, base: DataFrame, threshold: float, surroundings: int, folder: str, level: float = 0.05) -> DataFrame:
    """(entity, term) pairs above the threshold.

    rows: key, body (hash of the text) and text.  base: key, body, chars,
    entities, and terms where a text has an entity.

    PMI >= threshold * IC asks for d(e, t) >= d(t) share(e), with share(e) =
    (d(e) / N)^(1 - threshold).  As d(e, t) is at most d(e), and at most the
    texts with an entity that hold t, common terms fall out before they are
    paired; no pair above the threshold is lost, and those left are counted.
    """
    each = base.groupBy("body", "key").agg(F.count("*").alias("count"), F.first("chars").alias("chars"))
    copies = each.groupBy("body").agg(F.min("key").alias("keep"), F.min_by("count", "key").alias("same"), F.sum("count").alias("rows"), F.first("chars").alias("chars"))
    total, chars = copies.agg(F.count("*"), F.coalesce(F.sum("chars"), F.lit(0))).first()
    copies = stash(copies.where("rows > 1").select("body", "keep", "same"), f"{folder}/copies")
    spans = base.select("body", "chars", F.explode("entities").alias("entity"))
    # An entity that is in every text has no content.
    of_entity = spans.distinct().groupBy("entity").agg(F.count("*").alias("with_entity"), (F.sum("chars") / F.lit(float(max(chars, 1)))).alias("weight")).where((F.col("with_entity") >= surroundings) & (F.col("with_entity") < total))
    of_entity = of_entity.withColumn("share", F.pow(F.col("with_entity") / F.lit(float(total)), F.lit(1.0 - threshold)))
    of_entity = stash(of_entity, f"{folder}/entities")
    least_share, most = of_entity.agg(F.min("share"), F.max(F.col("with_entity") / F.col("share"))).first()
    if most is None:
        return of_entity.select("entity", F.lit("").alias("term"))
    mine = spans.join(F.broadcast(of_entity) if of_entity.count() <= BROADCAST_ROWS else of_entity, "entity").select("body", "entity", "with_entity", "weight", "share").distinct()
    mine = stash(mine, f"{folder}/mine")
    bodies = stash(mine.select("body").distinct(), f"{folder}/bodies")
    held = among(_once(base.where(F.size("entities") > 0).select("key", "body", "terms"), copies), bodies, "body")
    held = stash(held.select("body", "same", "terms"), f"{folder}/held").select("body", "same", F.explode("terms").alias("term"))
    shared = stash(_texts(held, ["term"], "at_most"), f"{folder}/shared")
    pairs = of_entity.count() * shared.count()
    shared = shared.where(F.col("at_most") >= surroundings)
    words = base_spans(_once(rows.select("key", "body", "text"), copies), "text").select("same", F.explode(_terms("text", "_base")).alias("term"))
    # Beyond a broadcast the words are counted before they are joined.
    if shared.count() <= BROADCAST_ROWS // 4:
        words = words.join(F.broadcast(shared.select("term")), "term")
    of_term = _texts(words, ["term"], "with_term").join(shared, "term")
    slack = 1 + 1e-9
    of_term = stash(of_term.where((F.col("with_term") <= most * slack) & (F.col("with_term") * least_share <= F.col("at_most") * slack)), f"{folder}/terms")
    pair = held.join(small(of_term), "term").join(mine, "body").where(F.col("with_term") * F.col("share") <= F.least("with_entity", "at_most") * slack)
    both = _texts(pair, ["entity", "term", "with_entity", "weight", "with_term"], "both").where(F.col("both") >= surroundings)
    content = F.log2(F.lit(float(total)) / F.col("with_entity"))
    pmi = F.log2(F.col("both") * F.lit(float(total)) / (F.col("with_entity") * F.col("with_term")))
    p, w = F.col("both") / F.col("with_term"), F.col("weight")
    unlikely = F.col("with_term") * (p * F.ln(p / w) + F.when(p < 1, (1 - p) * F.ln((1 - p) / (1 - w))).otherwise(0.0))
    surely = F.when((w > 0) & (p > w), unlikely >= math.log(max(pairs, 1) / level)).otherwise(False)
    return stash(both.where((pmi >= threshold * content) & surely).select("entity", "term"), f"{folder}/disclosing")


def sanitise(docs: DataFrame, threshold: float = 0.5, surroundings: int = 3, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False, level: float = 0.05) -> DataFrame:
    """One row per document: doc_id, base and spans (start, end, kind, in code points) and, if asked for, text_clean.

    Null texts are empty and have no spans.  Spans of one kind never overlap;
    spans of different kinds may, and text_clean then masks their union under
    the first one's kind.  Terms get the kind ``term``.  Rows with equal id and
    text get equal results.
    """
    spark = docs.sparkSession
    folder = shared_folder(spark)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    # 128 bits of SHA-256 each, so that no two texts can be made to share one.
    rows = rows.withColumn("body", _short(F.col("text"))).withColumn("key", _short(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("doc_id").isNull().cast("string"), "body")))
    facts = F.transform("_base", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    found = base_spans(rows, "text").withColumn("entities", F.array_distinct(F.flatten(F.transform("_base", _entities))))
    terms = F.when(F.size("entities") > 0, _terms("text", "_base")).otherwise(F.array().cast("array<string>"))
    base = stash(found.select("doc_id", "key", "body", facts.alias("base"), "entities", terms.alias("terms"), F.length("text").cast("bigint").alias("chars")), f"{folder}/base")
    told = disclosing(rows, base, threshold, surroundings, folder, level)

    # Documents that hold an entity lose the terms that disclose it.
    held = base.where(F.size("entities") > 0).select("key", "entities", F.explode("terms").alias("term"))
    held = held.join(small(told), "term").where(F.array_contains("entities", F.col("entity")))
    mine = stash(held.groupBy("key").agg(F.collect_set("term").alias("mask")), f"{folder}/mask")
    hit = rows.join(small(mine), "key").dropDuplicates(["key"])
    hit = hit.withColumn("_words", F.regexp_extract_all("text", F.lit(WORD), 0))
    places = located(F.col("text"), WORD, F.col("_words"), "term", len(KINDS), lambda m: F.array_contains("mask", F.lower(m)))
    more = hit.select("key", F.transform(places, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))).alias("more"))

    out = base.select("doc_id", "key", "base").join(more, "key", "left")
    rank = lambda s: F.array_position(F.array(*[F.lit(k) for k in (*KINDS, "term")]), s["kind"])
    every = F.concat("base", F.coalesce("more", F.array().cast("array<struct<start:int,end:int,kind:string>>")))
    by_place = F.transform(F.array_sort(F.transform(every, lambda s: F.struct(s["start"].alias("start"), rank(s).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    out = out.select("doc_id", "key", "base", by_place.alias("spans"))
    if with_text:
        once = out.select("key", "spans").dropDuplicates(["key"])
        return rows.join(once, "key").join(out.select("key", "base").dropDuplicates(["key"]), "key").select("doc_id", "base", "spans", masked(F.col("text"), F.col("spans")).alias("text_clean"))
    return out.drop("key")


def masked(text: Column, spans: Column, mark=lambda s: F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))) -> Column:
    """text with a mark, [KIND], for every span; spans are ordered by start.

    A block of spans works on its own part of the text, as finding a place in a
    text takes time in proportion to the place.
    """
    start = F.struct(F.lit(0).alias("pos"), F.array().cast("array<string>").alias("out"))

    def block(state: Column, i: Column) -> Column:
        some, base = F.slice(spans, i * _BLOCK + 1, F.lit(_BLOCK)), state["pos"]
        end = F.greatest(base, F.array_max(F.transform(some, lambda s: s["end"])))
        part = F.substring(text, base + 1, end - base)

        def one(inner: Column, s: Column) -> Column:
            piece = F.concat(F.substring(part, inner["pos"] - base + 1, s["start"] - inner["pos"]), mark(s))
            out = F.when(s["start"] >= inner["pos"], F.concat(inner["out"], F.array(piece))).otherwise(inner["out"])
            return F.struct(F.greatest(inner["pos"], s["end"]).alias("pos"), out.alias("out"))

        done = F.aggregate(some, F.struct(base.alias("pos"), F.array().cast("array<string>").alias("out")), one)
        return F.struct(done["pos"].alias("pos"), F.concat(state["out"], F.array(F.array_join(done["out"], ""))).alias("out"))

    blocks = F.sequence(F.lit(0), F.floor((F.size(spans) - 1) / _BLOCK).cast("int"))
    whole = F.aggregate(blocks, start, block, lambda s: F.concat(F.array_join(s["out"], ""), F.substring(text, s["pos"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, whole).otherwise(text)


def span_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _of_kind(spans: str, kind: str) -> Column:
    return F.filter(spans, lambda s: s["kind"] == kind)


def op4_pii(spark, sf_dir: str) -> DataFrame:
    out = sanitise(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [F.size(_of_kind("base", k)).cast("bigint").alias(f"n_{k}") for k in KINDS]
    return out.select("doc_id", *counts, F.sha2(span_text(F.col("base")).cast("binary"), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"))


def brute_force(docs: list[tuple]) -> list[tuple]:
    """(doc_id, n_email, n_ip, n_card, n_phone, base spans joined), for tests."""
    import re

    def luhn(d: str) -> bool:
        return sum(x if i % 2 == 0 else (2 * x if x < 5 else 2 * x - 9) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0

    plain = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    good = {
        "email": lambda m, d: True,
        "ip": lambda m, d: all(int(x) <= 255 for x in m.split(".")),
        "card": lambda m, d: 14 <= len(d) <= 19 and luhn(d),
        "phone": lambda m, d: 10 <= len(d) <= 15,
    }
    out = []
    for d, t in docs:
        spans = [(m.start(), i, f"{k}:{m.start()}:{m.end()}") for i, k in enumerate(KINDS) for m in re.finditer(plain[k], t or "") if good[k](m[0], re.sub("[^0-9]", "", m[0]))]
        n = [sum(s[1] == i for s in spans) for i in range(4)]
        out.append((d, *n, ",".join(s[2] for s in sorted(spans))))
    return out
