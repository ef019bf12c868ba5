"""Substring deduplication by relative Lempel-Ziv parsing (operator 7).

The reference is all documents, in blocks.  To index it, every document is cut
into phrases at anchors: the smallest k-gram hash of each window of `window`
words, the last one on ties, so anchors depend on the words alone and fall
alike in every copy of a passage.  A phrase is the run of windows that share an
anchor.  A block holds the phrases of a range of anchor hashes, each once,
under its smallest document and its place there; a document is compared with
every block that holds one of its anchors, and with no other, as equal windows
have equal anchors at equal places.

A phrase that the reference holds under a smaller document is copied as a
whole.  Where one anchor has several different phrases, a factor may end inside
a phrase: there, at the factor boundaries, the single windows are looked up.
Each document is then parsed greedily from left to right: a factor goes on in
the same place of the same reference document for as long as it can.  The words
of factors are removed; they are exactly those of windows that start in a
smaller document.

Words and runs of words are equal if two independent 64-bit hashes under the
run's own key are: one of the anchor, one of the phrase or window.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, NO_ID, shared_folder, stash, table
from .textscan import SPACED, new_key, released, runs, slices, text_bytes, text_digest, windows, word_places, words

GRAM = 10
_PHRASE = "id bigint, version bigint, anchor bigint, phrase bigint, start int, windows int"


def phrases(h: np.ndarray, h2: np.ndarray, first: np.ndarray, window: int, gram: int):
    """Phrases of rows of words: row, first window, count of windows, anchor hash (of one lane), phrase hash (of the other)."""
    none = [np.zeros(0, np.int64)] * 3 + [np.zeros(0, np.uint64)] * 2
    wide = window - gram + 1
    if len(h) < window:
        return none
    keys = windows(h, gram)
    # The last smallest one of each window, by looking from the right.
    views = np.lib.stride_tricks.sliding_window_view(keys[::-1], wide)
    at = np.empty(len(views), np.int64)
    for a in range(0, len(views), 1 << 16):
        at[a : a + (1 << 16)] = views[a : a + (1 << 16)].argmin(axis=1)
    at = (len(keys) - 1 - (np.arange(len(views)) + at))[::-1]
    s = np.arange(len(at))
    row = np.searchsorted(first, s, "right") - 1
    s = s[s + window <= first[row + 1]]
    if not len(s):
        return none
    row, at = row[s], at[s]
    new = np.ones(len(s), bool)
    new[1:] = (at[1:] != at[:-1]) | (row[1:] != row[:-1])
    begin = np.flatnonzero(new)
    count = np.diff(np.append(begin, len(s)))
    start = s[begin]
    phrase = runs(h2, start, start + count - 1 + window)
    phrase ^= (at[begin] - start).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return row[begin], start - first[row[begin]], count, keys[at[begin]], phrase


def _versions(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Tells apart the texts of rows that repeat an id."""
    return np.array([text_digest(data, *x) for x in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)], np.int64)


def _factor(window: int, gram: int, key: int):
    """Phrases of (id, text) batches."""

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy()
            data, offsets = text_bytes(batch.column(1))
            for a, b in slices(offsets):
                _, _, first, h, h2 = words(data, offsets[a : b + 1], SPACED, key, 2)
                row, start, count, anchor, phrase = phrases(h, h2, first, window, gram)
                version = _versions(data, offsets[a : b + 1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[a + row]), pa.array(version[row]), pa.array(anchor.view(np.int64)), pa.array(phrase.view(np.int64)), pa.array(start.astype(np.int32)), pa.array(count.astype(np.int32))],
                    names=["id", "version", "anchor", "phrase", "start", "windows"],
                )

    return run


def _boundary_windows(window: int, key: int):
    """The single windows of phrases: batches of (id, version, text, at), at holding (start, windows, anchor)."""

    def run(batches):
        for batch in batches:
            ids, versions = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            data, offsets = text_bytes(batch.column(2))
            at = batch.column(3)
            for a, b in slices(offsets):
                _, _, first, _, h2 = words(data, offsets[a : b + 1], SPACED, key, 2)
                each_window = windows(h2, window)
                version = _versions(data, offsets[a : b + 1])
                mine = at.slice(a, b - a)
                row = np.repeat(np.arange(b - a), np.diff(mine.offsets.to_numpy()))
                part = mine.flatten()
                start, count, anchor = (part.field(c).to_numpy() for c in ("start", "windows", "anchor"))
                on = version[row] == versions[a + row]
                row, start, count, anchor = row[on], start[on].astype(np.int64), count[on].astype(np.int64), anchor[on]
                each = np.repeat(np.arange(len(row)), count)
                offset = start[each] + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                found = each_window[first[row[each]] + offset] if len(each) else np.zeros(0, np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[a + row[each]]), pa.array(versions[a + row[each]]), pa.array(anchor[each]), pa.array(found.view(np.int64)), pa.array(offset.astype(np.int32))],
                    names=["id", "version", "anchor", "window", "start"],
                )

    return run


def factors(spans: list[dict]) -> list[dict]:
    """The greedy parse: spans (start, end, ref, ref_start) by start, as factors that do not overlap and go on for as long as one reference does."""
    out: list[dict] = []
    for x in spans:
        last = out[-1] if out else None
        end = last["start"] + last["words"] if last else 0
        if last and last["ref"] == x["ref"] and last["ref_start"] - last["start"] == x["ref_start"] - x["start"] and x["start"] <= end:
            last["words"] = max(end, x["end"]) - last["start"]
        elif x["end"] > end:
            skip = max(0, end - x["start"])
            out.append({"start": x["start"] + skip, "words": x["end"] - x["start"] - skip, "ref": x["ref"], "ref_start": x["ref_start"] + skip})
    return out


_FACTORS = pa.list_(pa.struct([("start", pa.int32()), ("words", pa.int32()), ("ref", pa.int64()), ("ref_start", pa.int32())]))


def _cleaned(with_text: bool):
    """Digest (and text) of what stays, and factors: batches of (id, text, spans, want).

    spans may be null; a row whose words are not of the wanted version is left out.
    """

    def run(batches):
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            spans = batch.column(2)
            total: list[int] = []
            gone: list[int] = []
            version: list[int] = []
            digest: list[str] = []
            kept: list[str] = []
            parsed: list[list[dict]] = []
            for a, b in slices(offsets):
                s, e, first = word_places(data, offsets[a : b + 1], SPACED)
                version += _versions(data, offsets[a : b + 1]).tolist()
                for i in range(b - a):
                    n = int(first[i + 1] - first[i])
                    cut = factors(spans[a + i].as_py()) if spans[a + i].is_valid else []
                    on = np.ones(n, bool)
                    for x in cut:
                        on[x["start"] : x["start"] + x["words"]] = False
                    parsed.append(cut)
                    sep = np.zeros(int(offsets[a + i + 1] - offsets[a + i]) + 1, np.int8)
                    base = offsets[a + i]
                    np.add.at(sep, s[first[i] : first[i + 1]][on] - base, 1)
                    np.add.at(sep, e[first[i] : first[i + 1]][on] - base, -1)
                    inside = np.cumsum(sep[:-1], dtype=np.int8) > 0
                    text = data[base : offsets[a + i + 1]].copy()
                    # The byte after each kept word becomes the space between words.
                    ends = e[first[i] : first[i + 1]][on] - base
                    ends = ends[:-1]
                    text[ends], inside[ends] = 0x20, True
                    stays = text[inside].tobytes()
                    total.append(n)
                    gone.append(int(n - on.sum()))
                    digest.append(hashlib.sha256(stays).hexdigest())
                    kept.append(stays.decode() if with_text else "")
            out = pa.RecordBatch.from_arrays([batch.column(0), pa.array(version, pa.int64()), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(digest, pa.string()), pa.array(kept, pa.string()), pa.array(parsed, _FACTORS)], names=["id", "version", "n_words", "n_removed", "kept_sha256", "kept_text", "factors"])
            want = batch.column(3)
            yield out.filter(pc.or_kleene(pc.is_null(want), pc.equal(want, out.column(1))))

    return run


_CLEAN = "id bigint, version bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept_text string, factors array<struct<start: int, words: int, ref: bigint, ref_start: int>>"


def substring_dedup(docs: DataFrame, window: int = 50, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256, factors (and kept_text).

    factors are the removed runs of words: start, words, and the smaller
    document (ref) and place (ref_start) that they are copied from.

    A word goes if a run of `window` words that covers it also starts in a
    document with a smaller id.  Null texts have no words.  A null id counts
    as larger than every other; rows that share an id do not remove from each
    other.  Texts of fewer than `window` words are kept whole.
    """
    spark = docs.sparkSession
    folder, key = shared_folder(spark), new_key()
    source = docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(NO_ID)).alias("id"), F.col(text_col).cast("string").alias("text"))
    found = stash(source.mapInArrow(released(_factor(window, gram, key)), _PHRASE), f"{folder}/phrases")

    # The reference: each phrase under its smallest document.  Anchors with several phrases are factor boundaries.
    first = F.min(F.struct("id", "start"))
    phrase = found.groupBy("anchor", "phrase").agg(first["id"].alias("least"), first["start"].alias("ref_start"), F.max("id").alias("most"))
    phrase = stash(phrase, f"{folder}/reference")
    boundary = phrase.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor", F.lit(True).alias("boundary"))
    matter = phrase.join(boundary, "anchor", "left").where("boundary OR least < most")
    hit = stash(found.join(matter, ["anchor", "phrase"]).select("id", "version", "anchor", "start", "windows", "least", "ref_start", "boundary"), f"{folder}/hits")
    whole = hit.where("id > least").select("id", "version", "start", (F.col("start") + F.col("windows") - 1 + window).alias("end"), F.col("least").alias("ref"), "ref_start")

    # Factor boundaries: the single windows, once for each different phrase.
    edge = hit.where("boundary AND id = least").groupBy("id", "version").agg(F.collect_list(F.struct("start", "windows", "anchor")).alias("at"))
    edge = stash(edge, f"{folder}/edges")
    texts = _texts(source, edge.select("id").distinct())
    single = texts.join(edge, "id").select("id", "version", "text", "at").mapInArrow(released(_boundary_windows(window, key)), "id bigint, version bigint, anchor bigint, window bigint, start int")
    single = stash(single, f"{folder}/windows")
    least = single.groupBy("anchor", "window").agg(first["id"].alias("least"), first["start"].alias("ref_start"), F.max("id").alias("most")).where("least < most").drop("most")
    part = single.join(least, ["anchor", "window"]).where("id > least").select("id", "version", "start", (F.col("start") + window).alias("end"), F.col("least").alias("ref"), "ref_start")

    # A document's spans are bounded by its length.
    spans = whole.union(part).groupBy("id", "version").agg(F.array_sort(F.collect_set(F.struct("start", "end", "ref", "ref_start"))).alias("spans"))
    spans = stash(spans, f"{folder}/spans")
    cut = _texts(source, spans.select("id").distinct()).join(spans, "id").select("id", "text", "spans", F.col("version").alias("want"))
    cleaned = cut.mapInArrow(released(_cleaned(with_text)), _CLEAN).dropDuplicates(["id", "version"])
    every = source.select("id", "text", F.lit(None).cast(spans.schema["spans"].dataType).alias("spans"), F.lit(None).cast("bigint").alias("want")).mapInArrow(released(_cleaned(with_text)), _CLEAN)
    every = stash(every, f"{folder}/every")
    cleaned = cleaned.select("id", "version", *[F.col(c).alias(f"c_{c}") for c in ("n_removed", "kept_sha256", "kept_text", "factors")])
    out = every.join(cleaned, ["id", "version"], "left")
    best = lambda c: F.coalesce(f"c_{c}", c).alias(c)
    return out.select(F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id"), "n_words", best("n_removed"), best("kept_sha256"), best("factors"), *([best("kept_text")] if with_text else []))


def _texts(source: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of these ids: a checked broadcast keeps the other texts out of the shuffle."""
    ids = stash(ids)
    return source.join(F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids, "id", "left_semi")


def op7_relative_lz(spark, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("factors")


def brute_force(docs: list[tuple], window: int = 50) -> list[tuple]:
    """(doc_id, n_words, n_removed, kept_sha256), for tests."""
    import re

    split = {d: re.findall(r"[^\x20\x09-\x0D]+", t or "") for d, t in docs}
    seen: set[tuple] = set()
    out = []
    for d in sorted(split):
        w = split[d]
        gone: set[int] = set()
        own = [tuple(w[i : i + window]) for i in range(len(w) - window + 1)]
        for i, x in enumerate(own):
            if x in seen:
                gone.update(range(i, i + window))
        seen.update(own)
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out
