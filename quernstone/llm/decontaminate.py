"""Benchmark decontamination by suffix arrays over shards of the training text (operator 2).

Each shard (a slice of an Arrow batch) is turned into words; the suffixes that
begin with a seed, the first words of some benchmark window, are sorted into a
suffix array; every benchmark suffix is binary-searched in it.  The range found
holds all its verbatim occurrences with their places; occurrences that follow
each other in item and document make up the longest matches.  A document never
spans shards, so nothing is shuffled.

The benchmark is the broadcast side.  It goes out in blocks of at most
`block_bytes`, each a broadcast variable that Spark keeps on disk; one Python
stage searches them one after the other, so neither the plan nor what a task
holds grows with the benchmark.

Words are equal if 128 bits of two hashes under the run's own key are.
"""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textscan import ALNUM_LOWER, new_key, released, slices, text_bytes, windows, word_places, words

#: Words of a seed, or fewer where a window has fewer.
SEED = 4
#: Matches of windows that are looked at together, unless one document has more.
MATCHES = 1 << 20
#: Stands for a word that the benchmark lacks.
OTHER = 0xFFFFFFFE
COLUMNS = "n_words bigint, hit_spans array<array<bigint>>, items array<string>, matches array<struct<item: string, start: bigint, item_start: bigint, words: bigint>>"


class TestSuffixes:
    """Suffixes of benchmark items whose windows have one seed length, ready to be searched for."""

    def __init__(self, ids: list[str], texts: list[str], window: int, key: int):
        data, offsets = text_bytes(pa.array(texts, pa.string()))
        _, _, first, h, h2 = words(data, offsets, ALNUM_LOWER, key, 2)
        count = np.diff(first)
        self.ids, self.depth = ids, window
        self.vocabulary, at = np.unique(h, return_index=True)
        self.check = h2[at]
        numbers = self.number(h, h2)
        #: Per suffix that is long enough for its item's window: item, place in it, window length.
        width = np.minimum(count, window)
        per_item = np.where(count > 0, count - width + 1, 0)
        self.item = np.repeat(np.arange(len(ids)), per_item)
        self.offset = np.arange(per_item.sum()) - np.repeat(np.cumsum(per_item) - per_item, per_item)
        start = first[:-1][self.item] + self.offset
        self.width = width[self.item]
        self.seed = int(min(SEED, self.width.min(initial=SEED)))
        self.seeds = np.unique(windows(h, self.seed)[start]) if len(start) else np.zeros(0, np.uint64)
        low = np.zeros((len(start), window), ">u4")
        for j in range(window):
            on = self.width > j
            low[on, j] = numbers[start[on] + j]
        high = low.copy()
        for j in range(window):
            high[self.width <= j, j] = 0xFFFFFFFF
        self.low, self.high = (x.view(f"S{4 * window}").ravel() for x in (low, high))

    def number(self, h: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Words as numbers from 1, or OTHER."""
        if not len(self.vocabulary):
            return np.full(len(h), OTHER, np.uint32)
        at = np.minimum(np.searchsorted(self.vocabulary, h), len(self.vocabulary) - 1)
        return np.where((self.vocabulary[at] == h) & (self.check[at] == h2), at + 1, OTHER).astype(np.uint32)

    def search(self, h: np.ndarray, h2: np.ndarray, first: np.ndarray):
        """The shard's suffix array (places of suffixes in order), and each test suffix's range in it."""
        seeds = windows(h, self.seed)
        if not len(self.seeds) or not len(seeds):
            return None
        at = np.minimum(np.searchsorted(self.seeds, seeds), len(self.seeds) - 1)
        suffixes = np.flatnonzero(self.seeds[at] == seeds)
        if not len(suffixes):
            return None
        # Keys of `depth` words; words beyond the document's end match nothing.
        end = first[np.searchsorted(first, suffixes, "right")]
        key = np.full((len(suffixes), self.depth), OTHER, ">u4")
        for j in range(self.depth):
            on = np.flatnonzero(suffixes + j < end)
            key[on, j] = self.number(h[suffixes[on] + j], h2[suffixes[on] + j])
        key = key.view(f"S{4 * self.depth}").ravel()
        order = np.argsort(key, kind="stable")
        key, suffixes = key[order], suffixes[order]
        return suffixes, np.searchsorted(key, self.low, "left"), np.searchsorted(key, self.high, "right")

    def matches(self, h: np.ndarray, h2: np.ndarray, first: np.ndarray):
        """(row, place, test suffix) arrays, all of a row in one part; parts have about MATCHES."""
        found = self.search(h, h2, first)
        if found is None:
            return
        suffixes, low, high = found
        # How often each place is in some range, by document.
        held = np.zeros(len(suffixes) + 1, np.int64)
        np.add.at(held, low, 1)
        np.add.at(held, high, -1)
        row = np.searchsorted(first, suffixes, "right") - 1
        per_row = np.bincount(row, np.cumsum(held[:-1]), len(first) - 1)
        part_of = (np.cumsum(per_row) - per_row).astype(np.int64) // MATCHES
        for part in np.unique(part_of[per_row > 0]).tolist():
            on = part_of[row] == part
            # Ranges within the part's own suffixes.
            before = np.concatenate([[0], np.cumsum(on)])
            own, a, b = suffixes[on], before[low], before[high]
            size = b - a
            which = np.repeat(np.arange(len(size)), size)
            place = own[np.arange(size.sum()) + np.repeat(a - (np.cumsum(size) - size), size)]
            yield np.searchsorted(first, place, "right") - 1, place - first[np.searchsorted(first, place, "right") - 1], which


def _suffixes(items: list[tuple[str, str]], window: int, key: int) -> list[TestSuffixes]:
    """The items by the length of their seed, so that short ones do not shorten the seeds of all."""
    seeds = np.minimum(np.diff(word_places(*text_bytes(pa.array([t for _, t in items], pa.string())), ALNUM_LOWER)[2]), SEED)
    groups = {n: [items[i] for i in np.flatnonzero(seeds == n).tolist()] for n in np.unique(seeds[seeds > 0]).tolist()}
    return [TestSuffixes([i for i, _ in own], [t for _, t in own], window, key) for own in groups.values()]


def _longest(tests: TestSuffixes, row: np.ndarray, place: np.ndarray, which: np.ndarray):
    """The longest match of each row and item: row, item, start in the document and in the item, words."""
    item, offset, width = tests.item[which], tests.offset[which], tests.width[which]
    order = np.lexsort((place, place - offset, item, row))
    p, o, i, w, r = place[order], offset[order], item[order], width[order], row[order]
    new = np.ones(len(p), bool)
    new[1:] = (np.diff(p) != 1) | (np.diff(o) != 1) | (np.diff(i) != 0) | (np.diff(r) != 0)
    begin = np.flatnonzero(new)
    size = np.diff(np.append(begin, len(p))) - 1 + w[begin]
    r, i, p, o = r[begin], i[begin], p[begin], o[begin]
    order = np.lexsort((o, p, -size, i, r))
    first = np.ones(len(order), bool)
    first[1:] = (np.diff(r[order]) != 0) | (np.diff(i[order]) != 0)
    best = order[first]
    return r[best], i[best], p[best], o[best], size[best]


def _search(blocks: list, window: int, text_at: int, key: int):
    """Batches with the columns of COLUMNS added."""

    def run(batches):
        at, tests = -1, []
        for batch in batches:
            data, offsets = text_bytes(batch.column(text_at))
            total = np.zeros(batch.num_rows, np.int64)
            hit: dict[int, list] = {}
            best: dict[int, dict[str, tuple]] = {}
            for k in range(max(1, len(blocks))):
                if at != k:
                    at, tests = k, _suffixes(blocks[k].value, window, key) if blocks else []
                for a, b in slices(offsets):
                    _, _, first, h, h2 = words(data, offsets[a : b + 1], ALNUM_LOWER, key, 2)
                    total[a:b] = np.diff(first)
                    for t in tests:
                        for row, place, which in t.matches(h, h2, first):
                            span = np.unique(np.stack([row, place, place + t.width[which]], 1), axis=0)
                            cuts = np.flatnonzero(np.diff(span[:, 0])) + 1
                            for part in np.split(span, cuts):
                                hit.setdefault(a + int(part[0, 0]), []).append(part[:, 1:])
                            for r, i, p, o, n in zip(*(x.tolist() for x in _longest(t, row, place, which)), strict=True):
                                mine, name = best.setdefault(a + r, {}), t.ids[i]
                                mine[name] = min(mine.get(name, (0, 0, 0)), (-n, p, o))
            spans = [_merged(np.concatenate(hit[r])) if r in hit else [] for r in range(batch.num_rows)]
            found = [sorted(best.get(r, ())) for r in range(batch.num_rows)]
            places = [[{"item": i, "start": best[r][i][1], "item_start": best[r][i][2], "words": -best[r][i][0]} for i in found[r]] for r in range(batch.num_rows)]
            kinds = [pa.int64(), pa.list_(pa.list_(pa.int64())), pa.list_(pa.string()), pa.list_(pa.struct([("item", pa.string()), ("start", pa.int64()), ("item_start", pa.int64()), ("words", pa.int64())]))]
            more = [pa.array(c, t) for c, t in zip((total, spans, found, places), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, "n_words", "hit_spans", "items", "matches"])

    return run


def _merged(spans: np.ndarray) -> list[list[int]]:
    """The union of intervals, as the fewest."""
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    far = np.maximum.accumulate(spans[:, 1])
    new = np.flatnonzero(np.concatenate([[True], spans[1:, 0] > far[:-1]]))
    return np.stack([spans[new, 0], far[np.append(new[1:], len(spans)) - 1]], 1).tolist()


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int) -> list:
    """The benchmark in broadcast blocks of about `block_bytes`; one is in the driver's memory at a time."""
    items = benchmark.where(F.col(item_col).isNotNull()).select(F.col(item_col).cast("string").alias("i"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    total = items.agg(F.sum(F.octet_length("t") + 16)).first()[0] or 0
    n = -(-total // block_bytes)
    parts = (items if n == 1 else items.where(F.pmod(F.xxhash64("i"), F.lit(n)) == k) for k in range(n))
    return [benchmark.sparkSession.sparkContext.broadcast([(r.i, r.t) for r in part.collect()]) for part in parts]


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 13, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = 8 << 20) -> DataFrame:
    """docs with n_words, hit_spans, items, matches, n_hit, n_items, longest_match and contaminated.

    hit_spans are the hit words as intervals; matches has the longest verbatim
    match with each item that has one: first word in the document and in the
    item, and words.  Null and empty texts have no words and are clean.  Items
    with a null id are left out; an item id that occurs twice counts once.  An
    empty benchmark hits nothing.  Repeated rows are judged one by one.  A
    document is contaminated if any word is hit and at least a twentieth are.
    Columns of docs that have one of the new names are an error.
    """
    new = ["n_words", "hit_spans", "items", "matches", "n_hit", "n_items", "longest_match", "contaminated"]
    clash = [c for c in docs.columns if c in new]
    if clash:
        raise ValueError(f"columns are taken: {clash}")
    schema = f"{docs.schema.simpleString()[7:-1]}, {COLUMNS}" if docs.columns else COLUMNS
    blocks = _blocks(benchmark, item_col, item_text_col, block_bytes)
    out = docs.mapInArrow(released(_search(blocks, window, docs.columns.index(text_col), new_key())), schema)
    none = F.lit(0).cast("bigint")
    out = out.withColumns({
        "n_hit": F.aggregate("hit_spans", none, lambda s, x: s + x[1] - x[0]),
        "n_items": F.size("items").cast("bigint"),
        "longest_match": F.coalesce(F.array_max(F.transform("matches", lambda m: m["words"])), none),
    })
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def op2_decontaminate(spark, sf_dir: str) -> DataFrame:
    from .common import table

    out = decontaminate(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


def brute_force(docs: list[tuple], items: list[tuple], window: int = 13) -> list[tuple]:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated), for tests."""
    import re

    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    tests = {}
    for i, t in items:
        w = split(t)
        if w and i is not None:
            tests.setdefault(str(i), []).extend([w[k : k + min(window, len(w))] for k in range(max(1, len(w) - window + 1))])
    out = []
    for d, t in docs:
        w, hit, found = split(t), set(), set()
        for i, windows in tests.items():
            for x in windows:
                for k in range(len(w) - len(x) + 1):
                    if w[k : k + len(x)] == x:
                        hit.update(range(k, k + len(x)))
                        found.add(i)
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return json.loads(json.dumps(out))
