"""N-gram Jaccard join by grouped prefixes (operator 1).

Two shingle sets of Jaccard similarity t share a shingle among the first
n - ceil(t n) + 1 of each, in any order that all sets keep.  The order here is
by rising frequency, so frequent shingles are hardly ever in a prefix; it only
steers the cost, any order gives the same links.

1. Shingles that are frequent in some block of documents are counted (lossy
   counting; the table of the most frequent has a fixed size).
2. Documents with equal sets become one class, classes with equal prefixes and
   size become one group, and groups post themselves under their prefix
   shingles; lists with one group fall out, groups expand into their classes.
3. Each list has a hub, the member whose prefix is shared most.  Members whose
   parity bitmaps (a sure bound) do not show that they are far from it are
   verified against it on their full sets, and keep the symmetric difference
   d(x) = x - h.  As x - y = d(x) - d(y), members x and y are linked exactly if
   d(x) and d(y) share at least
       c(x, y) = (w(x) + w(y)) / (2 (100 + p)),  w(x) = (100 + p) |d(x)| - (100 - p) n(x),
   elements, p being the least similarity in percent.  So all x with
   w(x) + w(y*) <= 0 are linked with the member y* of least w, and the few
   others are found by a second prefix join, on the differences: its lists are
   short, since edits of near copies are seldom the same.
4. Members too far from their hub for this get another hub, for some rounds or
   until no more pairs are left in their lists than there are postings; these
   are then verified one by one.  Pairs inside a
   component cannot change the components and are not looked at.  A large
   group of near copies thus costs a star, not a square.

A shingle is known by a 64-bit hash under a key that each run draws anew; sets
are equal if 128-bit digests of their hashes are, and links are decided on the
full sets of the two documents.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, NO_ID, components, shared_folder, stash, table
from .textscan import SPACED_LOWER, mix, new_key, released, shingles, slices, text_bytes, words

#: A shingle is frequent if so many sets of one block hold it.
FREQUENT, BLOCK_SETS, BLOCK_SHINGLES = 3, 8192, 3_000_000
#: Frequent shingles that the order knows; 12 bytes each.
RANKED = 1 << 20
#: Hubs that a list tries, and pairs for each posting below which none is tried, before pairs of what is left are verified one by one.
ROUNDS, DIRECT = 3, 1.0
#: Rows of an Arrow batch of documents, and of pairs of documents.
ROWS, PAIR_ROWS = 1000, 200


def shingle_sets(column: pa.Array, k: int, key: int):
    """(first row, the rows' sorted distinct shingle hashes) for slices of a text column."""
    data, offsets = text_bytes(column)
    for a, b in slices(offsets):
        _, _, first, h = words(data, offsets[a : b + 1], SPACED_LOWER, key)
        g, at = shingles(h, first, k)
        yield a, [np.unique(g[at[i] : at[i + 1]]) for i in range(b - a)]


def least_overlap(n: int, percent: int) -> int:
    """The least intersection that a set of n can have with one it is linked to."""
    return -(-percent * n // 100)


def bitmap(x: np.ndarray) -> np.ndarray:
    """Parities of the set's hashes in a power of two of bits, two for each element at least."""
    bits = max(256, 1 << int(2 * len(x)).bit_length())
    place = mix(x.copy()) & np.uint64(bits - 1)
    odd = (np.bincount(place.astype(np.int64), minlength=bits) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64)


def least_difference(a: str, b: str, folds: int = 3) -> Column:
    """No more than the elements that only one of two sets has: bits in which their bitmaps differ.

    The longer bitmap is folded to the shorter's size, some times; where that
    is not enough nothing is known, and the answer is 0.
    """
    def fold(m: Column) -> Column:
        half = (F.size(m) / 2).cast("int")
        return F.zip_with(F.slice(m, F.lit(1), half), F.slice(m, half + 1, half), lambda x, y: x.bitwiseXOR(y))

    x, y = F.col(a), F.col(b)
    for _ in range(folds):
        x, y = F.when(F.size(x) > F.size(y), fold(x)).otherwise(x), F.when(F.size(y) > F.size(x), fold(y)).otherwise(y)
    differ = F.aggregate(F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda s, v: s + v)
    return F.when(F.size(x) == F.size(y), differ).otherwise(0)


def _signature(x: np.ndarray) -> tuple[int, int]:
    d = hashlib.blake2b(x.tobytes(), digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def _frequent(k: int, key: int):
    """(shingle, sets) of each block's frequent shingles; equal sets in a block count once."""

    def run(batches):
        held: dict[tuple, np.ndarray] = {}
        size = 0

        def flush():
            if not held:
                return pa.RecordBatch.from_arrays([pa.array([], pa.int64()), pa.array([], pa.int64())], names=["shingle", "sets"])
            x = np.concatenate(list(held.values()))
            x.sort()
            begin = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]]))
            count = np.diff(np.append(begin, len(x)))
            on = count >= FREQUENT
            return pa.RecordBatch.from_arrays([pa.array(x[begin[on]].view(np.int64)), pa.array(count[on])], names=["shingle", "sets"])

        for batch in batches:
            for _, sets in shingle_sets(batch.column(0), k, key):
                for x in sets:
                    if len(x):
                        own = _signature(x)
                        size += len(x) * (own not in held)
                        held[own] = x
                if len(held) >= BLOCK_SETS or size >= BLOCK_SHINGLES:
                    yield flush()
                    held, size = {}, 0
        yield flush()

    return run


def _sketch(k: int, percent: int, key: int, ranked: np.ndarray, rank: np.ndarray):
    """(id, n, sig1, sig2, prefix_key, prefix, bitmap) of (id, text) batches."""

    def run(batches):
        for batch in batches:
            n, sig1, sig2, keys, prefixes, maps = [], [], [], [], [], []
            for _, sets in shingle_sets(batch.column(1), k, key):
                for x in sets:
                    s1, s2 = _signature(x)
                    maps.append(bitmap(x))
                    n.append(len(x))
                    sig1.append(s1)
                    sig2.append(s2)
                    if len(ranked):
                        at = np.minimum(np.searchsorted(ranked, x), len(ranked) - 1)
                        x = x[np.argsort(np.where(ranked[at] == x, rank[at], 0), kind="stable")]
                    prefix = x[: len(x) - least_overlap(len(x), percent) + 1] if len(x) else x
                    keys.append(_signature(prefix)[0])
                    prefixes.append(prefix.view(np.int64))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip((n, sig1, sig2, keys, prefixes, maps), kinds, strict=True))], names=["id", "n", "sig1", "sig2", "prefix_key", "prefix", "bitmap"])

    return run


def comparable(d: Column, n_a: Column, n_b: Column, p: int) -> Column:
    """Whether b differs so little from a that a member near a (with at most twice the difference of linked sets) may be linked with it."""
    return p * (100 + p) * d <= (100 - p) * ((300 + p) * n_b + 2 * p * n_a)


def linked(d: Column, n: Column, m: Column, percent: int) -> Column:
    """Whether sets of n and m that differ in d elements are linked."""
    return (100 + percent) * d <= (100 - percent) * (n + m)


def _differences(k: int, percent: int, key: int, tokens: bool):
    """(a, b, n_a, n_b, d, tokens) of (a, b, text_a, text_b) batches: d elements are in one set only.

    tokens, where asked for: these elements, those that a lacks first; null
    where b is so far from a that no member near a can be linked with it.
    """

    def run(batches):
        last: tuple = (None, None)
        for batch in batches:
            ids_a, ids_b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            out: list[list] = [[] for _ in range(4)]
            step = max(1, len(ids_a) * (4 << 20) // max(1, batch.nbytes))
            for at in range(0, len(ids_a), step):
                right = [x for _, sets in shingle_sets(batch.column(3).slice(at, step), k, key) for x in sets]
                for i, y in enumerate(right, at):
                    if last[0] != ids_a[i]:  # pairs come by hub
                        last = ids_a[i], next(s for _, s in shingle_sets(batch.column(2).slice(i, 1), k, key))[0]
                    x = last[1]
                    place = np.minimum(np.searchsorted(x, y), len(x) - 1)
                    new = x[place] != y
                    d = len(x) - len(y) + 2 * int(new.sum())
                    out[0].append(len(x))
                    out[1].append(len(y))
                    out[2].append(d)
                    near = tokens and (100 + percent) * d * percent <= (100 - percent) * ((300 + percent) * len(y) + 2 * percent * len(x))
                    if near:
                        gone = np.ones(len(x), bool)
                        gone[place[~new]] = False
                        out[3].append(np.concatenate([y[new], x[gone]]).view(np.int64))
                    else:
                        out[3].append(None)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c, t) for c, t in zip(out, kinds, strict=True))], names=["a", "b", "n_a", "n_b", "d", "tokens"])

    return run


def _few(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A stashed df of rows of a few numbers, to be broadcast up to a checked size."""
    return F.broadcast(df) if df.count() <= rows else df


class _Join:
    def __init__(self, docs: DataFrame, k: int, percent: int, id_col: str, text_col: str):
        self.spark, self.k, self.percent, self.key = docs.sparkSession, k, percent, new_key()
        self.folder = shared_folder(self.spark)
        self.source = docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(NO_ID)).alias("id"), F.col(text_col).cast("string").alias("text"))
        # Where ids repeat, rows are joined under numbers of their own.
        self.ids = None
        if self.source.groupBy("id").count().where("count > 1").take(1):
            rows = stash(self.source.withColumn("row", F.monotonically_increasing_id()), f"{self.folder}/rows")
            self.ids = rows.select("row", "id")
            self.source = rows.select(F.col("row").alias("id"), "text")

    def sketch(self) -> DataFrame:
        counted = self.source.select("text").mapInArrow(released(_frequent(self.k, self.key)), "shingle bigint, sets bigint").groupBy("shingle").agg(F.sum("sets").alias("sets"))
        counted = stash(counted, f"{self.folder}/frequent", ROWS)
        # The least count at which no more than RANKED shingles are left.
        held, least = 0, 1 << 62
        for r in counted.groupBy("sets").count().orderBy(F.desc("sets")).collect():
            held += r["count"]
            if held > RANKED:
                break
            least = r.sets
        top = counted.where(F.col("sets") >= least).toArrow()
        ranked, sets = top.column("shingle").to_numpy().view(np.uint64), top.column("sets").to_numpy()
        order = np.argsort(ranked)
        ranked, rank = ranked[order], sets[order].astype(np.int32)
        return stash(self.source.mapInArrow(released(_sketch(self.k, self.percent, self.key, ranked, rank)), "id bigint, n bigint, sig1 bigint, sig2 bigint, prefix_key bigint, prefix array<bigint>, bitmap array<bigint>"), f"{self.folder}/sketch", ROWS)

    def postings(self, sketch: DataFrame, classes: DataFrame) -> DataFrame:
        """(token, node, n): classes under the prefix shingles that at least two groups hold, and under their group if it has several.

        The prefixes of all groups are dealt out by shingle once; both the
        counts and the lists are read from that one exchange.
        """
        groups = stash(classes.groupBy("prefix_key", "n").agg(F.min("node").alias("group"), F.count("*").alias("classes")), f"{self.folder}/groups")
        heads = groups.select(F.col("group").alias("id"), "prefix_key", "n")
        heads = sketch.select("id", "prefix_key", "n", "prefix").join(_few(heads), ["id", "prefix_key", "n"], "left_semi")
        dealt = heads.select(F.explode("prefix").alias("token"), F.col("id").alias("group"), F.col("n").cast("int").alias("n")).repartition("token")
        shared = dealt.groupBy("token").agg(F.count("*").alias("held")).where("held > 1").select("token")
        lists = dealt.join(shared, "token")

        member = stash(classes.join(groups.where("classes > 1"), ["prefix_key", "n"]).select("group", "node", "prefix_key", F.col("n").cast("int").alias("n")), f"{self.folder}/members")
        own = member.select(F.col("prefix_key").alias("token"), "node", "n")
        lists = lists.join(_few(member.select("group", "node")), "group", "left").select("token", F.coalesce("node", "group").alias("node"), "n")
        return stash(lists.unionByName(own), f"{self.folder}/postings")

    def compared(self, pairs: DataFrame, name: str, tokens: bool) -> DataFrame:
        """Pairs (a, b), distinct, with n_a, n_b, d and tokens, on full sets; pairs that bitmaps show to be too far apart are left out."""
        # Members look up their pairs, so what is long moves once, to its hub.
        side = lambda s: self.bitmaps.select(F.col("node").alias(s), F.col("n").alias(f"n_{s}"), F.col("bitmap").alias(f"map_{s}"))
        pairs = stash(pairs, f"{self.folder}/{name}-pairs")
        both = side("b").join(_few(pairs), "b").join(side("a"), "a").withColumn("d", least_difference("map_a", "map_b"))
        may = (comparable if tokens else linked)(F.col("d"), F.col("n_a"), F.col("n_b"), self.percent)
        pairs = stash(both.where(may).select("a", "b"), f"{self.folder}/{name}-near")
        hubs = stash(pairs.select("a").distinct(), f"{self.folder}/{name}-hubs")
        text = lambda s: self.source.select(F.col("id").alias(s), F.col("text").alias(f"text_{s}"))
        full = text("b").join(_few(pairs), "b").join(text("a").join(_few(hubs), "a", "left_semi"), "a").select("a", "b", "text_a", "text_b")
        out = full.mapInArrow(released(_differences(self.k, self.percent, self.key, tokens)), "a bigint, b bigint, n_a bigint, n_b bigint, d bigint, tokens array<bigint>")
        return stash(out, f"{self.folder}/{name}-compared", PAIR_ROWS)

    def hubs(self, lists: DataFrame, score: DataFrame, name: str) -> DataFrame:
        """(token, a, n_a): the hub of each list of several members, the one whose prefix is shared most."""
        best = F.max_by(F.struct("node", "n"), F.struct("score", -F.col("node")))
        hub = lists.join(score, "node").groupBy("token").agg(best.alias("hub"), F.count("*").alias("members")).where("members > 1")
        return stash(hub.select("token", F.col("hub.node").alias("a"), F.col("hub.n").cast("bigint").alias("n_a")), f"{self.folder}/{name}-lists")

    def hub_round(self, lists: DataFrame, hub: DataFrame, name: str) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Links with hubs, lists of differences, and the lists of members far from their hubs."""
        p, up = self.percent, 2 * (100 + self.percent)
        mine = stash(lists.join(_few(hub), "token").where("node <> a"), f"{self.folder}/{name}-mine")
        # Sets whose sizes differ too much are far apart, and need no comparison.
        near_size = comparable(F.abs(F.col("n") - F.col("n_a")), F.col("n_a"), F.col("n"), p)
        got = self.compared(mine.where(near_size).select("a", F.col("node").alias("b")).distinct(), name, tokens=True)

        # w of the members that a near one may be linked with, the hub among them.
        band = got.where("tokens IS NOT NULL").withColumn("w", (100 + p) * F.col("d") - (100 - p) * F.col("n_b"))
        hubs = got.groupBy("a").agg(F.max("n_a").alias("n_a")).select("a", F.col("a").alias("b"), (-(100 - p) * F.col("n_a")).alias("w"))
        least = band.select("a", "b", "w").union(hubs).groupBy("a").agg(F.min(F.struct("w", "b")).alias("least"))
        least = stash(least.select("a", F.col("least.w").alias("least_w"), F.col("least.b").alias("star")), f"{self.folder}/{name}-least")
        known = stash(band.join(_few(least), "a").withColumn("outside", F.col("w") + F.col("least_w") > 0), f"{self.folder}/{name}-known")
        stars = known.where(~F.col("outside") & (F.col("b") != F.col("star"))).select("star", "b").union(least.where("star <> a").select("star", "a")).toDF("a", "b")

        # Prefixes of the differences: x stands for members outside the star, y for all.
        outside = known.where("outside").groupBy("a").agg(F.min("w").alias("outside_w"))
        nearest = known.groupBy("a").agg(F.min("w").alias("inner_w"))
        bounds = stash(outside.join(nearest, "a"), f"{self.folder}/{name}-bounds")
        known = known.join(_few(bounds), "a")
        need = lambda w: F.greatest(F.lit(1), F.ceil((F.col("w") + F.col(w)) / up))
        posted = lambda w: known.select("a", "b", "n_b", "d", "w", "outside", F.posexplode(F.slice("tokens", F.lit(1), F.greatest(F.lit(0), F.col("d") - need(w) + 1).cast("int"))).alias("i", "token"))
        x = posted("inner_w").where("outside").select("a", "token", F.lit(True).alias("asks"), F.col("b").alias("node"), F.col("n_b").alias("n"), "d", "w", "i", "outside")
        y = posted("outside_w").select("a", "token", F.lit(False).alias("asks"), F.col("b").alias("node"), F.col("n_b").alias("n"), "d", "w", "i", "outside")
        dealt = x.unionByName(y)
        near = got.where((100 + p) * F.col("d") <= 2 * (100 - p) * (F.col("n_a") + F.col("n_b"))).select("a", F.col("b").alias("node"))
        far = mine.join(near, ["a", "node"], "left_anti").select("token", "node", "n")
        return stars, stash(dealt, f"{self.folder}/{name}-dealt"), stash(far, f"{self.folder}/{name}-far")

    def apart(self, dealt: DataFrame, label: DataFrame) -> DataFrame:
        """Pairs (a, b) of different components from the lists of differences that may be linked."""
        p, up = self.percent, 2 * (100 + self.percent)
        named = dealt.join(label, "node", "left").withColumn("label", F.coalesce("component", "node"))
        # Lists without a member that asks, or all in one component, have no pair.
        lists = named.groupBy("a", "token").agg(F.max("asks").alias("asked"), F.min("label").alias("low"), F.max("label").alias("high")).where("asked AND low < high").select("a", "token")
        named = named.join(lists, ["a", "token"])
        x = named.where("asks").select("a", "token", *[F.col(c).alias(f"{c}_x") for c in ("node", "n", "d", "w", "i", "label")])
        y = named.where("NOT asks")
        need = F.ceil((F.col("w") + F.col("w_x")) / up)
        # At their first common element, what follows it bounds what they share.
        room = F.least(F.col("d") - F.col("i"), F.col("d_x") - F.col("i_x"))
        both = x.join(y, ["a", "token"]).where((F.col("label") != F.col("label_x")) & (~F.col("outside") | (F.col("node") < F.col("node_x"))) & (100 * F.least("n", "n_x") >= p * F.greatest("n", "n_x")) & (need <= room))
        return both.select(F.least("node", "node_x").alias("a"), F.greatest("node", "node_x").alias("b"))

    def rest(self, lists: DataFrame, label: DataFrame) -> DataFrame:
        """All pairs (a, b) of different components in what is left of the lists."""
        named = lists.join(label, "node", "left").select("token", "node", "n", F.coalesce("component", "node").alias("label"))
        x, y = named, named.select("token", *[F.col(c).alias(f"{c}_y") for c in ("node", "n", "label")])
        both = x.join(y, "token").where((F.col("node") < F.col("node_y")) & (F.col("label") != F.col("label_y")) & (100 * F.least("n", "n_y") >= self.percent * F.greatest("n", "n_y")))
        return both.select(F.col("node").alias("a"), F.col("node_y").alias("b"))

    def run(self) -> DataFrame:
        p, sketch = self.percent, self.sketch()
        classes = sketch.where("n > 0").groupBy("sig1", "sig2", "n", "prefix_key").agg(F.min("id").alias("node"))
        classes = stash(classes, f"{self.folder}/classes")
        lists = self.postings(sketch, classes.select("prefix_key", "n", "node"))
        self.bitmaps = sketch.join(_few(stash(lists.select(F.col("node").alias("id")).distinct(), f"{self.folder}/nodes")), "id", "left_semi").select(F.col("id").alias("node"), "n", "bitmap")
        # The share of a prefix that others have too: edits lower it.
        size = F.col("n") - F.ceil(F.lit(p) * F.col("n") / 100) + 1
        score = stash(lists.groupBy("node").agg((F.count("*") / F.max(size)).alias("score")), f"{self.folder}/scores")
        score = _few(score)

        stars, dealt, postings = [], [], lists.count()
        for k in range(ROUNDS):
            hub = self.hubs(lists, score, f"round{k}")
            star, differences, lists = self.hub_round(lists, hub, f"round{k}")
            stars.append(stash(star, f"{self.folder}/star{k}"))
            dealt.append(differences)
            left = lists.groupBy("token").count().agg(F.sum(F.expr("count * (count - 1) / 2"))).first()[0] or 0
            if left <= DIRECT * postings:
                break
        links = reduce(DataFrame.unionByName, stars)
        label = _few(components(links))
        pairs = reduce(DataFrame.unionByName, [*(self.apart(d, label) for d in dealt), self.rest(lists, label)]).distinct()
        found = self.compared(pairs, "apart", tokens=False)
        links = links.unionByName(found.where(linked(F.col("d"), F.col("n_a"), F.col("n_b"), p)).select("a", "b"))

        of = classes.select("sig1", "sig2", "node").join(components(links), "node", "left").select("sig1", "sig2", F.coalesce("component", "node").alias("component"))
        out = sketch.select("id", "n", "sig1", "sig2").join(of, ["sig1", "sig2"], "left").select("id", F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component"))
        return out if self.ids is None else self.by_id(stash(out, f"{self.folder}/by-row"))

    def by_id(self, out: DataFrame) -> DataFrame:
        """From rows to ids: the rows of an id are one node, and components are named by their smallest id."""
        out = out.withColumnRenamed("id", "row").join(self.ids, "row")
        several = out.groupBy("id").agg(F.min("component").alias("a"), F.max("component").alias("most")).where("a < most").select("id", "a")
        joined = components(out.join(several, "id").select("a", F.col("component").alias("b")))
        out = out.join(joined, out.component == joined.node, "left").select("id", "n_shingles", F.coalesce(joined.component, out.component).alias("group"))
        return out.join(out.groupBy("group").agg(F.min("id").alias("component")), "group").select("id", "n_shingles", "component")


def ngram_jaccard_join(docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    Texts link when 100 * intersection >= percent * union of their sets of
    `shingle` words (A-Z lower-cased, split at ASCII white space; a shorter
    text is one shingle).  Texts without words have no shingles and link with
    nothing.  component_id is the smallest id reachable by links.  A null id
    counts as one larger than every other, links as usual, and comes back as
    null.  Rows that repeat an id are one document with several texts.
    """
    out = _Join(docs, shingle, percent, id_col, text_col).run()
    null = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return out.select(null("id").alias("doc_id"), "n_shingles", null("component").alias("component_id"))


def op1_ngram_join(spark, sf_dir: str) -> DataFrame:
    return ngram_jaccard_join(table(spark, sf_dir, "documents").select("doc_id", "text"), shingle=4, percent=85)


def brute_force(docs: list[tuple], k: int = 4, percent: int = 85) -> list[tuple]:
    """(doc_id, n_shingles, component_id), for tests."""
    import re

    sets = {}
    for d, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[d] = {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()
    ids = sorted(sets)
    root = {d: d for d in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders: dict = {}
    for d in ids:
        for s in sets[d]:
            holders.setdefault(s, []).append(d)
    pairs = {(a, b) for h in holders.values() for i, a in enumerate(h) for b in h[i + 1 :]} if holders else set()
    for a, b in pairs:
        both = len(sets[a] & sets[b])
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return [(d, len(sets[d]), find(d)) for d in ids]
