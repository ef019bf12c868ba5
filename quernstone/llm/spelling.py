"""Spelling variants by words reduced to a few symbols (operator 11).

Letters are dealt to a few symbols so that each stands for about as many
letters of the vocabulary, and every word is reduced to its symbols.  Words one
edit apart have reduced words that are equal or one edit apart, so the full
one-edit neighbourhood of each distinct reduced word is generated and joined
with the reduced vocabulary; the words behind the pairs found are verified on
their own letters.  The alphabet is small, so a neighbourhood is small: for a
word of 10 letters and 8 symbols some 150 entries in place of thousands.

Reduced words and their neighbours are told apart by 64-bit hashes that are
sums over positions: the hash of a neighbour comes from sums of the part before
and the part after its edit, so a word of n letters costs n times the number of
symbols, however long it is.  Hashes that meet by chance only give pairs that
are verified and dropped.
"""

from __future__ import annotations

import secrets
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import among, small, stash, table
from .textscan import mix, released, text_bytes

RUNS = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SYMBOLS = 8
#: Neighbours computed at a time.
_AT_ONCE = 1 << 20


def runs(text: Column, least: int = 1) -> Column:
    """The letter runs of a text, A-Z lower-cased, of at least that many code points."""
    every = F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(RUNS), F.lit(0))
    return F.filter(every, lambda r: F.length(r) >= least) if least > 1 else every


def thinned(doc_id: Column, run: Column, every: int) -> Column:
    """The run, without one letter where `every` divides the crc32 of ``<doc_id>:<run>``."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    return F.when(h % every == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)


def vocabulary(words: DataFrame, least_length: int = 6, least_count: int = 5) -> DataFrame:
    """(word, n) of words of at least that many code points and occurrences; words: word."""
    return words.where(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


class Reducer:
    """Hashes of reduced words and of their one-edit neighbourhoods, under numbers drawn once for each run."""

    def __init__(self, symbols: int):
        self.values = np.array([secrets.randbits(64) for _ in range(symbols)], np.uint64)
        self.base = np.uint64(secrets.randbits(64) | 1)
        self.inverse = np.uint64(pow(int(self.base), -1, 1 << 64))
        self.unit = np.uint64(secrets.randbits(64) | 1)

    def _finish(self, total: np.ndarray, length: int) -> np.ndarray:
        return mix(total + np.uint64(int(self.unit) * length % (1 << 64)))

    def _parts(self, words: np.ndarray):
        """Of rows of symbols: powers, values, sums of what stands before each position (one more column)."""
        n, length = words.shape
        power = np.full(length + 1, self.base, np.uint64)
        power[0] = 1
        power = np.multiply.accumulate(power)
        before = np.zeros((n, length + 1), np.uint64)
        values = self.values[words]
        np.cumsum(values * power[:-1], axis=1, out=before[:, 1:])
        return power, values, before

    def code(self, words: np.ndarray) -> np.ndarray:
        _, _, before = self._parts(words)
        return self._finish(before[:, -1].copy(), words.shape[1])

    def neighbours(self, words: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(row, hash) of the full one-edit neighbourhood, and of the words themselves; each neighbour once."""
        n, length = words.shape
        power, values, before = self._parts(words)
        total = before[:, -1:]
        yield np.arange(n), self._finish(total[:, 0].copy(), length)
        step = max(1, _AT_ONCE // max(1, n * len(self.values)))
        for a in range(0, length + 1, step):
            at = slice(a, min(a + step, length))
            here = words[:, at]
            same = np.zeros(here.shape, bool)  # the same symbol stands before
            same[:, (a == 0) :] = words[:, max(a, 1) : at.stop] == words[:, max(a, 1) - 1 : at.stop - 1]
            # Of a run of equal symbols, only the first one is deleted.
            gone = before[:, at] + (total - before[:, a + 1 : at.stop + 1]) * self.inverse
            row, col = np.nonzero(~same)
            yield row, self._finish(gone[row, col], length - 1)
            for c, v in enumerate(self.values):
                new = total + (v - values[:, at]) * power[at]
                row, col = np.nonzero(here != c)
                yield row, self._finish(new[row, col], length)
                # A symbol is inserted before a run of its own, not within or after it.
                ins = slice(a, min(a + step, length + 1))
                longer = before[:, ins] + v * power[ins] + (total - before[:, ins]) * self.base
                first = np.ones(longer.shape, bool)
                first[:, (a == 0) :] = words[:, max(a, 1) - 1 : ins.stop - 1] != c
                row, col = np.nonzero(first)
                yield row, self._finish(longer[row, col], length + 1)


def _by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of a column of reduced words (one byte a symbol, from 'a' on), as arrays of words of one length."""
    data, offsets = text_bytes(column)
    size = np.diff(offsets)
    for length in np.unique(size[size > 0]).tolist():
        rows = np.flatnonzero(size == length)
        most = max(1, _AT_ONCE // length)
        for k in range(0, len(rows), most):
            part = rows[k : k + most]
            yield part, data[offsets[part][:, None] + np.arange(length)].astype(np.int64) - ord("a")


def _codes(reducer: Reducer):
    def run(batches):
        for batch in batches:
            code = np.zeros(batch.num_rows, np.uint64)
            for rows, words in _by_length(batch.column(2)):
                code[rows] = reducer.code(words)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(code.view(np.int64))], names=["word", "n", "reduced", "code"])

    return run


def _neighbours(reducer: Reducer):
    def run(batches):
        for batch in batches:
            for _, words in _by_length(batch.column(0)):
                most = max(1, _AT_ONCE // (words.shape[1] * len(reducer.values) * 2))
                for k in range(0, len(words), most):
                    part = words[k : k + most]
                    code = reducer.code(part).view(np.int64)
                    for row, near in reducer.neighbours(part):
                        yield pa.RecordBatch.from_arrays([pa.array(code[row]), pa.array(near.view(np.int64))], names=["code", "near"])

    return run


def _deal(words: DataFrame, symbols: int) -> tuple[str, str]:
    """The letters of the words and their symbols; the most frequent letters are dealt first, each to the symbol that has least."""
    letters = words.select(F.explode(F.split("word", "")).alias("letter")).groupBy("letter").count().collect()  # as many rows as the alphabet has letters
    load, dealt = [0] * symbols, {}
    for r in sorted(letters, key=lambda r: (-r["count"], r.letter)):
        s = min(range(symbols), key=lambda s: (load[s], s))
        load[s] += r["count"]
        dealt[r.letter] = chr(ord("a") + s)
    return "".join(dealt), "".join(dealt.values())


def near_words(words: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """(word, n, other, other_n) of words (distinct word, n) one inserted, deleted or replaced code point apart, in both directions."""
    if not 2 <= symbols <= 26:
        raise ValueError("symbols must be from 2 to 26")
    letters, short = _deal(words, symbols)
    reducer = Reducer(symbols)
    reduced = words.select("word", "n", F.translate("word", letters, short).alias("reduced"))
    members = stash(reduced.mapInArrow(released(_codes(reducer)), "word string, n bigint, reduced string, code bigint"))
    codes = stash(members.select(F.col("code").alias("near")).distinct())
    around = members.select("reduced").distinct().mapInArrow(released(_neighbours(reducer)), "code bigint, near bigint")
    links = stash(among(around, codes, "near").distinct())
    other = members.select(F.col("code").alias("near"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    pairs = members.select("code", "word", "n").join(links, "code").join(other, "near")
    close = (F.abs(F.length("word") - F.length("other")) <= 1) & (F.levenshtein("word", "other", 1) == 1)
    return pairs.where(close).select("word", "n", "other", "other_n")


def roots(forms: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(word, root) of forms (distinct word, form) without cycles: chains are halved in each round."""
    now = stash(forms.select("word", F.col("form").alias("root")))
    for _ in range(max_rounds):
        on = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        new = stash(now.join(small(on), "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        now, moved = new.select("word", "root"), new.where("moved").take(1)
        if not moved:
            return now
    raise RuntimeError(f"forms did not settle in {max_rounds} rounds")


def spelling_groups(words: DataFrame, factor: int = 5, symbols: int = SYMBOLS) -> DataFrame:
    """word, n, n_near, form, form_n, root of words (distinct word, n).

    A word's form is its near word of largest n (of equal ones the first in
    code-point order), if that n is at least factor times the word's; factor
    must be above 1, so that forms make no circle.  Words of any length and
    alphabet are taken; an empty or null word has no near words; no words make
    no rows.
    """
    if factor <= 1:
        raise ValueError("factor must be above 1")
    words = stash(words.select("word", F.col("n").cast("bigint").alias("n")))
    near = near_words(words.where(F.length("word") > 0), symbols)
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form")))
    near = near.groupBy("word").agg(F.first("n").alias("own"), F.count("*").alias("n_near"), best.alias("best"))
    is_form = -F.col("best.less") >= factor * F.col("own")
    near = stash(near.select("word", "n_near", F.when(is_form, F.col("best.form")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n")))
    root = roots(near.where("form IS NOT NULL").select("word", "form"))
    out = words.join(near, "word", "left").join(root, "word", "left")
    return out.select("word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"), "form", "form_n", F.coalesce("root", "word").alias("root"))


def document_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = 6, every: int = 199) -> DataFrame:
    """The words of whole texts, one row an occurrence, thinned by `thinned`; a null text has none, a null id is empty.

    Other columns of docs are not looked at.
    """
    found = docs.select(F.col(id_col).alias("id"), F.explode(runs(F.col(text_col).cast("string"), least_length)).alias("run"))
    return found.select(thinned(F.col("id"), F.col("run"), every).alias("word"))


def op11_reduced_alphabet(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = vocabulary(document_words(table(spark, sf_dir, "documents")))
    return spelling_groups(words).select("word", "form", "root", "n", "n_near", "form_n")


def brute_force(docs: list[tuple[int | None, str | None]]) -> list[tuple]:
    """Sorted rows of the query, in plain Python: every word against every other of like length."""
    import re
    import zlib
    from collections import Counter

    count = Counter()
    for i, t in docs:
        for run in re.findall(RUNS, t or ""):
            run = run.translate(str.maketrans(UPPER, LOWER))
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            count[run if h % 199 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    n = {w: c for w, c in count.items() if len(w) >= 6 and c >= 5}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))

    by_size, close = {}, {w: [] for w in n}
    for w in n:
        by_size.setdefault(len(w), []).append(w)
    for size, some in by_size.items():
        for k, a in enumerate(some):
            for b in some[k + 1 :] + by_size.get(size + 1, []):
                if near(a, b):
                    close[a].append(b)
                    close[b].append(a)
    form = {}
    for w in n:
        best = min(close[w], key=lambda o: (-n[o], o), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), n[w], len(close[w]), n[form[w]] if form[w] is not None else None) for w in n)
