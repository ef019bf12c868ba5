"""Language identification by hierarchical discrimination (operator 5).

A linear support vector machine first tells language families apart; inside a
family, one-versus-one machines separate the close languages.  Features are
hashed n-grams of the bytes of the lower-cased letters; a text above `PART`
bytes is read in parts, whose n-grams add up.  The machines are fit on a bounded
sample of labelled rows, at most `SAMPLE` a language and side, one task for each
machine; sides of different sizes weigh alike.  Prediction reads every whole
text in one pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table
from .textscan import released, slices, text_bytes

#: Rows of each language, and of each side of a machine, that it is fit on, at most.
SAMPLE = 1500
#: Bytes of text that are looked at together; memory follows it.
PART = 1 << 17
BINS = 1 << 13
GRAMS = (1, 2, 3, 4)
#: Families of common languages; any other language is in the family "other".
FAMILIES = {
    "germanic": ("en", "de", "nl", "af", "sv", "da", "no", "nb", "nn", "is", "lb"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "bg", "sr", "hr", "sl", "mk"),
    "uralic": ("fi", "et", "hu"),
    "baltic": ("lv", "lt"),
    "indic": ("hi", "bn", "mr", "ur", "pa", "gu", "ne"),
    "turkic": ("tr", "az", "kk", "uz"),
}
_FAMILY = {lang: family for family, langs in FAMILIES.items() for lang in langs}


def family(lang: str) -> str:
    return _FAMILY.get(lang, "other")


def _letters(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased letters of each row, with one space before the first word and between words."""
    a, b = int(offsets[0]), int(offsets[-1])
    x = np.full(b - a + len(offsets) - 1, 0x20, np.uint8)
    to = np.arange(b - a) + np.repeat(np.arange(1, len(offsets)), np.diff(offsets))
    x[to] = data[a:b]
    at = offsets - a + np.arange(len(offsets))
    upper = (x >= 0x41) & (x <= 0x5A)
    upper[1:] |= (x[:-1] == 0xC3) & (x[1:] >= 0x80) & (x[1:] <= 0x9E) & (x[1:] != 0x97)
    x[upper] += 0x20
    x[(x < 0x61) | ((x > 0x7A) & (x < 0x80))] = 0x20
    keep = x != 0x20
    keep[1:] |= x[:-1] != 0x20
    keep[at[:-1]] = True
    sums = np.concatenate([[0], np.cumsum(keep)])
    return x[keep], sums[at]


def grams(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each n the bins of all n-grams, the rows' offsets into them, and the places of n-grams that span two rows."""
    x, at = _letters(data, offsets)
    x = x.astype(np.uint32)
    for n in GRAMS:
        if len(x) < n:
            return
        h = np.full(len(x) - n + 1, n, np.uint32)
        for j in range(n):
            h *= np.uint32(0x01000193)
            h += x[j : len(x) - n + 1 + j]
            h ^= h >> np.uint32(15)
        h *= np.uint32(0x9E3779B1)
        h >>= np.uint32(32 - 13)
        across = (at[1:-1, None] - np.arange(1, n)).ravel()
        across = np.unique(across[(across >= 0) & (across < len(h))])
        yield h.view(np.int32), at, across


def _parts(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets with texts above PART bytes cut, and the row of each part."""
    pieces = np.maximum(1, -(-np.diff(offsets) // PART))
    row = np.repeat(np.arange(len(pieces)), pieces)
    cut = offsets[row] + PART * (np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces))
    return np.append(cut, offsets[-1]), row


def _sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of the rows' values; every row begins inside the values or is empty."""
    inside = at[:-1] < len(values)
    out = np.zeros(len(at) - 1)
    if inside.any():
        out[inside] = np.add.reduceat(values, at[:-1][inside], dtype=np.float64)
    return out


def _fit(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, c: float = 1.0, rounds: int = 12) -> np.ndarray:
    """Linear SVM with squared hinge loss on sparse rows (bins, values), by dual coordinate descent (Hsieh et al., 2008).

    The loss of a row is weighed so that both sides weigh alike.
    """
    rng, w, alpha = np.random.default_rng(5), np.zeros(BINS), np.zeros(len(rows))
    slack = 0.5 / (c * np.where(y > 0, len(y) / (2 * max(1, (y > 0).sum())), len(y) / (2 * max(1, (y < 0).sum()))))
    q = np.array([v @ v for _, v in rows]) + slack
    for _ in range(rounds):
        for i in rng.permutation(len(rows)):
            k, v = rows[i]
            new = max(0.0, alpha[i] - (y[i] * (w[k] @ v) - 1 + alpha[i] * slack[i]) / q[i])
            if new != alpha[i]:
                w[k] += (new - alpha[i]) * y[i] * v
                alpha[i] = new
    return w


class Hierarchy:
    """The machines: pairs of families, then pairs of languages in a family."""

    def __init__(self, langs: list[str]):
        self.langs = sorted(langs)
        self.families = sorted({family(x) for x in self.langs})
        self.pairs = [("family", a, b) for a, b in combinations(self.families, 2)]
        for f in self.families:
            self.pairs += [("lang", a, b) for a, b in combinations([x for x in self.langs if family(x) == f], 2)]
        self.weights = np.zeros((len(self.pairs), BINS), np.float32)

    def pairs_of(self, lang: str) -> list[tuple[int, int]]:
        """(machine, side) that a labelled row serves to fit."""
        out = []
        for k, (level, a, b) in enumerate(self.pairs):
            name = family(lang) if level == "family" else lang
            if name in (a, b):
                out.append((k, 1 if name == a else -1))
        return out

    def decide(self, margin: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Languages and scores of rows of margins: votes, then sums of margins, at each level."""
        rows = np.arange(len(margin))
        score = np.ones(len(margin))

        def vote(level: str, names: list[str], on: np.ndarray) -> np.ndarray:
            votes, sums = np.zeros((len(on), len(names))), np.zeros((len(on), len(names)))
            for k, (kind, a, b) in enumerate(self.pairs):
                if kind == level and a in names and b in names:
                    m = margin[on, k]
                    for name, v in ((a, m), (b, -m)):
                        votes[:, names.index(name)] += v > 0
                        sums[:, names.index(name)] += v
            best = np.argmax(votes + 1e-3 * np.tanh(sums), axis=1)
            for k, (kind, a, b) in enumerate(self.pairs):
                if kind == level and a in names and b in names:
                    for name, sign in ((a, 1), (b, -1)):
                        hit = best == names.index(name)
                        score[on[hit]] = np.minimum(score[on[hit]], 1 / (1 + np.exp(-2 * sign * margin[on[hit], k])))
            return best

        fam = vote("family", self.families, rows)
        out = np.empty(len(margin), object)
        for i, f in enumerate(self.families):
            own = [x for x in self.langs if family(x) == f]
            on = np.flatnonzero(fam == i)
            if len(on):
                out[on] = np.array(own, object)[vote("lang", own, on)]
        return out.tolist(), score


def _counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Counts of one text's n-grams by bin."""
    out = np.zeros(BINS, np.int64)
    cuts, _ = _parts(offsets)
    for a, b in slices(cuts, PART):
        for bins, _, across in grams(data, cuts[a : b + 1]):
            out += np.bincount(bins, minlength=BINS) - np.bincount(bins[across], minlength=BINS)
    return out


def _count_rows(batches):
    """(lang, at, bins, shares): the n-gram shares of labelled rows."""
    for batch in batches:
        data, offsets = text_bytes(batch.column(2))
        bins, shares = [], []
        for i in range(batch.num_rows):
            n = _counts(data, offsets[i : i + 2])
            k = np.flatnonzero(n)
            bins.append(k.astype(np.int16))
            shares.append((n[k] / max(1, n.sum())).astype(np.float32))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(bins, pa.list_(pa.int16())), pa.array(shares, pa.list_(pa.float32()))], names=["lang", "at", "bins", "shares"])


def fit(labelled: DataFrame, sample: int = SAMPLE) -> Hierarchy:
    """Machines from labelled rows (key, lang, text); at most `sample` rows of a language, and of a side, are used."""
    counts = {r.lang: r["count"] for r in labelled.groupBy("lang").count().collect()}
    model = Hierarchy(list(counts))
    if not model.pairs:
        return model
    spark = labelled.sparkSession
    # A hash of the key picks the rows; the limit below only trims what chance leaves over.
    share = F.create_map(*[F.lit(v) for lang, n in counts.items() for v in (lang, min(1.0, sample / n))])
    at = F.xxhash64(F.lit("language"), "key")
    picked = labelled.withColumn("at", at).where(F.pmod("at", F.lit(1 << 24)) < share[F.col("lang")] * (1 << 24))
    # A family's side is thinned before its rows are dealt to machines.
    of_family: dict[str, int] = {}
    for lang, n in counts.items():
        of_family[family(lang)] = of_family.get(family(lang), 0) + min(n, sample)
    part = lambda lang, k: min(1.0, sample / of_family[family(lang)]) if model.pairs[k][0] == "family" else 1.0
    jobs = spark.createDataFrame([(lang, k, side, part(lang, k)) for lang in model.langs for k, side in model.pairs_of(lang)], "lang string, machine int, side int, part double")
    rows = picked.select("lang", "at", "text").mapInArrow(released(_count_rows), "lang string, at bigint, bins array<smallint>, shares array<float>")
    dealt = rows.join(F.broadcast(jobs), "lang").where(F.pmod(F.xxhash64("at", "machine"), F.lit(1 << 24)) < F.col("part") * (1 << 24))

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["at", "lang"], kind="stable").groupby("side").head(sample)
        bins, shares = pdf["bins"].tolist(), pdf["shares"].tolist()
        mean = np.bincount(np.concatenate(bins), np.concatenate(shares), BINS) / len(bins)
        scale = 1 / np.sqrt(mean + 1e-6)
        w = _fit([(k, v * scale[k]) for k, v in zip(bins, shares, strict=True)], pdf["side"].to_numpy(float)) * scale
        return pd.DataFrame({"machine": [int(pdf["machine"].iloc[0])], "weights": [w.astype(np.float32)]})

    for r in dealt.groupBy("machine").applyInPandas(one, "machine int, weights array<float>").collect():
        model.weights[r.machine] = r.weights
    return model


def margins(data: np.ndarray, offsets: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Mean weights of the rows' n-grams, a column for each machine."""
    cuts, row = _parts(offsets)
    sums, total = np.zeros((len(offsets) - 1, len(weights))), np.zeros(len(offsets) - 1)
    for a, b in slices(cuts, PART):
        for bins, at, across in grams(data, cuts[a : b + 1]):
            crossed = np.bincount(np.searchsorted(at, across, "right") - 1, minlength=b - a)
            np.add.at(total, row[a:b], np.clip(np.minimum(at[1:], len(bins)) - at[:-1], 0, None) - crossed)
            for k, w in enumerate(weights):
                v = w[bins]
                v[across] = 0
                np.add.at(sums[:, k], row[a:b], _sums(v, at))
    return sums / np.maximum(total, 1)[:, None]


def predict(docs: DataFrame, model: Hierarchy, text_col: str = "text") -> DataFrame:
    """docs with lang_pred and score; `und` and 0 where the text is null or has no letter (Unicode category L)."""
    taken = {"lang_pred", "score"} & set(docs.columns)
    if taken:
        raise ValueError(f"columns are taken: {sorted(taken)}")
    at = docs.columns.index(text_col)
    schema = f"{docs.schema.simpleString()[7:-1]}, lang_pred string, score double"

    def run(batches):
        for batch in batches:
            texts = batch.column(at)
            some = pc.fill_null(pc.match_substring_regex(texts, r"\pL"), False).to_numpy(zero_copy_only=False)
            if model.langs:
                lang, score = model.decide(margins(*text_bytes(texts), model.weights))
                names, scores = np.where(some, np.array(lang, object), "und"), np.where(some, score, 0.0)
            else:
                names, scores = np.full(len(some), "und", object), np.zeros(len(some))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=[*batch.schema.names, "lang_pred", "score"])

    return docs.mapInArrow(released(run), schema)


def held_out(id_col: str = "doc_id"):
    """True where the documents' checksum keeps them from being learned from; a null id is not held out, nor learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE) -> DataFrame:
    """docs with held_out, lang_pred and score.

    The machines learn from rows with an id, a language and a text that are
    not held out.  Only the text is an input of a prediction.  Repeated rows
    get equal results; with no labelled row every prediction is `und`.
    """
    taken = {"held_out", "lang_pred", "score"} & set(docs.columns)
    if taken:
        raise ValueError(f"columns are taken: {sorted(taken)}")
    learn = docs.where(F.col(id_col).isNotNull() & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & ~held_out(id_col))
    model = fit(learn.select(F.col(id_col).cast("string").alias("key"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")), sample)
    return predict(docs.withColumn("held_out", held_out(id_col)), model, text_col)


def op5_language_id(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    learn = docs.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    model = fit(learn.select(F.col("doc_id").cast("string").alias("key"), "lang", "text"))
    return predict(docs.select("doc_id", held_out().alias("held_out"), "text"), model).select("doc_id", "held_out", "lang_pred", "score")
