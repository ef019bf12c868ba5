"""Similarity join of names by the matching-blocks ratio.

The ratio is twice the matching characters over the characters of both names,
and no more characters match than the names have in common, each as often as it
stands in both.  With occurrences told apart (``a1``, ``a2``) a name is a set,
and a pair above the threshold shares at least ``threshold * (m + n) / 2`` of
its tokens.  Of two sets that share so many, the parts with the rarest tokens
share some `size`, so names are joined on every choice of that many tokens of
that part: single letters are too common to join on, choices of several are
not.  Up to three are taken, and up to five where the threshold is high, as the
part is short then.  What is left is tested on the bound, then on the ratio.
"""

from __future__ import annotations

from difflib import SequenceMatcher
from itertools import combinations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Pairs of names with more letters than that are joined on single tokens.
LONG = 80
_EPS = 1e-9


@F.pandas_udf(T.DoubleType())
def matching_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([1.0 if x == y else SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b, strict=True)], dtype="float64")


def _up(x: float) -> int:
    return int(-(-(x - _EPS) // 1))


def required(m: int, n: int, threshold: float) -> int:
    """Tokens that names of m and n letters share at least, if their ratio reaches the threshold."""
    return max(_up(threshold * (m + n) / 2), 1)


def partners(n: int, threshold: float) -> range:
    """Lengths that a name of n letters can be paired with."""
    return range(max(_up(threshold * n / (2 - threshold)), 1), int(n * (2 - threshold) / threshold + _EPS) + 1)


def size_of(m: int, n: int, threshold: float) -> int:
    """How many tokens names of m and n letters are joined on."""
    return 1 if m + n > LONG else min(required(m, n, threshold), 5 if threshold >= 0.8 else 3)


def signatures(tokens: list[str], threshold: float) -> list[str]:
    """What a name is joined on; tokens stand rarest first.

    For each size: the shortest part of which any partner of that size must
    share so many tokens.
    """
    n, least = len(tokens), {}
    for m in partners(n, threshold):
        size = size_of(m, n, threshold)
        least[size] = min(least.get(size, n), required(m, n, threshold))
    return [f"{size}|" + " ".join(some) for size, need in least.items() for some in combinations(sorted(tokens[: n - need + size]), size)]


def _tokens(name: str):
    letters = F.split(F.col(name), "")
    return F.transform(letters, lambda c, i: F.concat(c, F.size(F.filter(F.slice(letters, 1, i + 1), lambda x: x == c)).cast("string")))


def similar_names(sources: DataFrame, targets: DataFrame, threshold: float) -> DataFrame:
    """(a, b, ratio) of the names (column name) of sources and targets whose ratio, in that order, reaches the threshold.

    Names are compared trimmed and in lower case, each distinct one once.
    Empty and null names are like nothing but themselves, and left out.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be above 0, and 1 at most")
    clean = lambda df, c: df.select(F.lower(F.trim("name")).alias(c)).where(F.col(c) != "").distinct().withColumn("tokens", _tokens(c))
    a, b = clean(sources, "a"), clean(targets, "b")
    each = lambda df, c: df.select(c, F.explode("tokens").alias("token"))
    common = each(a, "a").select("token").unionAll(each(b, "b").select("token")).groupBy("token").agg(F.count("*").alias("uses"))

    @F.udf("array<string>", useArrow=True)
    def marks(tokens: list[str]) -> list[str]:
        return signatures(list(tokens), threshold)

    def marked(df: DataFrame, c: str) -> DataFrame:
        ranked = each(df, c).join(common, "token").groupBy(c).agg(F.array_sort(F.collect_list(F.struct("uses", "token"))).alias("ranked"))
        tokens = F.transform("ranked", lambda x: x["token"])
        return ranked.select(c, tokens.alias(f"{c}_tokens"), F.explode(marks(tokens)).alias("mark"))

    pairs = marked(a, "a").join(marked(b, "b"), "mark").drop("mark")
    shared = F.size(F.array_intersect("a_tokens", "b_tokens"))
    pairs = pairs.where(2 * shared + _EPS >= threshold * (F.size("a_tokens") + F.size("b_tokens"))).select("a", "b").distinct()
    return pairs.withColumn("ratio", matching_ratio("a", "b")).where(F.col("ratio") >= threshold)
