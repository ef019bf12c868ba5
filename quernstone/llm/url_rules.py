"""URL filtering by mined association rules (operator 9), DataFrame and Spark ML operations only.

Given host and path rules come first; the longest that fits decides.  Other
URLs are judged by association rules: FP-growth finds combinations of URL
tokens that go along with a bad label; those with enough support, confidence
and lift over the base rate, beyond chance, are matched through an inverted index from each
rule's rarest token.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import small, stash, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BAD = "label=bad"
#: (verdict, host, path)
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    authority = F.regexp_extract(rest, r"^[^/?#]*", 0)
    after = F.substring(rest, F.length(authority) + 1, F.length(rest))
    none = F.lit("")
    return F.coalesce(F.translate(authority, UPPER, LOWER), none), F.coalesce(F.regexp_extract(after, r"^[^?#]*", 0), none)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits host and path; null if none does."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1], r[2])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        text, verdict = F.when(fits, F.lit(h + p)).otherwise(text), F.when(fits, F.lit(v)).otherwise(verdict)
    return text, verdict


def tokens(url: Column) -> Column:
    """The distinct tokens of a URL: host labels, path segments with digits as #, query keys."""
    host, path = host_and_path(url)
    part = lambda name, pieces: F.transform(F.filter(pieces, lambda x: x != ""), lambda x: F.concat(F.lit(name), x))
    query = F.regexp_extract(url, r"^[^#]*?\?([^#]*)", 1)
    return F.array_distinct(
        F.concat(
            part("host=", F.split(host, r"\.")),
            part("path=", F.split(F.regexp_replace(path, r"[0-9]+", "#"), "/")),
            part("query=", F.transform(F.split(query, "&"), lambda x: F.split(x, "=")[0])),
            F.array(F.concat(F.lit("scheme="), F.substring_index(url, "://", 1))),
        )
    )


def together(baskets: DataFrame, least: float) -> DataFrame:
    """(stand, items): items of at least that many baskets (row, items), those that the same baskets hold being one, under the first of them.

    Baskets of an item are told apart by their number and 128 bits of hashes.
    """
    held = baskets.select("row", F.explode("items").alias("item"))
    mark = lambda seed: F.bit_xor(F.xxhash64(F.lit(seed), "row"))
    each = held.groupBy("item").agg(F.count("*").alias("n"), mark(3).alias("a"), mark(5).alias("b")).where(F.col("n") >= least)
    return each.groupBy("n", "a", "b").agg(F.array_sort(F.collect_list("item")).alias("items")).select(F.col("items")[0].alias("stand"), "items")


def beyond_chance(bad: Column, n: Column, z: float) -> Column:
    """The lower end of the Wilson interval of bad among n."""
    p, zz = bad / n, F.lit(z * z)
    return (p + zz / (2 * n) - F.lit(z) * F.sqrt(p * (1 - p) / n + zz / (4 * n * n))) / (1 + zz / n)


def _unbeaten(sets: DataFrame) -> DataFrame:
    """sets (items, confidence) for which none of fewer of their items is at least as confident.

    All parts of a set are among the sets, so they are looked up size by size,
    each set under its parts of one item less, which carry the best of theirs.
    """
    sets = stash(sets.withColumn("size", F.size("items")))
    largest = sets.agg(F.max("size")).first()[0] or 0
    best = stash(sets.where("size = 1").select("items", F.col("confidence").alias("best")))
    kept = sets.where("size = 1").drop("size")
    for size in range(2, largest + 1):
        mine = sets.where(F.col("size") == size).drop("size")
        parts = mine.select(F.col("items").alias("whole"), F.explode(F.transform("items", lambda x: F.array_remove("items", x))).alias("items"))
        below = parts.join(best, "items").groupBy(F.col("whole").alias("items")).agg(F.max("best").alias("below"))
        judged = stash(mine.join(below, "items", "left"))
        kept = kept.unionByName(judged.where(F.col("below").isNull() | (F.col("below") < F.col("confidence"))).drop("below"))
        best = stash(judged.select("items", F.greatest("confidence", "below").alias("best")))
    return kept


def mine(labelled: DataFrame, support: float = 0.01, confidence: float = 0.5, lift: float = 1.5, z: float = 3.29) -> DataFrame:
    """Rules (rule_id, items, confidence, support, lift) of labelled URLs (items array, bad boolean).

    A rule holds for a share of `support` of the labelled URLs, at every size
    of input, and what it holds for is bad `lift` times as often as a labelled
    URL is, beyond chance: by the lower end of an interval of z standard errors
    (3.29 leaves out one chance rule in a thousand and more).  It is pruned if
    a rule with fewer of its items is at least as confident.  Items that always
    stand together, as the segments of a template do, are mined as one, and
    stand together in the rule.
    """
    spark = labelled.sparkSession
    none = spark.createDataFrame([], "rule_id bigint, items array<string>, confidence double, support double, lift double")
    baskets = stash(labelled.where("size(items) > 0").select(F.monotonically_increasing_id().alias("row"), "items", "bad"))
    total, bad = baskets.agg(F.count("*"), F.count_if("bad")).first()
    if not bad:
        return none
    stands = stash(together(baskets, support * total))
    few = small(stands.select(F.col("stand").alias("item")))
    short = baskets.select("row", F.explode("items").alias("item")).join(few, "item").groupBy("row").agg(F.collect_list("item").alias("items"))
    short = baskets.select("row", "bad").join(short, "row", "left").select(F.concat(F.coalesce("items", F.array().cast("array<string>")), F.when(F.col("bad"), F.array(F.lit(BAD))).otherwise(F.array().cast("array<string>"))).alias("items"))
    sets = stash(FPGrowth(itemsCol="items", minSupport=support).fit(stash(short)).freqItemsets.select(F.array_sort("items").alias("items"), "freq"))
    with_bad = sets.where(F.array_contains("items", BAD) & (F.size("items") > 1)).select(F.array_remove("items", BAD).alias("items"), F.col("freq").alias("n_bad"))
    found = with_bad.join(sets.withColumnRenamed("freq", "n"), "items")
    found = _unbeaten(found.select("items", (F.col("n_bad") / F.col("n")).alias("confidence"), "n_bad", "n"))
    rate = bad / total
    found = found.where((F.col("confidence") >= confidence) & (F.col("confidence") >= lift * rate) & (beyond_chance(F.col("n_bad"), F.col("n"), z) >= lift * rate))
    found = found.withColumn("rule", F.monotonically_increasing_id())
    found = stash(found)
    whole = found.select("rule", F.explode("items").alias("stand")).join(stands, "stand").groupBy("rule").agg(F.array_sort(F.flatten(F.collect_list("items"))).alias("all"))
    return found.join(whole, "rule").select(F.xxhash64("all").alias("rule_id"), F.col("all").alias("items"), "confidence", (F.col("n_bad") / total).alias("support"), (F.col("confidence") / rate).alias("lift"))


def match(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The distinct urls (url, items) that a rule matches, by an inverted index.

    A rule is indexed under its item that the fewest URLs hold; only URLs with
    that item are compared with it.
    """
    item = rules.select("rule_id", "items", F.explode("items").alias("item"))
    held = urls.select(F.explode("items").alias("item"))
    items = stash(item.select("item").distinct())
    count = held.join(small(items), "item").groupBy("item").count()
    best = Window.partitionBy("rule_id").orderBy("count", "item")
    index = stash(item.join(count, "item").withColumn("at", F.row_number().over(best)).where("at = 1").select("item", F.col("items").alias("rule_items")))
    near = urls.select("url", "items", F.explode("items").alias("item")).join(small(index), "item")
    return near.where(F.size(F.array_except("rule_items", "items")) == 0).select("url").distinct()


def baskets(labels: DataFrame) -> DataFrame:
    """(items, bad) of labelled URLs (url, bad); null URLs and labels are left out."""
    return labels.where(F.col("url").isNotNull() & F.col("bad").isNotNull()).select(tokens(F.col("url")).alias("items"), "bad")


def url_filter(pages: DataFrame, labels: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, url_col: str = "url", **mining) -> DataFrame:
    """pages with host, path, rule and verdict (allow or block).

    labels: url, bad (boolean).  A null URL, or one without ``://``, has an
    empty host and path, fits no rule and is allowed unless mined rules match
    its tokens; a null URL has no tokens.  Without labels nothing is mined.
    """
    taken = {"host", "path", "rule", "verdict", "_url", "_found"} & set(pages.columns)
    if taken:
        raise ValueError(f"columns are taken: {sorted(taken)}")
    mined = stash(mine(baskets(labels), **mining))
    pages = pages.withColumn("_url", F.col(url_col).cast("string"))
    # Only the few URLs that a rule matches are joined, so null and common ones make no hot key.
    urls = stash(pages.where(F.col("_url").isNotNull()).select(F.col("_url").alias("url")).distinct().withColumn("items", tokens(F.col("url"))))
    found = match(urls, mined).select(F.col("url").alias("_url"), F.lit(True).alias("_found"))
    host, path = host_and_path(F.col("_url"))
    text, verdict = rule_of(host, path, rules)
    out = pages.join(small(stash(found)), "_url", "left")
    return out.withColumns({"host": host, "path": path, "rule": text, "verdict": F.coalesce(verdict, F.when(F.col("_found"), "block").otherwise("allow"))}).drop("_url", "_found")


def page_labels(pages: DataFrame, marks: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """(url, bad) of pages (page_id, url): what a given rule says of the page, else what marks (page_id, bad) says."""
    host, path = host_and_path(F.col("url"))
    told = rule_of(host, path, rules)[1]
    once = marks.groupBy("page_id").agg(F.max("bad").alias("bad"))
    return pages.join(once, "page_id", "left").select("url", F.coalesce(told == "block", "bad").alias("bad")).where("bad IS NOT NULL")


def op9_url_rules(spark, sf_dir: str) -> DataFrame:
    """Labelled are the pages that a given rule decides, and the others by the label of their number: bad is toxic or of low quality."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    marks = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    return url_filter(pages, page_labels(pages, marks)).select("page_id", "host", "path", "rule", "verdict")
