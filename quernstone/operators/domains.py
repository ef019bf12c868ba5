"""Business domains of tables, and the pairs of tables that they make."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DOMAINS = "domain string, rank int, database string, schema string, table string"
UNSORTED = "_未分类_"


def domain_rows(spark: SparkSession, domains: Sequence[tuple[str, Sequence[str]]], database: str = "db", schema: str = "public") -> DataFrame:
    """(domain, rank, database, schema, table) from (name, tables); names of one or two parts are filled up to three."""
    rows = []
    for i, (name, tables) in enumerate(domains):
        for t in dict.fromkeys(x.casefold() for x in tables):
            parts = t.split(".")
            rows.append((name, i, *([database.casefold(), schema.casefold()][: 3 - len(parts)] + parts)[-3:]))
    return spark.createDataFrame(rows, DOMAINS)


def table_pairs(tables: DataFrame, domains: DataFrame | None = None, cross: bool = False) -> DataFrame:
    """(left, right, domain) of table names: all pairs, or those inside a domain, and with `cross` also between domains.

    A pair in several domains is listed for each; pairs across domains are
    listed once, ordered by name, if no domain has them.
    """
    t = tables.select(F.concat_ws(".", F.lower("database"), F.lower("schema"), F.lower("table")).alias("key"), F.concat_ws(".", "schema", "table").alias("name"))
    if domains is None:
        a, b = t.select(F.col("name").alias("left")), t.select(F.col("name").alias("right"))
        return a.join(b, F.col("left") < F.col("right")).select("left", "right", F.lit(None).cast("string").alias("domain"))
    d = domains.select("domain", F.concat_ws(".", F.lower("database"), F.lower("schema"), F.lower("table")).alias("key")).join(t, "key").select("domain", "name").distinct()
    a, b = d.select("domain", F.col("name").alias("left")), d.select("domain", F.col("name").alias("right"))
    inside = a.join(b, "domain").where(F.col("left") < F.col("right")).select("left", "right", "domain")
    if not cross:
        return inside
    x, y = a.toDF("d1", "n1"), b.toDF("d2", "n2")
    between = x.join(y, (F.col("d1") < F.col("d2")) & (F.col("n1") != F.col("n2"))).select(F.least("n1", "n2").alias("left"), F.greatest("n1", "n2").alias("right")).distinct()
    new = between.join(inside.select("left", "right").distinct(), ["left", "right"], "left_anti")
    return inside.unionAll(new.select("left", "right", F.lit(None).cast("string")))


def chosen(domains: DataFrame, wanted: str | None) -> DataFrame:
    """None or ``all``: every domain but the unsorted one stays in; else those named, with commas between them."""
    if wanted in (None, "all"):
        return domains
    return domains.where(F.col("domain").isin(*[w.strip() for w in wanted.split(",")]))


def normalised_domains(proposed: Sequence[dict], tables: Sequence[str], most: int = 3) -> list[tuple[str, str, list[str]]]:
    """(name, description, tables) of proposals: known tables only, at most `most` domains for each, the unsorted domain first."""
    known, used = {t.casefold(): t for t in tables}, {}
    out = []
    for p in proposed:
        name = str(p.get("name") or "").strip()
        if not name or name == UNSORTED:
            continue
        mine = []
        for t in p.get("tables") or []:
            t = known.get(str(t).casefold())
            if t and t not in mine and used.get(t, 0) < most:
                mine.append(t)
                used[t] = used.get(t, 0) + 1
        out.append((name, str(p.get("description") or ""), mine))
    return [(UNSORTED, "", [t for t in tables if t not in used]), *out]


def domain_context(texts: DataFrame, detail: str = "first") -> DataFrame:
    """One row, context: a line for each table by name; detail is name, first (200 characters of the first line) or full (2000)."""
    name = F.concat_ws(".", "schema", "table")
    first = F.substring(F.substring_index("text", "\n", 1), 1, 200)
    shown = {"name": name, "first": F.concat_ws(": ", name, first), "full": F.concat_ws("\n", name, F.substring("text", 1, 2000))}[detail]
    return texts.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(name.alias("n"), shown.alias("s")))), lambda x: x["s"]), "\n").alias("context"))
