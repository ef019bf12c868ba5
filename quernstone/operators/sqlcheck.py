"""Checks of SQL texts by Spark's own analysis; nothing is run."""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VERDICTS = "position int, question string, sql string, valid boolean, error_class string, error string, seconds double, attempts int"
_RETRY = ("timeout", "timed out", "connection", "could not connect", "network", "reset by peer")


class NotOneStatement(ValueError):
    pass


def normalise(sql: str | None) -> str:
    """Trimmed, without a last semicolon; an empty text or an inner semicolon is refused, be it in a quoted text."""
    text = (sql or "").strip().rstrip(";").strip()
    if not text:
        raise NotOneStatement("empty statement")
    if ";" in text:
        raise NotOneStatement("several statements")
    return text


def portable(sql: str) -> str:
    """PostgreSQL's ::numeric without digits, which Spark would cut to whole numbers, as double."""
    return re.sub(r"::\s*(numeric|decimal)\b(?!\s*\()", "::double", sql, flags=re.IGNORECASE)


def table_names(sql: str) -> list[str]:
    """Names after FROM and JOIN, once each, in order."""
    found = re.findall(r"\b(?:from|join)\s+([A-Za-z_][\w.]*)", sql, flags=re.IGNORECASE)
    seen: dict[str, str] = {}
    for name in found:
        seen.setdefault(name.lower(), name)
    return list(seen.values())


@dataclass(frozen=True)
class Verdict:
    sql: str
    valid: bool
    error_class: str | None = None
    error: str | None = None
    seconds: float = 0.0
    attempts: int = 1


def validate(spark: SparkSession, sql: str | None, retries: int = 2, wait: float = 0.1) -> Verdict:
    """Analyses the statement as a subquery: a command there is a syntax error, and no action is called."""
    started = time.perf_counter()
    try:
        text = portable(normalise(sql))
    except NotOneStatement as e:
        return Verdict(sql or "", False, "NOT_ONE_STATEMENT", str(e))
    for attempt in range(1, retries + 2):
        try:
            _ = spark.sql(f"SELECT * FROM (\n{text}\n) AS q").schema
            return Verdict(text, True, seconds=time.perf_counter() - started, attempts=attempt)
        except PySparkException as e:
            said = str(e).splitlines()[0][:500]
            if attempt <= retries and any(w in said.lower() for w in _RETRY):
                time.sleep(wait * attempt)
                continue
            return Verdict(text, False, e.getCondition() or type(e).__name__, said, time.perf_counter() - started, attempt)
    raise AssertionError("not reached")


def validate_all(spark: SparkSession, pairs: Sequence[tuple[str, str]], workers: int = 4) -> DataFrame:
    """Verdicts of (question, sql) pairs, in their order."""
    with ThreadPoolExecutor(max(1, min(workers, len(pairs) or 1))) as pool:
        got = list(pool.map(lambda p: validate(spark, p[1]), pairs))
    return spark.createDataFrame([(i, q, sql, v.valid, v.error_class, v.error, v.seconds, v.attempts) for i, ((q, sql), v) in enumerate(zip(pairs, got, strict=True))], VERDICTS)


def repair(spark: SparkSession, verdicts: DataFrame, provider: Callable[[str, str, str], str]) -> DataFrame:
    """Verdicts with what a provider (question, sql, error) made of invalid statements; repaired is null where nothing was tried."""
    rows = []
    for r in verdicts.orderBy("position").collect():
        new = None if r.valid else provider(r.question, r.sql, r.error or "")
        good = validate(spark, new) if new else None
        rows.append((r.position, r.question, good.sql if good and good.valid else r.sql, r.valid or bool(good and good.valid), None if r.valid else bool(good and good.valid)))
    return spark.createDataFrame(rows, "position int, question string, sql string, valid boolean, repaired boolean")


def kept_pairs(repaired: DataFrame) -> DataFrame:
    """Pairs to write back: repaired ones replaced, those that stay invalid left out."""
    return repaired.where("valid").select("position", "question", "sql")


def summary(verdicts: DataFrame) -> DataFrame:
    n = F.count("*")
    return verdicts.agg(n.alias("total"), F.count_if("valid").alias("valid"), F.round(F.when(n > 0, 100 * F.count_if("valid") / n).otherwise(0.0), 2).alias("valid_percent"), F.round(F.avg("seconds"), 3).alias("mean_seconds"), F.count_if(F.col("attempts") > 1).alias("retried"))


def report(verdicts: DataFrame) -> str:
    s = summary(verdicts).first()
    lines = [f"statements: {s.total}", f"valid: {s.valid} ({s.valid_percent:.2f} %)", f"mean time: {s.mean_seconds or 0:.3f} s", f"retried: {s.retried}"]
    lines += [f"- {r.position}: {r.question}: {r.error_class}" for r in verdicts.where("NOT valid").orderBy("position").toLocalIterator()]
    return "\n".join(lines)


def clean_pair(sql):
    """A generated statement: white space collapsed, one semicolon at the end."""
    one = F.trim(F.regexp_replace(sql, r"\s+", " "))
    return F.when(one.endswith(";"), one).otherwise(F.concat(one, F.lit(";")))


def generate_pairs(domains: Iterable[tuple[str, str]], count: int, provider: Callable[[str, str, int], Sequence[tuple[str, str]]]) -> list[tuple[str, str, str]]:
    """(domain, question, sql) from a provider, `count` for each (domain, context)."""
    return [(d, q, s) for d, context in domains for q, s in list(provider(d, context, count))[:count]]
