"""Values of dimension columns, cleaned and made distinct, and their vectors."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_LENGTH = 1024

Provider = Callable[[list[str]], Sequence[Sequence[float]]]


def embedding_columns(spec: str | Iterable[str] | None) -> list[str]:
    """None, a list, or names with commas between them."""
    parts = spec.split(",") if isinstance(spec, str) else list(spec or [])
    return [p.strip() for p in parts if p and p.strip()]


def dim_values(df: DataFrame, table: str, columns: str | Iterable[str] | None, max_length: int = MAX_LENGTH, limit: int | None = None) -> DataFrame:
    """(table_name, column_name, value): trimmed, not blank, cut at max_length code points, distinct.

    The text is cut before values are made distinct, so the shuffle carries no
    more than it must.  A limit keeps the smallest values of each column.
    """
    names = embedding_columns(columns)
    pairs = [F.struct(F.lit(c).alias("column_name"), F.substring(F.trim(F.col(f"`{c}`").cast("string")), 1, max_length).alias("value")) for c in names]
    if not pairs:
        return df.sparkSession.createDataFrame([], "table_name string, column_name string, value string")
    out = df.select(F.inline(F.array(*pairs))).where("length(value) > 0").distinct()
    if limit is not None:
        # The heap of a limit holds `limit` rows for each task; there is one per column.
        parts = [out.where(F.col("column_name") == c).orderBy("value").limit(limit) for c in names]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionAll(p)
    return out.select(F.lit(table).alias("table_name"), "column_name", "value")


def dim_value_counts(df: DataFrame, table: str, columns: str | Iterable[str] | None, max_length: int = MAX_LENGTH) -> DataFrame:
    """For each column the values loaded and those skipped as blank or null."""
    names = embedding_columns(columns)
    values = dim_values(df, table, names, max_length).groupBy("column_name").agg(F.count("*").alias("loaded"))
    pairs = [F.struct(F.lit(c).alias("column_name"), F.coalesce(F.length(F.trim(F.col(f"`{c}`").cast("string"))) == 0, F.lit(True)).alias("blank")) for c in names]
    seen = df.select(F.inline(F.array(*pairs))).groupBy("column_name").agg(F.count_if("blank").alias("skipped"))
    return seen.join(values, "column_name", "left").select(F.lit(table).alias("table_name"), "column_name", F.coalesce("loaded", F.lit(0)).alias("loaded"), "skipped")


def embedded(texts: DataFrame, column: str, provider: Provider, batch: int = 50, retries: int = 2, wait: float = 0.0) -> DataFrame:
    """texts with `embedding` (null where the provider failed for good).

    Each distinct text is sent once.  Batches are tried again with growing
    waits; a batch that still fails gets nulls and does not stop the job.
    """
    def run(frames):
        for f in frames:
            values = f["_text"].tolist()
            vectors: list = []
            for i in range(0, len(values), batch):
                part = values[i : i + batch]
                got = [None] * len(part)
                for attempt in range(retries + 1):
                    try:
                        got = [[float(x) for x in v] for v in provider(part)]
                        break
                    except Exception:
                        time.sleep(wait * 2**attempt)
                vectors += got
            yield pd.DataFrame({"_text": values, "embedding": vectors})

    distinct = texts.select(F.col(column).alias("_text")).where("_text IS NOT NULL").distinct()
    found = distinct.mapInPandas(run, "_text string, embedding array<float>")
    return texts.join(found, texts[column] == found["_text"], "left").drop("_text")
