"""Metadata that was written before: JSON profiles, Markdown, domain and dimension settings."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dimvalues import embedding_columns

_LINE = r"^- (\S+) \(.*?\) - (.*?)(?: \[示例.*)?$"


def profiles(folder: str) -> dict[str, dict]:
    """Metadata documents by schema.table; templates are left out, documents without a schema and a table refused."""
    out = {}
    for path in sorted(Path(folder).glob("*.json")):
        if path.name.startswith("_template"):
            continue
        doc = json.loads(path.read_text(encoding="utf-8"))
        info = doc.get("table_info") or {}
        if not info.get("schema_name") or not info.get("table_name"):
            raise ValueError(f"{path.name} names no schema and table")
        out[f"{info['schema_name']}.{info['table_name']}"] = doc
    return out


def profile_rows(spark: SparkSession, path: str) -> DataFrame:
    """Columns of metadata documents as rows, read by Spark."""
    docs = spark.read.option("multiLine", True).json(path).select("table_info.schema_name", "table_info.table_name", F.to_json("column_profiles").alias("c"))
    one = "struct<data_type:string,comment:string,semantic_analysis:struct<semantic_role:string,semantic_confidence:double>,statistics:struct<uniqueness:double,null_rate:double,unique_count:bigint,sample_count:bigint>>"
    rows = docs.select(F.col("schema_name").alias("schema"), F.col("table_name").alias("table"), F.explode(F.from_json("c", f"map<string,{one}>")).alias("column", "p"))
    return rows.select("schema", "table", "column", "p.data_type", "p.comment", F.col("p.semantic_analysis.semantic_role").alias("role"), "p.statistics.*")


def column_comments(texts: DataFrame) -> DataFrame:
    """(schema, table, column, comment) from Markdown texts (schema, table, text): lines of the field section."""
    section = F.split(F.split("text", "## 字段列表")[1], "\n## ")[0]
    lines = texts.select("schema", "table", F.explode(F.split(section, "\n")).alias("line")).where(F.col("line").startswith("- "))
    out = lines.select("schema", "table", F.regexp_extract("line", _LINE, 1).alias("column"), F.trim(F.regexp_extract("line", _LINE, 2)).alias("comment"))
    return out.where("column <> ''")


def settings(path: str) -> dict:
    """A YAML or JSON file."""
    text = Path(path).read_text(encoding="utf-8")
    if path.endswith(".json"):
        return json.loads(text)
    import yaml

    return yaml.safe_load(text) or {}


_VARIABLE = re.compile(r"\$\{(\w+)(?::([^}]*))?\}")


def with_variables(value, variables: dict[str, str]):
    """${NAME} and ${NAME:default} in all texts; values stay texts.  An unknown name without a default is an error."""
    if isinstance(value, dict):
        return {k: with_variables(v, variables) for k, v in value.items()}
    if isinstance(value, list):
        return [with_variables(v, variables) for v in value]
    if not isinstance(value, str):
        return value

    def one(m: re.Match) -> str:
        found = variables.get(m[1], m[2])
        if found is None:
            raise KeyError(m[1])
        return found

    return _VARIABLE.sub(one, value)


def domains(doc: dict) -> list[tuple[str, list[str]]]:
    """(name, tables) of a domain document."""
    return [(d["name"], list(d.get("tables") or [])) for d in doc.get("domains") or []]


@dataclass(frozen=True)
class DimTable:
    database: str
    schema: str
    table: str
    columns: tuple[str, ...]


def dim_tables(doc: dict) -> list[DimTable]:
    """Dimension tables of a document; those without embedding columns are listed with none."""
    out = []
    for database, d in (doc.get("databases") or {}).items():
        for name, t in ((d or {}).get("tables") or {}).items():
            schema, _, table = name.rpartition(".")
            out.append(DimTable(database, schema or "public", table, tuple(embedding_columns((t or {}).get("embedding_col")))))
    return out
