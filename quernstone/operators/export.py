"""What is published: DDL, Markdown, JSON profiles and relationships, a Cypher script, summaries.

Metadata is small: texts are put together in the driver from rows that were
computed in Spark.  Tables of values go out through Spark's writers.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from datetime import datetime
from pathlib import Path

from pyspark.sql import Column as SqlColumn
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.catalog import Column, Table

SAMPLES = 5
CELL = 200


def safe_text(value: SqlColumn, n: int = 100) -> SqlColumn:
    """'' for null; longer texts are cut at n and end in ``...``."""
    text = F.coalesce(value.cast("string"), F.lit(""))
    return F.when(F.length(text) > n, F.concat(F.substring(text, 1, n), F.lit("..."))).otherwise(text)


def cell(df: DataFrame, name: str) -> SqlColumn:
    """A value as it is shown: null stays, bytes by their number, complex ones as JSON, other ones as text."""
    c, kind = F.col(f"`{name}`"), df.schema[name].dataType
    if isinstance(kind, T.BinaryType):
        return F.when(c.isNotNull(), F.concat(F.lit("<binary:"), F.octet_length(c).cast("string"), F.lit(" bytes>")))
    text = F.to_json(c) if isinstance(kind, T.ArrayType | T.MapType | T.StructType) else c.cast("string")
    return F.when(c.isNotNull(), safe_text(text, CELL))


def sample_rows(df: DataFrame, n: int = SAMPLES, by: Sequence[str] = ()) -> list[dict]:
    """The first n rows that are not all null, as texts; ordered by `by` if given."""
    rows = df.na.drop("all")
    rows = rows.orderBy(*by) if by else rows
    return [r.asDict() for r in rows.limit(n).select(*[cell(df, c).alias(c) for c in df.columns]).collect()]


def type_text(c: Column) -> str:
    """varchar(32), numeric(10,2) and the like."""
    if c.char_length:
        return f"{c.data_type}({c.char_length})"
    if c.precision:
        return f"{c.data_type}({c.precision},{c.scale})" if c.scale else f"{c.data_type}({c.precision})"
    return c.data_type


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def ddl(t: Table, samples: Iterable[dict] = (), stamp: datetime | None = None) -> str:
    """CREATE TABLE with constraints, comments, indexes (unique ones too) and a block of sample rows."""
    rule = "-- " + "=" * 36
    head = [rule, f"-- Database: {t.database}", f"-- Table: {t.full_name}", *([f"-- Comment: {t.comment}"] if t.comment else []), *([f"-- Generated: {stamp:%Y-%m-%d %H:%M:%S}"] if stamp else []), rule, ""]
    items = []
    for c in t.columns:
        text = type_text(c)
        items.append(f"    {c.name} {text[: len(c.data_type)].upper()}{text[len(c.data_type) :]}" + " NOT NULL" * (not c.nullable) + (f" DEFAULT {c.default}" if c.default else ""))
    words = {"pk": "PRIMARY KEY", "uk": "UNIQUE", "fk": "FOREIGN KEY"}
    for kind, word in words.items():
        for k in t.of_kind(kind):
            ref = f" REFERENCES {k.ref[0]}.{k.ref[1]} ({', '.join(k.ref[2])})" if k.ref else ""
            items.append(f"    CONSTRAINT {k.name or f'{t.name}_{kind}'} {word} ({', '.join(k.columns)}){ref}")
    body = [f"CREATE TABLE IF NOT EXISTS {t.full_name} (", ",\n".join(items), ");", ""]
    notes = [f"COMMENT ON COLUMN {t.full_name}.{c.name} IS {quoted(c.comment)};" for c in t.columns if c.comment]
    body += ["-- Column Comments", *notes, ""] if notes else []
    indexes = [f"CREATE {'UNIQUE ' * k.unique}INDEX {k.name or f'{t.name}_idx'} ON {t.full_name}({', '.join(k.columns)});" for k in t.of_kind("index")]
    body += ["-- Indexes", *indexes, ""] if indexes else []
    body += ["-- Table Comment", f"COMMENT ON TABLE {t.full_name} IS {quoted(t.comment)};"] if t.comment else []
    records = [{"label": f"Record {i + 1}", "data": r} for i, r in enumerate(samples)]
    block = ["", "/* SAMPLE_RECORDS", json.dumps({"version": 1, "table": t.full_name, "records": records}, ensure_ascii=False, indent=2), "*/"] if records else []
    return "\n".join([*head, *body, *block])


def markdown(t: Table, samples: Sequence[dict] = ()) -> str:
    """Title, one line for each column with up to two examples, then keys, indexes and precisions."""
    lines = [f"# {t.full_name}" + (f"（{t.comment}）" if t.comment else ""), "## 字段列表："]
    for c in t.columns:
        seen = list(dict.fromkeys(str(r[c.name]) for r in samples if r.get(c.name) not in (None, "")))[:2]
        lines.append(f"- {c.name} ({type_text(c).lower()}) - {c.comment or '无注释'} [示例: {', '.join(seen) or 'null'}]")
    more = [f"- 主键约束 {k.name}: {', '.join(k.columns)}" for k in t.of_kind("pk")]
    more += [f"- 外键约束 {', '.join(k.columns)} 关联 {k.ref[0]}.{k.ref[1]}.{', '.join(k.ref[2])}" for k in t.of_kind("fk")]
    more += [f"- 唯一约束 {k.name}: {', '.join(k.columns)}" for k in t.of_kind("uk")]
    more += [f"- 索引 {k.name} ({k.method}): {', '.join(k.columns)}" for k in t.of_kind("index") if not k.unique]
    more += [f"- {c.name} 使用{c.data_type}({c.precision},{c.scale})存储，精确到小数点后{c.scale}位" for c in t.columns if c.precision and c.scale]
    return "\n".join([*lines, *(["## 字段补充说明：", *more] if more else [])])


def _number(text):
    """Texts that are numbers as numbers, in sample records."""
    if isinstance(text, str):
        for kind in (int, float):
            try:
                return kind(text)
            except ValueError:
                continue
    return text


def profile_json(t: Table, roles: Sequence, table_row, keys: Sequence = (), samples: Sequence[dict] = (), stamp: str = "") -> dict:
    """Metadata document 2.0 of one table: roles are rows of column_roles, table_row one of table_category."""
    columns = {}
    for r in roles:
        x = r.asDict(recursive=True)
        flags = {k: v for k, v in x.items() if k.startswith("is_") and isinstance(v, bool)}
        stats = {k: x[k] for k in ("sample_count", "null_count", "null_rate", "unique_count", "uniqueness", "avg_length", "min_length", "max_length", "median_length", "length_std", "value_distribution") if x.get(k) is not None}
        stats |= {n: x[f"{n}_value"] for n in ("min", "max") if x.get(f"{n}_value") is not None} | ({"mean": x["mean_value"]} if x.get("mean_value") is not None else {})
        c = t.column(x["column"])
        columns[x["column"]] = {
            "column_name": x["column"], "ordinal_position": x["ordinal"], "data_type": x["data_type"], "character_maximum_length": c.char_length, "numeric_precision": c.precision, "numeric_scale": c.scale,
            "is_nullable": c.nullable, "column_default": c.default, "comment": c.comment, "statistics": stats,
            "semantic_analysis": {"semantic_role": x["role"], "semantic_confidence": x["confidence"], "inference_basis": x["basis"].split(",")},
            "role_specific_info": {k: x[k] for k in ("metric_category", "metric_aggregations", "datetime_grain", "audit_type", "audit_purpose", "enum_values", "identifier_keyword", "is_surrogate") if x.get(k) is not None},
            "structure_flags": flags,
        }
    named = lambda kind: [{"constraint_name": k.name, "columns": list(k.columns)} for k in t.of_kind(kind)]
    pk = named("pk")
    fks = [{"constraint_name": k.name, "source_columns": list(k.columns), "target_schema": k.ref[0], "target_table": k.ref[1], "target_columns": list(k.ref[2])} for k in t.of_kind("fk")]
    summary = {k: v for k, v in table_row.asDict().items() if k.endswith("_count") or k == "total_columns"}
    return {
        "metadata_version": "2.0", "generated_timestamp": stamp,
        "table_info": {"database": t.database, "schema_name": t.schema, "table_name": t.name, "comment": t.comment, "total_rows": max((r.sample_count for r in roles), default=0), "total_columns": len(t.columns)},
        "column_profiles": columns,
        "table_profile": {
            "table_category": table_row.category, "confidence": table_row.confidence, "inference_basis": [b for b in table_row.basis.split(",") if b], "column_statistics": summary,
            "physical_constraints": {"primary_key": pk[0] if pk else None, "unique_constraints": named("uk"), "foreign_keys": fks},
            "indexes": [{"index_name": k.name, "columns": list(k.columns), "is_unique": k.unique, "index_type": k.method} for k in t.of_kind("index")],
            "unique_column_sets": [{"columns": list(k.columns), "confidence_score": k.confidence, "uniqueness": k.uniqueness, "null_rate": k.null_rate} for k in keys],
        },
        "sample_records": [{k: _number(v) for k, v in r.items()} for r in list(samples)[:SAMPLES]],
    }


def relation_json(r) -> dict:
    """One relationship object, version 3.2; score fields only where it was scored."""
    several = len(r.source_columns) > 1
    end = lambda full: dict(zip(("schema", "table"), full.split(".", 1), strict=True))
    out = {"relationship_id": r.relationship_id, "type": "composite" if several else "single_column", "from_table": end(r.source), "to_table": end(r.target)}
    out |= {"from_columns": r.source_columns, "to_columns": r.target_columns} if several else {"from_column": r.source_columns[0], "to_column": r.target_columns[0]}
    out |= {"discovery_method": r.discovery_method, "target_source_type": r.target_source_type, "source_constraint": r.source_constraint}
    if r.composite_score is not None:
        metrics = {k: round(r[k], 4) for k in ("inclusion_rate", "jaccard_index", "name_similarity", "type_compatibility")}
        out |= {"composite_score": round(r.composite_score, 4), "confidence_level": r.confidence_level, "metrics": metrics}
    out["cardinality"] = r.cardinality
    if r.constraint_name is not None:
        out["constraint_name"] = r.constraint_name
    return out


def relations_json(decided: DataFrame, statistics: DataFrame, database: str, files: int, stamp: str = "") -> dict:
    """Accepted relationships by source, target and columns; rejected ones are counted and listed with their reasons."""
    rows = decided.orderBy("source", "target", "source_columns").collect()
    rejected = [{"relationship_id": r.relationship_id, "reason": r.reason, "composite_score": round(r.composite_score, 4)} for r in rows if r.decision == "rejected"]
    return {
        "generated_by": "rel", "database": database, "metadata_source": "profiles", "json_metadata_version": "2.0", "json_files_loaded": files, "generated_timestamp": stamp,
        "statistics": statistics.first().asDict() | {"total_suppressed_single_relations": len(rejected)}, "relationships": [relation_json(r) for r in rows if r.decision == "accepted"], "rejected": rejected,
    }


def relations_markdown(document: dict) -> str:
    lines = [f"# {document['database']}", "", "## Statistics", *[f"- {k}: {v}" for k, v in document["statistics"].items()], "", "## Relationships"]
    for r in document["relationships"]:
        side = lambda s, r=r: ", ".join(r.get(f"{s}_columns") or [r[f"{s}_column"]])
        name = lambda t: f"{t['schema']}.{t['table']}"
        lines += [f"### {name(r['from_table'])}.{side('from')} -> {name(r['to_table'])}.{side('to')}", f"- id: {r['relationship_id']}", f"- cardinality: {r['cardinality']}", f"- method: {r['discovery_method']}"]
        lines += [f"- score: {r['composite_score']} ({r['confidence_level']})", *[f"  - {k}: {v}" for k, v in r["metrics"].items()]] if "composite_score" in r else []
    return "\n".join(lines)


def literal(value) -> str:
    """A Cypher literal; maps have bare keys."""
    if isinstance(value, dict):
        return "{" + ", ".join(f"{k}: {literal(v)}" for k, v in value.items()) + "}"
    if isinstance(value, list | tuple):
        return "[" + ", ".join(map(literal, value)) + "]"
    return json.dumps(value, ensure_ascii=False)


def cypher(tables: DataFrame, columns: DataFrame, edges: DataFrame) -> str:
    """A script of constraints, nodes and edges from the graph frames; nested lists are written as JSON texts, since properties cannot nest."""
    flat = lambda d: {k: json.dumps(v, ensure_ascii=False) if isinstance(v, list) and v and isinstance(v[0], list) else v for k, v in d.items()}
    rows = lambda df, *order: [flat(r.asDict(recursive=True)) for r in df.orderBy(*order).collect()]
    t, c, e = rows(tables, "id"), rows(columns, "id"), rows(edges, "src", "dst", "relationship_id")
    unwind = lambda data, var: f"UNWIND {literal(data)} AS {var}"
    parts = [
        f"// {len(t)} tables, {len(c)} columns, {len(e)} relationships",
        "CREATE CONSTRAINT table_id IF NOT EXISTS FOR (t:Table) REQUIRE t.id IS UNIQUE;\nCREATE CONSTRAINT column_id IF NOT EXISTS FOR (c:Column) REQUIRE c.id IS UNIQUE;",
        f"{unwind(t, 't')}\nMERGE (n:Table {{id: t.id}})\nSET n += t;",
        f"{unwind(c, 'c')}\nMERGE (n:Column {{id: c.id}})\nSET n += c;",
        f"{unwind([{'src': x['table_id'], 'dst': x['id']} for x in c], 'h')}\nMATCH (t:Table {{id: h.src}}), (c:Column {{id: h.dst}})\nMERGE (t)-[:HAS_COLUMN]->(c);",
        f"{unwind(e, 'j')}\nMATCH (s:Table {{id: j.src}}), (d:Table {{id: j.dst}})\nMERGE (s)-[r:JOIN_ON {{on: j.on}}]->(d)\nSET r.cardinality = j.cardinality, r.join_type = j.join_type, r.source_columns = j.source_columns, r.target_columns = j.target_columns;",
    ]
    return "\n\n".join(parts) + "\n"


def dim_config(categories: DataFrame) -> dict:
    """Dimension tables by database, each with an embedding column to be filled in."""
    out: dict = {"databases": {}}
    for r in categories.where("category = 'dim'").orderBy("database", "schema", "table").collect():
        out["databases"].setdefault(r.database, {"tables": {}})["tables"][f"{r.schema}.{r.table}"] = {"embedding_col": None}
    return out


def _settings(path: str) -> dict:
    """What a configuration file holds; nothing where there is none."""
    import yaml

    at = Path(path)
    return (yaml.safe_load(at.read_text(encoding="utf-8")) or {}) if at.exists() else {}


def write_yaml(doc: dict, path: str) -> None:
    """A configuration file: written beside the old one, then renamed over it."""
    import yaml

    at = Path(path)
    at.parent.mkdir(parents=True, exist_ok=True)
    new = at.with_name(f".{at.name}.new")
    new.write_text(yaml.safe_dump(doc, allow_unicode=True, sort_keys=False), encoding="utf-8")
    new.replace(at)


def write_dim_config(categories: DataFrame, path: str) -> dict:
    """dim_config() as a file.  Embedding columns that the file already names for a table are kept."""
    doc = dim_config(categories)
    old = _settings(path)
    for database, found in doc["databases"].items():
        known = ((old.get("databases") or {}).get(database) or {}).get("tables") or {}
        for name, table in found["tables"].items():
            table["embedding_col"] = (known.get(name) or {}).get("embedding_col")
    write_yaml(doc, path)
    return doc


def write_domains(path: str, database: str, domains: Sequence[tuple[str, str, Sequence[str]]], description: str = "", most: int = 3) -> dict:
    """Domains (name, description, tables), as normalised_domains gives them, as a file; other settings of an old file, and its description where none is given, are kept."""
    doc = _settings(path)
    known = doc.get("database") or {}
    doc["database"] = {"name": database, "description": description or known.get("description") or ""}
    doc["llm_inference"] = {"max_domains_per_table": most}
    doc["domains"] = [{"name": n, "description": d, "tables": list(t)} for n, d, t in domains]
    write_yaml(doc, path)
    return doc


def write_graph(folder: str, tables: DataFrame, columns: DataFrame, edges: DataFrame) -> dict[str, int]:
    """Nodes and edges as Parquet, read again to be counted."""
    spark, counts = tables.sparkSession, {}
    for name, df in (("tables", tables), ("columns", columns), ("edges", edges)):
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
        counts[name] = spark.read.parquet(f"{folder}/{name}").count()
    return counts
