"""Folders of metadata files as a Spark data source.

``spark.read.format("table_metadata")`` reads a folder of files named
``<database>.<schema>.<table>`` with the suffix .sql (DDL), .json (profiles) or
.md (Markdown), a partition for each file: tasks read and parse, the driver
only lists names.  Filters on database, schema and table leave out files by
their names, and a schema of fewer columns leaves out the rest.  ``object`` is
what a file gives rows of: columns (default), constraints or tables.

``df.write.format("table_metadata")`` writes rows (file, text), a file each:
under a temporary name, then renamed when all tasks are done.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow.fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, In, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from .catalog import COLUMNS, CONSTRAINTS, TABLES, Table
from .ddl import parse

KINDS = {"ddl": ".sql", "json": ".json", "markdown": ".md"}
OBJECTS = {
    "columns": COLUMNS + ", role string, sample_count bigint, null_count bigint, unique_count bigint",
    "constraints": CONSTRAINTS,
    "tables": TABLES + ", category string, total_rows bigint, text string",
}
_LINE = re.compile(r"^- (\S+) \((.*?)\) - (.*?)(?: \[示例.*)?$")
_HEAD = re.compile(r"^# ([^\s.]+)\.([^\s（]+)(?:（(.*)）)?$")
_NO_COMMENT = "无注释"


# Rows of one file, as dictionaries -------------------------------------------------------------------------------------


def _table_rows(t: Table, object_: str) -> Iterator[dict]:
    at = {"database": t.database, "schema": t.schema, "table": t.name}
    if object_ == "tables":
        yield at | {"comment": t.comment}
    elif object_ == "columns":
        for i, c in enumerate(t.columns):
            yield at | {"column": c.name, "ordinal": i + 1} | {k: getattr(c, k) for k in ("data_type", "char_length", "precision", "scale", "nullable", "default", "comment")}
    else:
        for c in t.constraints:
            ref = c.ref or (None, None, None)
            yield at | {"kind": c.kind, "name": c.name, "columns": list(c.columns), "ref_schema": ref[0], "ref_table": ref[1], "ref_columns": list(ref[2]) if ref[2] else None, "unique": c.unique or c.kind in ("pk", "uk"), "method": c.method, "condition": c.condition}


def _profile_rows(doc: dict, object_: str, name: str) -> Iterator[dict]:
    info = doc.get("table_info") or {}
    if not info.get("schema_name") or not info.get("table_name"):
        raise ValueError(f"{name} names no schema and table")
    at = {"database": info.get("database"), "schema": info["schema_name"], "table": info["table_name"]}
    about = doc.get("table_profile") or {}
    if object_ == "tables":
        yield at | {"comment": info.get("comment"), "category": about.get("table_category"), "total_rows": info.get("total_rows")}
    elif object_ == "columns":
        for c, p in (doc.get("column_profiles") or {}).items():
            stats = p.get("statistics") or {}
            yield at | {
                "column": c, "ordinal": p.get("ordinal_position"), "data_type": p.get("data_type"), "char_length": p.get("character_maximum_length"), "precision": p.get("numeric_precision"), "scale": p.get("numeric_scale"),
                "nullable": p.get("is_nullable"), "default": p.get("column_default"), "comment": p.get("comment"), "role": (p.get("semantic_analysis") or {}).get("semantic_role"),
                "sample_count": stats.get("sample_count"), "null_count": stats.get("null_count"), "unique_count": stats.get("unique_count"),
            }
    else:
        held = about.get("physical_constraints") or {}
        pk, uks = held.get("primary_key"), held.get("unique_constraints") or []
        for kind, k in [*([("pk", pk)] if pk else []), *(("uk", k) for k in uks)]:
            yield at | {"kind": kind, "name": k.get("constraint_name"), "columns": k["columns"], "unique": True, "method": "btree"}
        for k in held.get("foreign_keys") or []:
            yield at | {"kind": "fk", "name": k.get("constraint_name"), "columns": k["source_columns"], "ref_schema": k.get("target_schema"), "ref_table": k.get("target_table"), "ref_columns": k.get("target_columns"), "unique": False, "method": "btree"}
        for k in about.get("indexes") or []:
            yield at | {"kind": "index", "name": k.get("index_name"), "columns": k["columns"], "unique": bool(k.get("is_unique")), "method": k.get("index_type") or "btree"}


def _markdown_rows(text: str, object_: str, name: str, database: str | None) -> Iterator[dict]:
    lines = text.split("\n")
    head = _HEAD.match(lines[0]) if lines else None
    if not head:
        raise ValueError(f"{name} has no title of a schema and a table")
    at = {"database": database, "schema": head[1], "table": head[2]}
    if object_ == "tables":
        yield at | {"comment": head[3], "text": text}
    elif object_ == "columns":
        fields = text.split("## 字段列表", 1)[-1].split("\n## ", 1)[0].split("\n")
        for i, m in enumerate(m for m in map(_LINE.match, fields) if m):
            yield at | {"column": m[1], "ordinal": i + 1, "data_type": m[2].split("(")[0], "comment": None if m[3].strip() == _NO_COMMENT else m[3].strip()}


def file_rows(name: str, text: str, kind: str, object_: str) -> Iterator[dict]:
    """Rows of a file.  Markdown has no constraints."""
    parts = name.split(".")
    database = parts[0] if len(parts) >= 4 else None
    if kind == "ddl":
        return _table_rows(parse(text, database or "db"), object_)
    return _profile_rows(json.loads(text), object_, name) if kind == "json" else _markdown_rows(text, object_, name, database)


# Data source ------------------------------------------------------------------------------------------------------------


@dataclass
class MetadataFile(InputPartition):
    path: str


@dataclass
class Files(WriterCommitMessage):
    moves: list[tuple[str, str]]


class MetadataReader(DataSourceReader):
    def __init__(self, options: dict[str, str], schema: StructType):
        self.uri, self.kind, self.object, self.columns = options["path"], options["kind"], options.get("object", "columns"), schema.names
        self.wanted: dict[str, set] = {}

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Names of files tell database, schema and table; Spark tests all filters again, as a file may describe another table."""
        for f in filters:
            if isinstance(f, EqualTo | In) and len(f.attribute) == 1 and f.attribute[0] in ("database", "schema", "table"):
                values = set(f.value) if isinstance(f, In) else {f.value}
                self.wanted[f.attribute[0]] = self.wanted.get(f.attribute[0], values) & values
            yield f

    def partitions(self) -> list[MetadataFile]:
        """Files of the kind by name; templates are left out, and so are files whose names say that they are not wanted."""
        fs, folder = pafs.FileSystem.from_uri(self.uri)
        suffix, out = KINDS[self.kind], []
        for f in sorted(fs.get_file_info(pafs.FileSelector(folder)), key=lambda f: f.base_name):
            if f.type == pafs.FileType.File and f.base_name.endswith(suffix) and not f.base_name.startswith(("_", ".")):
                parts = f.base_name.removesuffix(suffix).split(".", 2)
                named = dict(zip(("database", "schema", "table"), parts, strict=True)) if len(parts) == 3 else {}
                if all(named[k] in v for k, v in self.wanted.items() if k in named):
                    out.append(MetadataFile(f.path))
        return out

    def read(self, partition: MetadataFile | None) -> Iterator[tuple]:
        if partition is None:  # no files
            return
        fs, _ = pafs.FileSystem.from_uri(self.uri)
        with fs.open_input_stream(partition.path) as f:
            text = f.read().decode()
        for row in file_rows(partition.path.rsplit("/", 1)[-1], text, self.kind, self.object):
            yield tuple(row.get(c) for c in self.columns)


class MetadataWriter(DataSourceWriter):
    def __init__(self, options: dict[str, str]):
        self.uri = options["path"]

    def write(self, iterator: Iterator) -> Files:
        fs, folder = pafs.FileSystem.from_uri(self.uri)
        attempt, moves = f"{folder}/_temporary/{uuid.uuid4().hex}", []
        fs.create_dir(attempt)
        for row in iterator:
            if "/" in row.file or row.file.startswith(("_", ".")):
                raise ValueError(f"not a name for a file: {row.file}")
            with fs.open_output_stream(f"{attempt}/{row.file}") as out:
                out.write((row.text or "").encode())
            moves.append((f"{attempt}/{row.file}", f"{folder}/{row.file}"))
        return Files(moves)

    def commit(self, messages: list[Files | None]) -> None:
        fs, folder = pafs.FileSystem.from_uri(self.uri)
        moves = [m for x in messages if x for m in x.moves]
        if len({b for _, b in moves}) < len(moves):
            raise ValueError("two rows name one file")
        for a, b in moves:
            fs.move(a, b)
        fs.create_dir(f"{folder}/_temporary")
        fs.delete_dir(f"{folder}/_temporary")

    def abort(self, messages: list[Files | None]) -> None:
        """Temporary files are never read, and go with the next commit."""


class MetadataSource(DataSource):
    """Options: path, kind (ddl, json or markdown) and object (columns, constraints or tables)."""

    @classmethod
    def name(cls) -> str:
        return "table_metadata"

    def schema(self) -> str:
        if self.options.get("kind") not in KINDS:
            raise ValueError(f"kind is one of {sorted(KINDS)}")
        return OBJECTS[self.options.get("object", "columns")]

    def reader(self, schema: StructType) -> MetadataReader:
        return MetadataReader(dict(self.options), schema)

    def writer(self, schema: StructType, overwrite: bool) -> MetadataWriter:
        if schema.names != ["file", "text"]:
            raise ValueError("rows to write are (file, text)")
        return MetadataWriter(dict(self.options))


def register(spark: SparkSession) -> None:
    """Makes the format known, and lets Spark hand its filters down."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(MetadataSource)
