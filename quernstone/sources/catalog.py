"""Described tables: DataFrames with their columns and constraints.

Spark enforces no keys, so constraints come with the catalog: from a DDL file,
from a profile that was written before, or by hand.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.types import canonical

COLUMNS = "database string, schema string, table string, column string, ordinal int, data_type string, char_length int, precision int, scale int, nullable boolean, default string, comment string"
CONSTRAINTS = "schema string, table string, kind string, name string, columns array<string>, ref_schema string, ref_table string, ref_columns array<string>, unique boolean, method string, condition string"
TABLES = "database string, schema string, table string, comment string"


@dataclass(frozen=True)
class Constraint:
    """kind: pk, uk, fk or index.  Columns of a foreign key and of its reference go together in order."""

    kind: str
    columns: tuple[str, ...]
    name: str | None = None
    ref: tuple[str, str, tuple[str, ...]] | None = None
    unique: bool = False
    method: str = "btree"
    condition: str | None = None

    def __post_init__(self):
        if self.kind not in ("pk", "uk", "fk", "index"):
            raise ValueError(f"not a kind of constraint: {self.kind}")
        if self.kind == "fk" and (not self.ref or len(self.ref[2]) != len(self.columns)):
            raise ValueError("a foreign key names as many columns as it refers to")


@dataclass
class Column:
    name: str
    data_type: str
    char_length: int | None = None
    precision: int | None = None
    scale: int | None = None
    nullable: bool = True
    default: str | None = None
    comment: str | None = None


@dataclass
class Table:
    name: str
    frame: DataFrame | None = None
    schema: str = "public"
    database: str = "db"
    comment: str | None = None
    columns: list[Column] = field(default_factory=list)
    constraints: list[Constraint] = field(default_factory=list)
    samples: list[dict] = field(default_factory=list)

    def __post_init__(self):
        if not self.columns and self.frame is not None:
            self.columns = [describe(f) for f in self.frame.schema.fields]

    @property
    def full_name(self) -> str:
        return f"{self.schema}.{self.name}"

    def of_kind(self, *kinds: str) -> list[Constraint]:
        return [c for c in self.constraints if c.kind in kinds]

    def column(self, name: str) -> Column | None:
        return next((c for c in self.columns if c.name == name), None)


def describe(f) -> Column:
    """A column of a Spark schema; the field's metadata may override its type and length."""
    name, length, precision, scale = canonical(f.dataType)
    meta = f.metadata or {}
    return Column(f.name, meta.get("data_type", name), meta.get("char_length", length), precision, scale, f.nullable, meta.get("default"), meta.get("comment"))


class Catalog:
    """Tables by schema.table."""

    def __init__(self, spark: SparkSession, tables: Iterable[Table] = ()):
        self.spark = spark
        self.tables: dict[str, Table] = {}
        for t in tables:
            self.add(t)

    def add(self, table: Table) -> None:
        if table.full_name in self.tables:
            raise ValueError(f"table {table.full_name} is there already")
        self.tables[table.full_name] = table

    def __iter__(self):
        return iter(self.tables.values())

    def __getitem__(self, name: str) -> Table:
        return self.tables[name if "." in name else f"public.{name}"]

    @classmethod
    def from_parquet(cls, spark: SparkSession, folder: str, names: Iterable[str], constraints: Mapping[str, list[Constraint]] | None = None, schema: str = "public", database: str = "db") -> Catalog:
        """One table for each <folder>/<name>.parquet."""
        known = constraints or {}
        return cls(spark, [Table(n, spark.read.parquet(f"{folder}/{n}.parquet"), schema, database, constraints=list(known.get(n, []))) for n in names])

    @classmethod
    def from_session(cls, spark: SparkSession, schema: str) -> Catalog:
        """All tables of a database of the session, with their comments."""
        found = [t for t in spark.catalog.listTables(schema) if not t.isTemporary]
        return cls(spark, [Table(t.name, spark.table(f"{schema}.{t.name}"), schema, comment=t.description) for t in sorted(found, key=lambda t: t.name)])

    def only(self, include: Iterable[str] = (), exclude: Iterable[str] = ()) -> Catalog:
        """Tables by name: those included, if any are named, without those excluded."""
        wanted = set(include)
        return Catalog(self.spark, [t for t in self if (not wanted or t.name in wanted or t.full_name in wanted) and not excluded(t.schema, t.name, exclude)])

    def tables_frame(self) -> DataFrame:
        return self.spark.createDataFrame([(t.database, t.schema, t.name, t.comment) for t in self], TABLES)

    def columns_frame(self) -> DataFrame:
        rows = [(t.database, t.schema, t.name, c.name, i + 1, c.data_type, c.char_length, c.precision, c.scale, c.nullable, c.default, c.comment) for t in self for i, c in enumerate(t.columns)]
        return self.spark.createDataFrame(rows, COLUMNS)

    def constraints_frame(self) -> DataFrame:
        rows = []
        for t in self:
            for c in t.constraints:
                ref = c.ref or (None, None, None)
                rows.append((t.schema, t.name, c.kind, c.name, list(c.columns), ref[0], ref[1], list(ref[2]) if ref[2] else None, c.unique or c.kind in ("pk", "uk"), c.method, c.condition))
        return self.spark.createDataFrame(rows, CONSTRAINTS)


def excluded(schema: str, table: str, patterns: Iterable[str]) -> bool:
    """Patterns are names, with a schema or without, and may end in ``*``; three-part ones match nothing."""
    for p in patterns:
        parts = p.split(".")
        if len(parts) > 2 or (len(parts) == 2 and parts[0] != schema):
            continue
        if table.startswith(parts[-1][:-1]) if parts[-1].endswith("*") else table == parts[-1]:
            return True
    return False


def schemas(spark: SparkSession, system: Iterable[str] = ("information_schema",)) -> list[str]:
    return sorted(d.name for d in spark.catalog.listDatabases() if d.name not in set(system))


def table_exists(spark: SparkSession, schema: str, table: str) -> bool:
    return spark.catalog.tableExists(f"{schema}.{table}")


def row_estimate(df: DataFrame) -> int:
    """Rows as the optimizer takes them, without a scan: the analysed count where there is one, else bytes by the width of a row."""
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    if stats.rowCount().isDefined():
        return int(str(stats.rowCount().get()))
    return int(str(stats.sizeInBytes())) // max(1, df._jdf.schema().defaultSize())


def head_sample(df: DataFrame, n: int = 1000, by: Iterable[str] = ()) -> DataFrame:
    """n rows; the first ones by the given columns, which makes the sample the same each time."""
    by = list(by)
    return (df.orderBy(*by) if by else df).limit(n)


def random_sample(df: DataFrame, fraction: float, seed: int = 0) -> DataFrame:
    return df.sample(fraction=fraction, seed=seed)


def preview_sample(df: DataFrame, by: Iterable[str] = (), fetch: int = 10, keep: int = 5) -> DataFrame:
    """Of the first `fetch` rows those that are not all null, at most `keep`."""
    return head_sample(head_sample(df, fetch, by).na.drop("all"), keep, by)


def pg_array(text):
    """A PostgreSQL array literal ``{a,b}`` as an array of strings; null and ``{}`` are empty."""
    inner = F.regexp_replace(F.trim(text), r"^\{|\}$", "")
    part = F.transform(F.split(inner, ","), lambda x: F.regexp_replace(F.trim(x), r'^"|"$', ""))
    return F.when(text.isNull() | (F.length(inner) == 0), F.array().cast("array<string>")).otherwise(part)
