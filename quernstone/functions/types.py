"""Canonical type names of Spark types, and how well two types go together."""

from __future__ import annotations

from itertools import product

from pyspark.sql import types as T

_PLAIN = {
    T.ByteType: "smallint", T.ShortType: "smallint", T.IntegerType: "integer", T.LongType: "bigint", T.FloatType: "real", T.DoubleType: "double precision",
    T.StringType: "text", T.BooleanType: "boolean", T.DateType: "date", T.TimestampType: "timestamp with time zone", T.TimestampNTZType: "timestamp",
    T.BinaryType: "bytea", T.MapType: "jsonb", T.StructType: "jsonb", T.VariantType: "jsonb", T.DayTimeIntervalType: "interval", T.YearMonthIntervalType: "interval",
}


def canonical(kind: T.DataType) -> tuple[str, int | None, int | None, int | None]:
    """(name, character length, precision, scale) of a Spark type."""
    if isinstance(kind, T.VarcharType):
        return "character varying", kind.length, None, None
    if isinstance(kind, T.CharType):
        return "character", kind.length, None, None
    if isinstance(kind, T.DecimalType):
        return "numeric", None, kind.precision, kind.scale
    if isinstance(kind, T.ArrayType):
        return f"{canonical(kind.elementType)[0]}[]", None, None, None
    for known, name in _PLAIN.items():
        if type(kind) is known:
            return name, None, None, None
    return kind.simpleString(), None, None, None


def spark_type(name: str) -> T.DataType:
    """A Spark type for a canonical or SQL type name; unknown names are strings."""
    base, args = base_name(name), name[name.find("(") + 1 : name.rfind(")")] if "(" in name else ""
    if base.endswith("[]"):
        return T.ArrayType(spark_type(base[:-2]))
    numbers = [int(x) for x in args.split(",") if x.strip().isdigit()]
    for family, kind in (
        (SMALL, T.ShortType()), (BIG, T.LongType()), (INTEGERS, T.IntegerType()), (("real", "float4"), T.FloatType()), (FLOATS, T.DoubleType()),
        (BOOLEANS, T.BooleanType()), (("date",), T.DateType()), (ZONED, T.TimestampType()), (UNZONED, T.TimestampNTZType()), (("bytea",), T.BinaryType()),
    ):
        if base in family:
            return kind
    if base in NUMERICS:
        return T.DecimalType(*numbers) if numbers else T.DecimalType(38, 10)
    return T.StringType()


# The families of type names.
SMALL = ("smallint", "int2", "smallserial")
BIG = ("bigint", "int8", "bigserial")
INTEGERS = ("integer", "int", "int4", "serial", *SMALL, *BIG)
VARIABLE = ("varchar", "character varying", "text")
FIXED = ("char", "character", "bpchar")
NUMERICS = ("numeric", "decimal")
FLOATS = ("float", "float4", "float8", "real", "double", "double precision")
UNZONED = ("timestamp", "timestamp without time zone", "datetime")
ZONED = ("timestamptz", "timestamp with time zone")
TIMES = ("time", "timetz", "time without time zone", "time with time zone")
BOOLEANS = ("boolean", "bool")


def base_name(name: str | None) -> str:
    """Lower-cased, without parameters: numeric(10,2) is numeric."""
    name = (name or "").strip().lower()
    cut = name.find("(")
    return (name[:cut].strip() + name[name.rfind(")") + 1 :]).strip() if cut >= 0 else name


#: Scores of pairs of families, in the order in which they are tried.
_LATTICE = (
    (INTEGERS, INTEGERS, 0.9), (VARIABLE, VARIABLE, 0.85), (FIXED, FIXED + VARIABLE, 0.8), (NUMERICS, NUMERICS, 0.8), (FLOATS, FLOATS, 0.8),
    (INTEGERS, NUMERICS, 0.9), (INTEGERS, FLOATS, 0.6), (NUMERICS, FLOATS, 0.5), (UNZONED, UNZONED, 0.9), (ZONED, ZONED, 0.9), (UNZONED, ZONED, 0.8),
    (("date",), UNZONED + ZONED, 0.5), (TIMES, TIMES, 0.85), (BOOLEANS, BOOLEANS, 0.9), (BOOLEANS, INTEGERS, 0.6),
)


def compatibility(a: str | None, b: str | None) -> float:
    """1.0 for equal names, else the first pair of families that holds both, else 0."""
    a, b = base_name(a), base_name(b)
    if a == b and a:
        return 1.0
    for left, right, score in _LATTICE:
        if (a in left and b in right) or (b in left and a in right):
            return score
    return 0.0


def compatibility_rows(names: list[str]) -> list[tuple[str, str, float]]:
    return [(a, b, compatibility(a, b)) for a, b in product(sorted(set(names)), repeat=2)]
