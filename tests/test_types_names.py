import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import types as T

from quernstone.functions.names import VectorSimilarity, cosine, is_potential_key, mean_similarity, similarity
from quernstone.functions.types import canonical, compatibility, compatibility_rows, spark_type


@pytest.mark.parametrize(
    ("kind", "name"),
    [
        (T.ShortType(), "smallint"), (T.IntegerType(), "integer"), (T.LongType(), "bigint"), (T.DoubleType(), "double precision"), (T.StringType(), "text"),
        (T.VarcharType(300), "character varying"), (T.CharType(3), "character"), (T.TimestampNTZType(), "timestamp"), (T.TimestampType(), "timestamp with time zone"),
        (T.ArrayType(T.FloatType()), "real[]"), (T.MapType(T.StringType(), T.StringType()), "jsonb"), (T.DecimalType(10, 2), "numeric"), (T.BinaryType(), "bytea"),
    ],
)
def test_canonical_names(kind, name):
    assert canonical(kind)[0] == name


@pytest.mark.parametrize(
    ("a", "b", "score"),
    [
        ("integer", "integer", 1.0), ("integer", "bigint", 0.9), ("varchar(20)", "text", 0.85), ("char", "varchar", 0.8), ("numeric(10,2)", "decimal", 0.8), ("real", "double precision", 0.8),
        ("bigint", "numeric", 0.9), ("integer", "float", 0.6), ("numeric", "float", 0.5), ("timestamp", "timestamp without time zone", 0.9), ("timestamp", "timestamptz", 0.8),
        ("date", "timestamp", 0.5), ("boolean", "bool", 0.9), ("boolean", "integer", 0.6), ("text", "integer", 0.0), ("uuid", "text", 0.0), ("numeric(10,2)", "numeric(8,1)", 1.0), (None, "text", 0.0),
    ],
)
def test_lattice(a, b, score):
    assert compatibility(a, b) == compatibility(b, a) == score


def test_lattice_rows_are_all_pairs():
    assert len(compatibility_rows(["text", "integer", "text"])) == 4


def test_types_from_names():
    assert spark_type("numeric(10,2)") == T.DecimalType(10, 2)
    assert spark_type("real[]") == T.ArrayType(T.FloatType())
    assert spark_type("made up") == T.StringType()


@given(st.text(max_size=12), st.text(max_size=12))
def test_similarity_bounds(a, b):
    assert 0 <= similarity(a, b) <= 1
    assert similarity(a, a) == 1.0


def test_similarity_ignores_case_and_blanks():
    assert similarity(" O_OrderKey ", "o_orderkey") == 1.0
    assert similarity("o_orderkey", "l_orderkey") == 0.9
    assert similarity(None, "") == 1.0
    assert mean_similarity(["a"], ["a", "b"]) == 0.0


def test_vectors():
    calls = []

    def vectors(names):
        calls.append(list(names))
        return [[1.0, 0.0] if n.startswith("a") else [0.0, 0.0] for n in names]

    alike = VectorSimilarity(vectors)
    assert alike("a1", "a2") == 1.0 and alike("a1", "b") == 0.0 and alike("x", "X") == 1.0
    assert calls == [["a1", "a2"], ["b"]]
    assert cosine([0, 0], [1, 1]) == 0.0
    assert is_potential_key("order_no") and not is_potential_key("color")
