"""Registered queries over the star-schema and corpus tables, each with its SQL twin where SQL can express it."""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import SHIPPED, RelationConfig
from ..operators import decide as D
from ..operators import dimvalues as V
from ..operators import export as E
from ..operators import graph as G
from ..operators import metrics as M
from ..operators import retrieval as Q
from ..operators import statements as SQ
from ..operators import stats as S
from ..operators import upserts as U
from ..operators import vectors as X
from ..operators.candidates import Candidate
from ..operators.medians import medians
from ..sources import blocks as FB
from ..sources import files as FS
from ..sources.catalog import Catalog, Constraint, Table, preview_sample
from ..storage import dealt, key_parts, shared_folder, written
from ..streaming import stateful as ST
from ..streaming.profile import windowed_profile
from . import twins as W
from .discover import decisions, discover, joined_candidates, score
from .profile import Profile, profile_catalog

STAR = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")
#: Columns of the star tables by kind: n numeric, s string, t time.
COLUMNS = {
    "region": {"r_regionkey": "n", "r_name": "s"},
    "nation": {"n_nationkey": "n", "n_name": "s", "n_regionkey": "n"},
    "customer": {"c_custkey": "n", "c_name": "s", "c_nationkey": "n", "c_acctbal": "n", "c_mktsegment": "s"},
    "supplier": {"s_suppkey": "n", "s_name": "s", "s_nationkey": "n", "s_acctbal": "n"},
    "part": {"p_partkey": "n", "p_name": "s", "p_brand": "s", "p_type": "s", "p_size": "n", "p_retailprice": "n"},
    "orders": {"o_orderkey": "n", "o_custkey": "n", "o_orderstatus": "s", "o_totalprice": "n", "o_orderdate": "t", "o_orderpriority": "s"},
    "lineitem": {"l_orderkey": "n", "l_partkey": "n", "l_suppkey": "n", "l_linenumber": "n", "l_quantity": "n", "l_extendedprice": "n", "l_discount": "n", "l_tax": "n", "l_returnflag": "s", "l_linestatus": "s", "l_shipdate": "t"},
}
KEYS = {"region": ["r_regionkey"], "nation": ["n_nationkey"], "customer": ["c_custkey"], "supplier": ["s_suppkey"], "part": ["p_partkey"], "orders": ["o_orderkey"]}
#: (source, columns, target, columns), one side of each is a key.
PAIRS = [
    ("orders", ("o_orderkey",), "lineitem", ("l_orderkey",)),
    ("region", ("r_regionkey",), "nation", ("n_regionkey",)),
    ("nation", ("n_nationkey",), "customer", ("c_nationkey",)),
    ("nation", ("n_nationkey",), "supplier", ("s_nationkey",)),
    ("customer", ("c_custkey",), "orders", ("o_custkey",)),
    ("part", ("p_partkey",), "lineitem", ("l_partkey",)),
    ("supplier", ("s_suppkey",), "lineitem", ("l_suppkey",)),
    ("lineitem", ("l_orderkey", "l_linenumber"), "lineitem", ("l_partkey", "l_linenumber")),
]
#: The single pairs, and two whose columns are of other types.
SCORED = [*PAIRS[:7], ("nation", ("n_nationkey",), "part", ("p_partkey",)), ("part", ("p_size",), "lineitem", ("l_quantity",))]


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _at_once(make, names) -> list[DataFrame]:
    """Frames whose making runs jobs, so that small tables do not wait for each other."""
    with ThreadPoolExecutor(4) as pool:
        return list(pool.map(make, names))


def _union(frames) -> DataFrame:
    return reduce(DataFrame.unionAll, frames)


def star_catalog(spark: SparkSession, d: str, keys: bool = True) -> Catalog:
    return Catalog.from_parquet(spark, d, STAR, {n: [Constraint("pk", tuple(k), f"{n}_pkey")] for n, k in KEYS.items()} if keys else None)


#: Profiles of this process by session, folder and state of its files.
_PROFILES: dict[tuple, Profile] = {}


def _files(spark: SparkSession, catalog: Catalog) -> tuple:
    """Length and time of change of the tables' files."""
    hadoop, out = spark._jvm.org.apache.hadoop.fs, []
    for name in sorted({f for t in catalog for f in t.frame.inputFiles()}):
        at = hadoop.Path(spark._jvm.java.net.URI(name))
        status = at.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(at)
        out.append((name, status.getLen(), status.getModificationTime()))
    return tuple(out)


def profiled(spark: SparkSession, d: str, keys: bool = True) -> Profile:
    """Profiles of all star tables: made once in a session, and again when a file has changed; tables without files are not kept."""
    catalog = star_catalog(spark, d, keys)
    key = (id(spark), spark.sparkContext.applicationId, d, keys, _files(spark, catalog))
    if key in _PROFILES:
        return _PROFILES[key]
    made = _whole(profile_catalog(catalog, SHIPPED))
    if key[-1]:
        while len(_PROFILES) >= 4:
            _PROFILES.pop(next(iter(_PROFILES)))
        _PROFILES[key] = made
    return made


def _whole(p: Profile) -> Profile:
    """p; a table that could not be profiled fails the query."""
    if p.failed:
        raise RuntimeError(f"tables could not be profiled: {p.failed}")
    return p


# --- Column statistics -------------------------------------------------------------------------------------------------


def row_counts(spark, d):
    return _union([_t(spark, d, n).agg(F.count("*").alias("row_count")).select(F.lit(n).alias("table_name"), "row_count") for n in STAR])


def _each_profile(spark, d, exact="none", median=False):
    """Profiles of all star tables, several at a time; without exact counts they take one pass over each."""
    return _union(_at_once(lambda n: S.profile(_t(spark, d, n), exact=exact, median=median).select(F.lit(n).alias("table_name"), "*"), STAR))


def col_null_rate(spark, d):
    return _each_profile(spark, d).select("table_name", F.col("column").alias("column_name"), "sample_count", "null_count", "null_rate")


def col_uniqueness(spark, d):
    return _each_profile(spark, d, "all").select("table_name", F.col("column").alias("column_name"), "unique_count", "uniqueness")


def col_numeric_stats(spark, d):
    out = _each_profile(spark, d).where("min_value IS NOT NULL")
    number = lambda c: F.round(F.col(c).cast("double"), 4).alias(c)
    return out.select("table_name", F.col("column").alias("column_name"), number("min_value"), number("max_value"), number("mean_value"))


def col_length_stats(spark, d):
    out = _each_profile(spark, d, median=True).where("avg_length IS NOT NULL")
    return out.select("table_name", F.col("column").alias("column_name"), "avg_length", "min_length", "max_length", "median_length", "length_std")


def value_distribution(spark, d):
    strings = {n: [c for c, k in COLUMNS[n].items() if k == "s"] for n in STAR}
    return _union(_at_once(lambda n: S.distributions(_t(spark, d, n), strings[n]).select(F.lit(n).alias("table_name"), F.col("column").alias("column_name"), "value", "n", F.col("rank").cast("bigint").alias("rank")), STAR))


def full_profile_lineitem(spark, d):
    out = S.profile(_t(spark, d, "lineitem"), exact="all", median=False)
    number = lambda c: F.round(F.col(c).cast("double"), 4).alias(c)
    return out.select(F.col("column").alias("column_name"), "sample_count", "null_rate", "unique_count", "uniqueness", number("min_value"), number("max_value"), number("mean_value"), "avg_length", "length_std")


def corpus_text_profile(spark, d):
    """Length moments of the documents' texts by source."""
    docs, size = _t(spark, d, "documents").select("source", "text"), F.length("text")
    moments = docs.groupBy("source").agg(F.count("*").alias("docs"), F.round(F.avg(size), 2).alias("avg_length"), F.min(size).alias("min_length"), F.max(size).alias("max_length"))
    middle = medians(docs, {"text": size}, ["source"]).select(F.col("source").alias("of"), F.col("median").alias("median_length"))
    return moments.join(middle, F.col("source").eqNullSafe(F.col("of")), "left").drop("of")


#: Rows of a file of small blocks, so that no footer grows with the table.
FILE_ROWS = 1 << 18


def block_samples(spark, d):
    """A tenth of each table by row groups of small blocks: its rows, those of the sample, those that the table lacks, and whether no more was read than the sample and one group."""

    def one(n):
        path, table = f"{shared_folder(spark)}/{n}", _t(spark, d, n)
        table.repartition(max(4, -(-table.count() // FILE_ROWS))).write.option("parquet.block.size", 32 << 10).option("parquet.block.size.row.check.min", 64).option("parquet.block.size.row.check.max", 64).parquet(path)
        blocks = written(FB.row_groups(spark, path), f"{path}-blocks")
        chosen = FB.choose_blocks(blocks, 0.1, 7)
        read = FB.read_blocks(spark, path, chosen)
        parts = (
            blocks.agg(F.sum("rows").alias("row_count"), F.max("rows").alias("largest")),
            chosen.agg(F.sum("rows").alias("touched")),
            read.agg(F.count("*").alias("sample_rows")),
            read.exceptAll(table).agg(F.count("*").alias("foreign_rows")),
        )
        whole = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)
        out = whole.agg(*[F.max(c).alias(c) for c in whole.columns])
        return out.select(F.lit(n).alias("table_name"), "row_count", "sample_rows", "foreign_rows", (F.col("touched") < F.col("sample_rows") + F.col("largest")).alias("reads_follow"))

    return _union(_at_once(one, ("customer", "orders", "events", "lineitem")))


def complex_value_distinct(spark, d):
    e = _t(spark, d, "embeddings")
    return e.agg(F.count("*").alias("row_count"), F.count_distinct(S.comparable(e, "embedding")).alias("distinct_values"))


def json_value_distinct(spark, d):
    """Distinct property documents of events, as maps: with and without a key that the text has last or first."""
    e = _t(spark, d, "events").select("event_type", F.from_json("props", "map<string,string>").alias("props"))
    type_ = F.create_map(F.lit("a"), F.col("event_type"))
    e = e.withColumn("swapped", F.when(F.col("props")["k"].cast("int") % 2 == 0, F.map_concat("props", type_)).otherwise(F.map_concat(type_, "props")))
    return e.groupBy("event_type").agg(F.count("*").alias("row_count"), *[F.count_distinct(S.comparable(e, c)).alias(f"distinct_{c}") for c in ("props", "swapped")])


def ddl_preview_sample(spark, d):
    return _union([preview_sample(_t(spark, d, n).select(F.col(KEYS[n][0]).cast("bigint").alias("key_value"), F.col(list(COLUMNS[n])[1]).cast("string").alias("second_value")), ["key_value"]).select(F.lit(n).alias("table_name"), "*") for n in KEYS])


def sample_cells(spark, d):
    docs = _t(spark, d, "documents")
    return docs.select("doc_id", E.cell(docs, "text").alias("text_cell"), E.safe_text(F.col("text"), 100).alias("text_short"))


# --- Keys --------------------------------------------------------------------------------------------------------------


def unique_columns(spark, d):
    """Columns without nulls whose values are all different."""
    out = _each_profile(spark, d, "needed")
    return out.where("null_count = 0 AND unique_count = sample_count").select("table_name", F.col("column").alias("column_name"), "unique_count")


def composite_distinct(spark, d):
    from ..operators.keys import distinct_counts

    df = _t(spark, d, "lineitem")
    sets = [("l_orderkey", "l_linenumber"), ("l_partkey", "l_suppkey"), ("l_orderkey", "l_partkey", "l_linenumber")]
    return spark.createDataFrame([(",".join(k), n) for k, n in distinct_counts(df, sets).items()], "column_set string, distinct_rows bigint")


def logical_keys(spark, d):
    p = profiled(spark, d, keys=False)
    return p.keys.select("table", F.array_join("columns", ",").alias("column_set"), "confidence")


#: Divisors and moduli of the parts of an order's key: some three of them tell orders apart.
PARTS = {"a_code": (1, 97), "b_code": (97, 101), "c_code": (9797, 1 << 40), "d_code": (1, 13), "e_code": (13, 17), "f_code": (221, 23), "g_code": (1, 2), "h_code": (2, 3), "i_code": (5, 7), "j_code": (35, 11), "k_code": (3, 5), "l_code": (7, 31)}


def wide_table_keys(spark, d):
    """Keys of a table of twelve parts of the orders' keys, found by agree sets."""
    orders = _t(spark, d, "orders")
    parts = orders.select(*[((F.floor(F.col("o_orderkey") / by) % mod).cast("bigint")).alias(c) for c, (by, mod) in PARTS.items()])
    p = _whole(profile_catalog(Catalog(spark, [Table("order_parts", parts)]), SHIPPED))
    return p.keys.select("table", F.array_join(F.array_sort("columns"), ",").alias("column_set"), "confidence")


# --- Roles and categories ----------------------------------------------------------------------------------------------


def column_roles(spark, d):
    return profiled(spark, d).columns.select("table", "column", "data_type", "role", "confidence", "basis")


def table_categories(spark, d):
    return profiled(spark, d).tables.select("table", "category", "confidence", "basis", "total_columns", "identifier_count", "metric_count", "datetime_count")


#: Tables of texts, vectors and events, and columns as tables of records have them beside their own.
CORPUS = {
    "documents": {"doc_id": "n", "text": "s", "lang": "s", "source": "s", "n_chars": "n"},
    "embeddings": {"vec_id": "n", "embedding": "a", "label": "n"},
    "labels": {"doc_id": "n", "quality": "n", "toxic": "n"},
    "conversations": {"conv_id": "n", "turn": "n", "role": "s", "text": "s"},
    "record_log": {"record_id": "n", "create_time": "t", "last_updated": "t", "updated_by": "n", "is_deleted": "b", "row_version": "n", "etl_batch": "n", "snapshot_day": "t", "remark": "s", "visit_year": "n"},
}
_LOG = {
    "record_id": "event_id", "create_time": "ts", "last_updated": "ts", "updated_by": "user_id", "is_deleted": "event_type = 'error'", "row_version": "event_id % 7",
    "etl_batch": "event_id % 11", "snapshot_day": "ts", "remark": "props", "visit_year": "event_id % 3",
}


def corpus_roles(spark, d):
    """Roles of columns of texts, vectors, flags and audit facts."""
    frames = {n: _t(spark, d, n) for n in list(CORPUS)[:-1]} | {"record_log": _t(spark, d, "events").selectExpr(*[f"{e} AS {c}" for c, e in _LOG.items()])}
    p = _whole(profile_catalog(Catalog(spark, [Table(n, df) for n, df in frames.items()]), SHIPPED))
    return p.columns.select("table", "column", "data_type", "role", "confidence", "basis", "audit_type", "audit_purpose")


#: Two tables that refer to three others, one of them by two columns.
def _linked(spark, d):
    li = _t(spark, d, "lineitem")
    lines = li.groupBy(F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("part_id")).agg(F.count("*").alias("n_lines"))
    link = li.select(F.col("l_orderkey").alias("order_id"), F.col("l_suppkey").alias("supplier_id")).distinct()
    notes = lines.select("order_id", "part_id", (F.col("order_id") % 5).alias("grade")).where("n_lines = 1")
    orders, supplier = _t(spark, d, "orders").select(F.col("o_orderkey").alias("id"), "o_totalprice"), _t(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), "s_acctbal")
    key = lambda *c: Constraint("pk", c, "pk", unique=True)
    to = lambda table, own, *c: Constraint("fk", own, f"{table}_fk", ("public", table, c))
    return Catalog(spark, [
        Table("orders_of", orders, constraints=[key("id")]), Table("supplier_of", supplier, constraints=[key("id")]), Table("line_of", lines, constraints=[key("order_id", "part_id")]),
        Table("order_supplier", link, constraints=[to("orders_of", ("order_id",), "id"), to("supplier_of", ("supplier_id",), "id")]),
        Table("line_note", notes, constraints=[to("line_of", ("order_id", "part_id"), "order_id", "part_id")]),
    ])


def bridge_categories(spark, d):
    """A table that links two others is a bridge, and so is one whose foreign key has two columns."""
    p = _whole(profile_catalog(_linked(spark, d), SHIPPED))
    return p.tables.select("table", "category", "confidence", "basis", "foreign_key_count", "primary_key_count", "total_columns")


def composite_foreign_keys(spark, d):
    """Foreign keys of one column and of two, as relationships."""
    out = discover(_whole(profile_catalog(_linked(spark, d), SHIPPED))).where("discovery_method = 'foreign_key_constraint'")
    return out.select("relationship_id", "source", F.array_join("source_columns", ",").alias("source_columns"), "target", F.array_join("target_columns", ",").alias("target_columns"), "cardinality", "decision")


# --- Relationships -----------------------------------------------------------------------------------------------------


def _overlaps(spark, d, pairs=PAIRS):
    return M.overlaps([(f"{s}.{','.join(sc)}->{t}.{','.join(tc)}", _t(spark, d, s), sc, _t(spark, d, t), tc) for s, sc, t, tc in pairs]).withColumnRenamed("relationship_id", "relationship")


def inclusion_jaccard(spark, d):
    return _overlaps(spark, d).select("relationship", "source_distinct", "target_distinct", "common", F.round("inclusion_rate", 6).alias("inclusion_rate"), F.round("jaccard_index", 6).alias("jaccard_index"))


def inferred_cardinality(spark, d):
    out = _overlaps(spark, d)
    return out.select("relationship", "joined_rows", F.round("multiplicity", 6).alias("multiplicity"), D.inferred_cardinality(F.col("source_uniqueness"), F.col("target_uniqueness"), F.col("multiplicity")).alias("cardinality"))


def _scored(spark, d):
    p = profiled(spark, d)
    found = [Candidate(f"public.{s}", sc, f"public.{t}", tc, "single_defined_constraint") for s, sc, t, tc in SCORED]
    return score(p, found)


def relationship_scores(spark, d):
    return _scored(spark, d).select("relationship_id", "source", "target", F.round("composite_score", 4).alias("composite_score"), "cardinality")


def relationship_decisions(spark, d):
    """Accepted at a threshold of 0.8."""
    out = D.decide(_scored(spark, d), RelationConfig(threshold=0.8))
    return out.select("relationship_id", "decision", "reason")


def discover_relationships(spark, d):
    out = discover(profiled(spark, d, keys=False))
    return out.select("relationship_id", "source", F.array_join("source_columns", ",").alias("source_columns"), "target", F.array_join("target_columns", ",").alias("target_columns"), "cardinality", F.round("composite_score", 4).alias("composite_score"), "decision", "reason", "discovery_method")


def name_candidates(spark, d):
    """Pairs of a key and a column whose names are alike enough and whose types go together, by a similarity join of the names."""
    found = joined_candidates(profiled(spark, d, keys=False))
    return found.select("source", "source_column", "target", "target_column", "kind", F.round("name_similarity", 6).alias("name_similarity"))


def sketched_decisions(spark, d):
    """The decisions of discover_relationships; what sketches exclude is not measured."""
    return decisions(profiled(spark, d, keys=False)).select("relationship_id", "source", F.array_join("source_columns", ",").alias("source_columns"), "target", F.array_join("target_columns", ",").alias("target_columns"), "decision", "reason")


#: Foreign keys of the star tables, each a single column.
FOREIGN = [("nation", "n_regionkey", "region", "r_regionkey"), ("customer", "c_nationkey", "nation", "n_nationkey"), ("supplier", "s_nationkey", "nation", "n_nationkey"), ("orders", "o_custkey", "customer", "c_custkey"), ("lineitem", "l_orderkey", "orders", "o_orderkey")]


def foreign_key_relationships(spark, d):
    """What is found where foreign keys are known: they are taken as they are, and no candidate states them again."""
    known = {n: [Constraint("pk", tuple(k), f"{n}_pkey")] for n, k in KEYS.items()}
    for s, a, t, b in FOREIGN:
        known.setdefault(s, []).append(Constraint("fk", (a,), f"{s}_{a}", ("public", t, (b,))))
    out = discover(_whole(profile_catalog(Catalog.from_parquet(spark, d, STAR, known), SHIPPED)))
    stated = out.where("discovery_method = 'foreign_key_constraint' OR decision = 'accepted'")
    return stated.select("relationship_id", "source", F.array_join("source_columns", ",").alias("source_columns"), "target", F.array_join("target_columns", ",").alias("target_columns"), "cardinality", "decision", "discovery_method")


def _order_parts(spark, d, *more):
    """order_id, part_id and other columns of lineitem, with all rows of a pair in one task and no more pairs in a task than it may hold."""
    li = _t(spark, d, "lineitem")
    rows = li.count()
    return dealt(li.select(F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("part_id"), *more), key_parts(spark, rows, rows), "order_id", "part_id")


def composite_relationships(spark, d):
    """Two tables with a unique constraint on two columns and a unique number: the composite hides the single one."""
    li, folder = _order_parts(spark, d, "l_extendedprice"), shared_folder(spark)
    line = (F.col("order_id") * 10_000_000 + F.col("part_id")).alias("line_id")
    parts = li.groupBy("order_id", "part_id").agg(F.count("*").alias("n_lines")).select("order_id", "part_id", line, "n_lines")
    values = li.where("part_id % 2 = 0").groupBy("order_id", "part_id").agg(F.sum("l_extendedprice").alias("line_value")).select("order_id", "part_id", line, "line_value")
    unique = lambda n: [Constraint("uk", ("order_id", "part_id"), f"{n}_key", unique=True)]
    tables = [Table(n, written(df, f"{folder}/{n}"), constraints=unique(n)) for n, df in (("line_part", parts), ("line_value", values))]
    out = discover(_whole(profile_catalog(Catalog(spark, tables), SHIPPED)))
    return out.select("source", F.array_join("source_columns", ",").alias("source_columns"), "target", F.array_join("target_columns", ",").alias("target_columns"), "cardinality", F.round("composite_score", 4).alias("composite_score"), "decision", "reason", "discovery_method")


def _exempt(spark, d):
    """Lines of orders three times: with two keys, with one and half of the parts, and twice over without any."""
    line = (F.col("order_id") * 10_000_000 + F.col("part_id")).alias("line_id")
    once, pair = written(_order_parts(spark, d).distinct(), shared_folder(spark)), Constraint("uk", ("order_id", "part_id"), "pair", unique=True)
    tables = [
        Table("line_part", once.select("order_id", "part_id", line), constraints=[Constraint("pk", ("line_id",), "pk", unique=True), pair]),
        Table("line_even", once.where("part_id % 10 > 0").select("order_id", "part_id", line), constraints=[pair]),
        Table("line_copy", once.unionAll(once), constraints=[]),
    ]
    return discover(_whole(profile_catalog(Catalog(spark, tables), SHIPPED)))


def exempt_relationships(spark, d):
    """A single key by constraint stays beside an accepted composite, others go; columns of the same names match where the target has no keys."""
    return _exempt(spark, d).select("source", F.array_join("source_columns", ",").alias("source_columns"), "target", F.array_join("target_columns", ",").alias("target_columns"), "cardinality", F.round("composite_score", 4).alias("composite_score"), "confidence_level", "decision", "reason", "discovery_method")


def graph_single_edges(spark, d):
    """One edge for each ordered pair of tables."""
    return G.join_edges(_exempt(spark, d).where("decision = 'accepted'"), single=True).select("src", "dst", "cardinality", "on", "relationship_id")


def graph_edges(spark, d):
    found = discover(profiled(spark, d)).where("decision = 'accepted'")
    return G.join_edges(found).select("src", "dst", "cardinality", "on", "relationship_id")


def graph_statistics(spark, d):
    p = profiled(spark, d)
    edges = G.join_edges(discover(p).where("decision = 'accepted'"))
    constraints = p.catalog.constraints_frame()
    tables = G.table_nodes(p.tables, constraints, p.keys)
    return G.graph_statistics(tables, G.column_nodes(p.columns), edges)


# --- Values, vectors, retrieval ----------------------------------------------------------------------------------------

DIMS = {"customer": ["c_mktsegment"], "part": ["p_brand", "p_type"], "nation": ["n_name"], "region": ["r_name"], "orders": ["o_orderpriority"]}


def dim_values_clean(spark, d):
    return _union([V.dim_values(_t(spark, d, n), n, cols) for n, cols in DIMS.items()])


def dim_value_loads(spark, d):
    return _union([V.dim_value_counts(_t(spark, d, n), n, cols) for n, cols in DIMS.items()])


def vector_topk(spark, d):
    """The ten vectors most like vector 0."""
    e = _t(spark, d, "embeddings")
    query = e.where("vec_id = 0").first().embedding
    return Q.top_k(e, query, 10).select("vec_id", F.round("similarity", 5).alias("similarity"))


def vector_topk_join(spark, d):
    """For every vector whose id is divisible by 100 its five nearest."""
    e = _t(spark, d, "embeddings")
    out = X.exact_top_k(e.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), "embedding"), e, 5)
    return out.select("query_id", "vec_id", F.round("similarity", 5).alias("similarity"), F.col("rank").cast("bigint").alias("rank"))


def _indexed(spark, d):
    """An index of all vectors, and every vector whose id is divisible by 100."""
    e = _t(spark, d, "embeddings").select("vec_id", "embedding")
    return X.build_index(e, shared_folder(spark)), e.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), "embedding")


def vector_index_topk(spark, d):
    """The five nearest by an index of inverted lists, which goes on until no other list can better them."""
    index, queries = _indexed(spark, d)
    return index.search(queries, 5, probes=4, exact=True).select("query_id", F.col("id").alias("vec_id"), F.round("similarity", 5).alias("similarity"), F.col("rank").cast("bigint").alias("rank"))


def vector_index_recall(spark, d):
    """How many of the ten nearest a search by three of four lists finds, and what it reads: one row.  These vectors have no clusters, so few lists would not do."""
    index, queries = _indexed(spark, d)
    probes = index.lists.count() * 3 // 4
    exact = X.exact_top_k(queries, _t(spark, d, "embeddings").select("vec_id", "embedding"), 10).select("query_id", F.col("vec_id").alias("id"))
    found = index.search(queries, 10, probes).select("query_id", "id", F.lit(1).alias("hit"))
    recall = exact.join(found, ["query_id", "id"], "left").agg(F.count_distinct("query_id").alias("queries"), (F.sum("hit") / F.count("*") >= 0.9).alias("recall_reached"))
    return recall.crossJoin(index.compared(queries, probes).agg((F.avg("n") < 0.85 * index.vectors.count()).alias("reads_fewer")))


def vector_upsert(spark, d):
    """Labels of even vectors replaced."""
    e = _t(spark, d, "embeddings").select("vec_id", F.col("label").cast("bigint").alias("label"))
    new = e.where("vec_id % 2 = 0").select("vec_id", (F.col("label") + 1000).alias("label"))
    return Q.upsert(e, new, "vec_id")


def merged_vectors(spark, d):
    """Vectors in batches: all of them, every second one with a new label, that batch again, and every fifth one deleted."""
    e = _t(spark, d, "embeddings").select("vec_id", F.col("label").cast("bigint").alias("label"), F.element_at("embedding", 1).cast("double").alias("first"))
    table = U.merged_table(spark, shared_folder(spark), e.schema, ["vec_id"])
    even = e.where("vec_id % 2 = 0").withColumn("label", F.col("label") + 1000)
    for batch, rows, gone in (("all", e, None), ("even", even, None), ("even", even, None), ("gone", e.limit(0), e.where("vec_id % 5 = 0").select("vec_id"))):
        table.merge(rows, batch, gone)
    return table.read().select("vec_id", "label", F.round("first", 5).alias("first"))


def merged_graph(spark, d):
    """Edges of the discovered graph, one for each ordered pair of tables, loaded twice; the second load brings other counts of joined rows."""
    found = _exempt(spark, d).where("decision = 'accepted'")
    edges = G.join_edges(found, single=True).select("src", "dst", "cardinality", "relationship_id")
    rows = {n: _t(spark, d, n).count() for n in ("lineitem", "orders")}
    edges = written(edges, f"{shared_folder(spark)}/edges")
    table = U.merged_table(spark, shared_folder(spark), "src string, dst string, cardinality string, relationship_id string, load bigint", ["src", "dst"], 8)
    for load, some in (("first", edges), ("second", edges.where("cardinality = 'N:1'"))):
        table.merge(some.withColumn("load", F.lit(rows["lineitem" if load == "first" else "orders"])), load)
    return table.read()


def example_ids(spark, d):
    return _t(spark, d, "conversations").select("conv_id", "turn", Q.example_id(F.lit("corpus"), F.col("role"), F.col("text")).alias("example_id"))


def retrieval_objects(spark, d):
    p = profiled(spark, d)
    texts = spark.createDataFrame([(t.schema, t.name, E.markdown(t)) for t in p.catalog], "schema string, table string, text string")
    return Q.retrieval_objects(p.tables, p.columns, texts).select("object_type", "object_id", "parent_id", "time_col_hint", "table_category")


def metadata_files(spark, d):
    """DDL, JSON and Markdown of the profiled star tables, written as files and read again as columns: one row for each column."""
    p, path = profiled(spark, d), shared_folder(spark)
    FS.register(spark)
    roles = {}
    for r in p.columns.orderBy("ordinal").collect():
        roles.setdefault(r.table, []).append(r)
    tables = {r.table: r for r in p.tables.collect()}
    texts = []
    for t in p.catalog:
        name = f"{t.database}.{t.full_name}"
        document = E.profile_json(t, roles[t.name], tables[t.name], p.logical_keys[t.full_name])
        texts += [(f"{name}.sql", E.ddl(t)), (f"{name}.json", json.dumps(document)), (f"{name}.md", E.markdown(t))]
    spark.createDataFrame(texts, "file string, text string").repartition(4).write.format("table_metadata").option("path", path).mode("append").save()
    read = lambda kind, of="columns": spark.read.format("table_metadata").option("path", path).option("kind", kind).option("object", of).load()
    of_ddl = read("ddl").select("table", "column", "ordinal", "data_type")
    of_json = read("json").select("table", "column", "role", "sample_count", "null_count")
    of_markdown = read("markdown").select("table", "column", F.col("data_type").alias("shown_type"))
    keys = read("ddl", "constraints").where("kind = 'pk'").select("table", F.explode("columns").alias("column"), F.lit(True).alias("in_key"))
    on = ["table", "column"]
    return of_ddl.join(of_json, on).join(of_markdown, on).join(keys, on, "left").fillna({"in_key": False})


#: Columns with a comment: every second one that holds neither fractions nor times.
COMMENTED = {t: [c for c in list(of)[::2] if c not in ("l_quantity", "l_discount", "o_orderdate", "l_shipdate")] for t, of in COLUMNS.items()}


def retrieval_columns(spark, d):
    """Objects of the columns that have a comment, which tells the column's least value; tables have blank texts."""
    least = {n: _t(spark, d, n).agg(*[F.min(c).cast("string").alias(c) for c in some]).first().asDict() for n, some in COMMENTED.items()}
    p = profiled(spark, d)
    said = spark.createDataFrame([("public", n, c, f"  from {v} on ") for n, of in least.items() for c, v in of.items()], "schema string, table string, column string, comment string")
    columns = p.columns.drop("comment").join(said, ["schema", "table", "column"], "left")
    texts = spark.createDataFrame([(t.schema, t.name, " ") for t in p.catalog], "schema string, table string, text string")
    return Q.retrieval_objects(p.tables, columns, texts)


# --- The SQL that question/SQL pairs are made of -----------------------------------------------------------------------


def sql_corpus_filter_sort(spark, d):
    o = _t(spark, d, "orders")
    return o.where((F.col("o_orderdate") >= F.lit("1995-01-01").cast("timestamp_ntz")) & (F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz")) & F.col("o_orderpriority").isNotNull()).select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(100)


def sql_corpus_join_group(spark, d):
    n, c, o = _t(spark, d, "nation"), _t(spark, d, "customer"), _t(spark, d, "orders")
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    return j.groupBy("n_name").agg(F.count("*").alias("order_count"), F.count_distinct("c_custkey").alias("customers"), F.round(F.sum("o_totalprice"), 2).alias("revenue"))


def sql_corpus_having(spark, d):
    li = _t(spark, d, "lineitem")
    return li.groupBy("l_suppkey").agg(F.round(F.sum("l_quantity"), 2).alias("quantity"), F.count("*").alias("lines")).where("lines > 100")


def sql_corpus_distinct(spark, d):
    return _t(spark, d, "lineitem").select("l_returnflag", "l_linestatus").distinct()


def sql_corpus_three_tables(spark, d):
    """Lines meet their parts first and then lie by order, so that orders are told apart where their lines are."""
    li, o, p = _t(spark, d, "lineitem"), _t(spark, d, "orders"), _t(spark, d, "part")
    rows = li.count()
    by = lambda df, *columns: dealt(df.select(*columns), key_parts(spark, rows, rows), columns[0])
    price = (F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("decimal(18,4)").alias("price")
    lines = by(li, "l_partkey", "l_orderkey", price).join(by(p, "p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    orders = o.where("o_orderstatus = 'F' OR o_orderstatus = 'O'")
    j = by(lines, "l_orderkey", "p_brand", "price").join(by(orders, "o_orderkey", "o_orderstatus"), F.col("l_orderkey") == F.col("o_orderkey"))
    each = j.groupBy("o_orderkey", "p_brand", "o_orderstatus").agg(F.sum("price").alias("price"))
    return each.groupBy("p_brand", "o_orderstatus").agg(F.round(F.sum("price"), 2).cast("double").alias("revenue"), F.count("*").alias("order_count"))


#: Statements as pairs of questions and SQL have them; {x} is the view of table x.
STATEMENTS = {
    "orders by nation": "SELECT n.n_name, count(*) FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey JOIN {nation} n ON c.c_nationkey = n.n_nationkey GROUP BY n.n_name",
    "nations of a region": "SELECT * FROM {nation}, {region} WHERE n_regionkey = r_regionkey AND r_name <> 'ASIA'",
    "lines of dear orders": "WITH dear AS (SELECT o_orderkey AS k FROM {orders} WHERE o_totalprice > 1000) SELECT sum(l.l_quantity) FROM {lineitem} l WHERE l.l_orderkey IN (SELECT k FROM dear)",
    "suppliers without lines": "SELECT s_name FROM {supplier} s WHERE NOT EXISTS (SELECT 1 FROM {lineitem} WHERE l_suppkey = s.s_suppkey)",
    "parts and their lines": 'SELECT p_brand FROM {part} LEFT JOIN (SELECT `l_partkey` AS pk, l_tax FROM {lineitem}) x ON p_partkey = x.pk OR x.l_tax = 0',
    "customers of a supplier's nation": "SELECT c_name, s_name FROM {customer} JOIN {supplier} ON c_nationkey = s_nationkey",
}


def statement_joins(spark, d):
    """Joins of a set of statements beside the relationships that the data supports."""
    views = {n: f"quernstone_{n}" for n in STAR}
    for n, v in views.items():
        _t(spark, d, n).createOrReplaceTempView(v)
    joins = SQ.joins_of(spark, {name: sql.format(**views) for name, sql in STATEMENTS.items()})
    bare = lambda c: F.substring(c, len("quernstone_") + 1, 99).alias(c)
    edges = G.join_edges(discover(profiled(spark, d)).where("decision = 'accepted'"))
    return SQ.supported(joins.select("statement", bare("left"), "left_column", bare("right"), "right_column"), edges)


# --- Streams -----------------------------------------------------------------------------------------------------------


def events_windowed_profile(spark, d):
    out = windowed_profile(_t(spark, d, "events"), "ts", ["value", "user_id"], "1 day")
    return out.select(F.date_format("window_start", "yyyy-MM-dd").alias("day"), F.col("column").alias("column_name"), "rows", "nulls", F.round("mean", 4).alias("mean"))


def events_stateful_profile(spark, d):
    """A stream of the events of the second half of the month, in four files, whose state starts from a profile of the first."""
    events, folder, columns = _t(spark, d, "events").select("ts", "value", "event_type"), shared_folder(spark), ["value", "event_type"]
    half = F.lit("2024-01-16").cast("timestamp_ntz")
    later = events.where(F.col("ts") >= half)
    later.repartitionByRange(4, "ts").sortWithinPartitions("ts").write.parquet(f"{folder}/arriving")
    stored = written(ST.stored_profile(events.where(F.col("ts") < half), "ts", columns), f"{folder}/stored")
    stream = spark.readStream.schema(later.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/arriving")
    emitted = ST.run_profile(ST.profile_stream(stream, "ts", columns, late="30 days", stored=stored), folder)
    known = stored.withColumn("distinct_values", F.size("values").cast("bigint")).drop("values").withColumn("closed", F.lit(False))
    out = ST.merged(known.unionByName(emitted))
    return out.select(F.date_format("window_start", "yyyy-MM-dd").alias("day"), F.col("column").alias("column_name"), "rows", "nulls", "distinct_values", F.round("mean", 6).alias("mean"))


def queries() -> dict:
    found = (
        row_counts, col_null_rate, col_uniqueness, col_numeric_stats, col_length_stats, value_distribution, full_profile_lineitem, corpus_text_profile,
        complex_value_distinct, json_value_distinct, ddl_preview_sample, block_samples, sample_cells, unique_columns, composite_distinct, logical_keys, wide_table_keys, column_roles, table_categories, corpus_roles, bridge_categories, composite_foreign_keys,
        inclusion_jaccard, inferred_cardinality, relationship_scores, relationship_decisions, discover_relationships, name_candidates, sketched_decisions, foreign_key_relationships, composite_relationships, exempt_relationships, graph_single_edges, graph_edges, graph_statistics,
        dim_values_clean, dim_value_loads, vector_topk, vector_topk_join, vector_index_topk, vector_index_recall, vector_upsert, merged_vectors, merged_graph, example_ids, retrieval_objects, retrieval_columns,
        sql_corpus_filter_sort, sql_corpus_join_group, sql_corpus_having, sql_corpus_distinct, sql_corpus_three_tables, statement_joins, events_windowed_profile, events_stateful_profile, metadata_files,
    )
    return {f.__name__: f for f in found}


# --- SQL twins ---------------------------------------------------------------------------------------------------------


def _columns_sql(make, kinds: str = "nst") -> str:
    return " UNION ALL ".join(make(t, c, k) for t in STAR for c, k in COLUMNS[t].items() if k in kinds)


def _overlap_sql(s, sc, t, tc) -> str:
    name = f"{s}.{','.join(sc)}->{t}.{','.join(tc)}"
    keys = lambda cols: ", ".join(f"{c} AS k{i}" for i, c in enumerate(cols))
    ks = ", ".join(f"k{i}" for i in range(len(sc)))
    some = lambda cols: " AND ".join(f"{c} IS NOT NULL" for c in cols)
    side = lambda table, cols: f"(SELECT {ks}, count(*) AS n FROM (SELECT {keys(cols)} FROM {table} WHERE {some(cols)}) GROUP BY {ks})"
    return (
        f"SELECT '{name}' AS relationship, (SELECT sum(n) FROM {side(s, sc)}) AS source_rows, (SELECT sum(n) FROM {side(t, tc)}) AS target_rows, "
        f"(SELECT count(*) FROM {side(s, sc)}) AS source_distinct, (SELECT count(*) FROM {side(t, tc)}) AS target_distinct, "
        f"count(*) AS common, coalesce(sum(a.n * b.n), 0) AS joined_rows FROM {side(s, sc)} a JOIN {side(t, tc)} b USING ({ks})"
    )


def _metrics_sql(pairs=PAIRS) -> str:
    return (
        "SELECT relationship, source_distinct, target_distinct, common, joined_rows, common / source_distinct AS inclusion_rate, common / (source_distinct + target_distinct - common) AS jaccard_index, "
        "source_distinct / source_rows AS su, target_distinct / target_rows AS tu, joined_rows / source_rows AS m FROM (" + " UNION ALL ".join(_overlap_sql(*p) for p in pairs) + ")"
    )


_CARDINALITY = (
    "CASE WHEN su >= 0.95 AND tu >= 0.95 THEN '1:1' WHEN su >= 0.95 AND tu < 0.8 THEN '1:N' WHEN su < 0.8 AND tu >= 0.95 THEN 'N:1' WHEN m <= 1.1 AND su >= tu THEN '1:1' "
    "WHEN m <= 1.1 THEN 'N:1' WHEN m > 1.5 AND su >= 0.85 THEN '1:N' ELSE 'M:N' END"
)


#: Matching characters of the names of SCORED pairs, characters of both, and how well their types go together.
_NAMES = [(9, 20, 1.0), (10, 22, 1.0), (10, 22, 1.0), (10, 22, 1.0), (8, 18, 1.0), (8, 18, 1.0), (8, 18, 1.0), (6, 20, 0.9), (2, 16, 0.6)]


def _scores_sql() -> str:
    """Name similarities and type scores are literals."""
    rows = [f"('{s}.{sc[0]}->{t}.{tc[0]}', 'public.{s}', 'public.{t}', '{sc[0]}', '{tc[0]}', 2.0 * {m} / {n}, {kind})" for (s, sc, t, tc), (m, n, kind) in zip(SCORED, _NAMES, strict=True)]
    return (
        f"WITH m AS ({_metrics_sql(SCORED)}), c(relationship, source, target, sc, tc, names, types) AS (VALUES {', '.join(rows)}) "
        "SELECT 'rel_' || substr(md5(source || '.[' || sc || ']->' || target || '.[' || tc || ']'), 1, 12) AS relationship_id, source, target, "
        f"0.55 * inclusion_rate + 0.2 * jaccard_index + 0.15 * names + 0.1 * types AS raw_score, {_CARDINALITY} AS cardinality FROM m JOIN c USING (relationship)"
    )


def _foreign_sql(related: str) -> str:
    """The foreign keys, N:1 unless the source column is nearly unique too, and accepted candidates between other columns."""
    name = lambda s, a, t, b: f"'rel_' || substr(md5('public.{s}.[{a}]->public.{t}.[{b}]'), 1, 12)"
    stated = [f"SELECT {name(*k)} AS relationship_id, 'public.{k[0]}' AS source, '{k[1]}' AS source_columns, 'public.{k[2]}' AS target, '{k[3]}' AS target_columns, CASE WHEN round(count(DISTINCT {k[1]}) / count(*), 4) >= 0.95 THEN '1:1' ELSE 'N:1' END AS cardinality, 'accepted' AS decision, 'foreign_key_constraint' AS discovery_method FROM {k[0]}" for k in FOREIGN]
    ends = ", ".join(f"('public.{s}.{a}', 'public.{t}.{b}'), ('public.{t}.{b}', 'public.{s}.{a}')" for s, a, t, b in FOREIGN)
    found = f"SELECT relationship_id, source, source_columns, target, target_columns, cardinality, decision, 'active_search' AS discovery_method FROM ({related}) WHERE decision = 'accepted' AND (source || '.' || source_columns, target || '.' || target_columns) NOT IN ({ends})"
    return " UNION ALL ".join([*stated, found])


_COMPOSITE_SQL = """
WITH a AS (SELECT DISTINCT l_orderkey AS o, l_partkey AS p FROM lineitem), b AS (SELECT * FROM a WHERE p % 2 = 0),
n AS (SELECT (SELECT count(*) FROM a) AS na, (SELECT count(*) FROM b) AS nb, (SELECT count(*) FROM a JOIN b USING (o, p)) AS shared),
d(source, target, share) AS (SELECT 'line_part', 'line_value', shared / na FROM n UNION ALL SELECT 'line_value', 'line_part', shared / nb FROM n),
s AS (SELECT source, target, 0.55 * share + 0.2 * shared / (na + nb - shared) + 0.15 + 0.1 AS score FROM d, n),
c(cols, single, method) AS (VALUES ('order_id,part_id', false, 'physical_constraint_matching'), ('line_id', true, 'logical_key_matching'))
SELECT 'public.' || source AS source, cols AS source_columns, 'public.' || target AS target, cols AS target_columns, '1:1' AS cardinality, round(score, 4) AS composite_score,
       CASE WHEN score >= 0.65 AND NOT single THEN 'accepted' ELSE 'rejected' END AS decision,
       CASE WHEN score < 0.65 THEN 'below_threshold' WHEN single THEN 'suppressed_by_composite' END AS reason, method AS discovery_method
FROM s, c
"""


_LINKED = """
WITH li AS (SELECT l_orderkey AS o, l_partkey AS p, l_suppkey AS s FROM lineitem), lines AS (SELECT o, p, count(*) AS n FROM li GROUP BY o, p),
c(t, category, confidence, basis, fk, pk, cols) AS (VALUES
  ('orders_of', 'unknown', 0.5, '', 0, 1, 2), ('supplier_of', 'unknown', 0.5, '', 0, 1, 2), ('line_of', 'fact', 0.85, 'fact_has_metric,fact_dimension_columns', 0, 2, 3),
  ('order_supplier', 'bridge', 0.85, 'bridge_fk_threshold', 2, 0, 2), ('line_note', 'bridge', 0.85, 'bridge_fk_threshold', 2, 0, 3))
SELECT t AS "table", category, CAST(confidence AS DOUBLE) AS confidence, basis, fk AS foreign_key_count, pk AS primary_key_count, cols AS total_columns FROM c
"""

_LINKED_KEYS = """
WITH k(s, sc, t, tc) AS (VALUES ('order_supplier', 'order_id', 'orders_of', 'id'), ('order_supplier', 'supplier_id', 'supplier_of', 'id'), ('line_note', 'order_id,part_id', 'line_of', 'order_id,part_id')),
u AS (SELECT round(count(DISTINCT l_orderkey) / count(*), 4) AS o, round(count(DISTINCT l_suppkey) / count(*), 4) AS s FROM (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem)),
n AS (SELECT round(count(DISTINCT o) / count(*), 4) AS o, round(count(DISTINCT p) / count(*), 4) AS p FROM (SELECT l_orderkey AS o, l_partkey AS p FROM lineitem GROUP BY ALL HAVING count(*) = 1))
SELECT 'rel_' || substr(md5('public.' || k.s || '.[' || sc || ']->public.' || t || '.[' || tc || ']'), 1, 12) AS relationship_id, 'public.' || k.s AS source, sc AS source_columns, 'public.' || t AS target, tc AS target_columns,
       CASE WHEN CASE sc WHEN 'order_id' THEN u.o WHEN 'supplier_id' THEN u.s ELSE least(n.o, n.p) END >= 0.95 THEN '1:1' ELSE 'N:1' END AS cardinality, 'accepted' AS decision
FROM k, u, n
"""

#: All columns of a relationship of line_part, line_even and line_copy: a composite is found both ways where both ends have keys.
_EXEMPT_SQL = """
WITH a AS (SELECT DISTINCT l_orderkey AS o, l_partkey AS p FROM lineitem), n AS (SELECT count(*) AS na, count(*) FILTER (WHERE p % 10 > 0) AS nb FROM a),
d(source, target, ns, nt, common, twice) AS (
  SELECT 'line_part', 'line_even', na, nb, nb, false FROM n UNION ALL SELECT 'line_even', 'line_part', nb, na, nb, false FROM n
  UNION ALL SELECT 'line_part', 'line_copy', na, na, na, true FROM n UNION ALL SELECT 'line_even', 'line_copy', nb, na, nb, true FROM n),
c(cols, single) AS (VALUES ('order_id,part_id', false), ('line_id', true)),
s AS (SELECT *, 0.55 * common / ns + 0.2 * common / (ns + nt - common) + 0.15 + 0.1 AS score, single AND source = 'line_part' AS exempt FROM d, c WHERE NOT (twice AND single)),
r AS (SELECT *, CASE WHEN score < 0.65 THEN 'below_threshold' WHEN single AND NOT exempt AND bool_or(score >= 0.65 AND NOT single) OVER (PARTITION BY source, target) THEN 'suppressed_by_composite' END AS reason FROM s)
SELECT 'public.' || source AS source, cols AS source_columns, 'public.' || target AS target, cols AS target_columns, CASE WHEN twice THEN '1:N' ELSE '1:1' END AS cardinality, score,
       round(score, 4) AS composite_score, CASE WHEN score >= 0.9 THEN 'high' WHEN score >= 0.8 THEN 'medium' ELSE 'low' END AS confidence_level, CASE WHEN reason IS NULL THEN 'accepted' ELSE 'rejected' END AS decision, reason,
       CASE WHEN NOT single THEN 'physical_constraint_matching' WHEN exempt THEN 'active_search' ELSE 'logical_key_matching' END AS discovery_method
FROM r
"""

_SINGLE_EDGES = f"""
WITH r AS (SELECT *, 'rel_' || substr(md5(source || '.[' || source_columns || ']->' || target || '.[' || target_columns || ']'), 1, 12) AS id FROM ({_EXEMPT_SQL}) WHERE decision = 'accepted'),
e AS (SELECT CASE WHEN cardinality = '1:N' THEN target ELSE source END AS src, CASE WHEN cardinality = '1:N' THEN source ELSE target END AS dst, CASE WHEN cardinality = '1:N' THEN 'N:1' ELSE cardinality END AS cardinality,
       array_to_string(list_transform(string_split(source_columns, ','), lambda c: 'SRC.' || c || ' = DST.' || c), ' AND ') AS "on", id AS relationship_id FROM r)
SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY src, dst ORDER BY relationship_id DESC) = 1
"""


def oracle_sql() -> dict[str, str]:
    # Rounded half up on whole numbers: 9 of 60000 is 0.0002 in any engine.
    share = lambda n: f"((20000 * ({n}) + count(*)) // (2 * count(*))) / 10000.0"
    text = lambda c: f"CAST({c} AS VARCHAR)"
    dims = [(n, c) for n, cols in DIMS.items() for c in cols]
    measured = lambda pairs: _metrics_sql([(s, (a,), t, (b,)) for s, a, t, b, *_ in pairs])
    related = W.relationships(measured(W.ALIKE), _CARDINALITY)
    discovered = W.discovered(measured([*W.ALIKE, *W.ALIKE_IF_KEY]), _CARDINALITY, COLUMNS)
    turn = lambda a, b: f"CASE WHEN cardinality = '1:N' THEN {b} ELSE {a} END"
    edges = f"SELECT {turn('source', 'target')} AS src, {turn('target', 'source')} AS dst, CASE WHEN cardinality = '1:N' THEN 'N:1' ELSE cardinality END AS cardinality, 'SRC.' || {turn('source_columns', 'target_columns')} || ' = DST.' || {turn('target_columns', 'source_columns')} AS \"on\", relationship_id FROM ({related}) WHERE decision = 'accepted'"
    cosine = "list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))"
    number = lambda c, k: f"round(min({c}), 4) AS min_value, round(max({c}), 4) AS max_value, round(avg({c}), 4) AS mean_value" if k == "n" else "CAST(NULL AS DOUBLE) AS min_value, CAST(NULL AS DOUBLE) AS max_value, CAST(NULL AS DOUBLE) AS mean_value"
    lengths = lambda c, k: f"round(avg(length({c})), 2) AS avg_length, round(coalesce(stddev_samp(length({c})), 0), 2) AS length_std" if k == "s" else "CAST(NULL AS DOUBLE) AS avg_length, CAST(NULL AS DOUBLE) AS length_std"
    return {
        "row_counts": " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in STAR),
        "col_null_rate": _columns_sql(lambda t, c, k: f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS sample_count, count(*) - count({c}) AS null_count, {share(f'(count(*) - count({c}))')} AS null_rate FROM {t}"),
        "col_uniqueness": _columns_sql(lambda t, c, k: f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(DISTINCT {c}) AS unique_count, {share(f'count(DISTINCT {c})')} AS uniqueness FROM {t}"),
        "col_numeric_stats": _columns_sql(lambda t, c, k: f"SELECT '{t}' AS table_name, '{c}' AS column_name, round(CAST(min({c}) AS DOUBLE), 4) AS min_value, round(CAST(max({c}) AS DOUBLE), 4) AS max_value, round(avg({c}), 4) AS mean_value FROM {t}", "n"),
        "col_length_stats": _columns_sql(lambda t, c, k: f"SELECT '{t}' AS table_name, '{c}' AS column_name, round(avg(length({c})), 2) AS avg_length, min(length({c})) AS min_length, max(length({c})) AS max_length, round(quantile_cont(length({c}), 0.5), 2) AS median_length, round(coalesce(stddev_samp(length({c})), 0), 2) AS length_std FROM {t}", "s"),
        "value_distribution": "SELECT table_name, column_name, value, n, rank FROM (SELECT *, count(*) OVER (PARTITION BY table_name, column_name) AS u, row_number() OVER (PARTITION BY table_name, column_name ORDER BY n DESC, value) AS rank FROM ("
        + " UNION ALL ".join(f"SELECT '{t}' AS table_name, '{c}' AS column_name, {c} AS value, count(*) AS n FROM {t} WHERE {c} IS NOT NULL GROUP BY {c}" for t in STAR for c, k in COLUMNS[t].items() if k == "s") + ")) WHERE u <= 10 AND rank <= 10",
        "full_profile_lineitem": " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) AS sample_count, {share(f'(count(*) - count({c}))')} AS null_rate, count(DISTINCT {c}) AS unique_count, {share(f'count(DISTINCT {c})')} AS uniqueness, {number(c, k)}, {lengths(c, k)} FROM lineitem" for c, k in COLUMNS["lineitem"].items()),
        "corpus_text_profile": "SELECT source, count(*) AS docs, round(avg(length(text)), 2) AS avg_length, min(length(text)) AS min_length, max(length(text)) AS max_length, round(quantile_cont(length(text), 0.5), 2) AS median_length FROM documents GROUP BY source",
        "complex_value_distinct": "SELECT count(*) AS row_count, count(DISTINCT embedding) AS distinct_values FROM embeddings",
        "json_value_distinct": "SELECT event_type, count(*) AS row_count, count(DISTINCT props) AS distinct_props, count(DISTINCT json_extract_string(props, '$.k')) AS distinct_swapped FROM events GROUP BY event_type",
        "ddl_preview_sample": " UNION ALL ".join(f"SELECT * FROM (SELECT '{n}' AS table_name, CAST({k[0]} AS BIGINT) AS key_value, {text(list(COLUMNS[n])[1])} AS second_value FROM {n} ORDER BY key_value LIMIT 5)" for n, k in KEYS.items()),
        "block_samples": " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count, CAST(ceil(count(*) / 10) AS BIGINT) AS sample_rows, 0 AS foreign_rows, true AS reads_follow FROM {n}" for n in ("customer", "orders", "events", "lineitem")),
        "sample_cells": "SELECT doc_id, CASE WHEN length(text) > 200 THEN substr(text, 1, 200) || '...' ELSE text END AS text_cell, CASE WHEN length(text) > 100 THEN substr(text, 1, 100) || '...' ELSE coalesce(text, '') END AS text_short FROM documents",
        "unique_columns": "SELECT table_name, column_name, unique_count FROM (" + _columns_sql(lambda t, c, k: f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(DISTINCT {c}) AS unique_count, count(*) AS n FROM {t}") + ") WHERE unique_count = n",
        "composite_distinct": " UNION ALL ".join(f"SELECT '{s}' AS column_set, count(*) AS distinct_rows FROM (SELECT DISTINCT {s} FROM lineitem)" for s in ("l_orderkey,l_linenumber", "l_partkey,l_suppkey", "l_orderkey,l_partkey,l_linenumber")),
        "logical_keys": f"SELECT t AS \"table\", column_set, confidence FROM ({W.logical_keys(COLUMNS)})",
        "column_roles": f"SELECT t AS \"table\", c AS \"column\", kind AS data_type, role, confidence, basis FROM ({W.roles(COLUMNS, KEYS)})",
        "table_categories": f"SELECT t AS \"table\", category, confidence, basis, total_columns, identifier_count, metric_count, datetime_count FROM ({W.categories(COLUMNS, KEYS)})",
        "discover_relationships": f"SELECT relationship_id, source, source_columns, target, target_columns, cardinality, round(score, 4) AS composite_score, decision, reason, 'logical_key_matching' AS discovery_method FROM ({discovered})",
        "foreign_key_relationships": _foreign_sql(related),
        "composite_relationships": _COMPOSITE_SQL,
        "graph_edges": edges,
        "graph_statistics": f"SELECT 'table' AS kind, count(DISTINCT t) AS count FROM ({W.profiles(COLUMNS, KEYS)}) UNION ALL SELECT unnest(['column', 'has_column']), count(*) FROM ({W.profiles(COLUMNS, KEYS)}) UNION ALL SELECT 'join_on', count(*) FROM ({edges})",
        "retrieval_objects": f"SELECT 'table' AS object_type, 'public.' || k.t AS object_id, 'public.' || k.t AS parent_id, (SELECT min_by(c, ord) FROM ({W.roles(COLUMNS, KEYS)}) r WHERE r.t = k.t AND role = 'datetime') AS time_col_hint, category AS table_category FROM ({W.categories(COLUMNS, KEYS)}) k",
        "inclusion_jaccard": f"SELECT relationship, source_distinct, target_distinct, common, round(inclusion_rate, 6) AS inclusion_rate, round(jaccard_index, 6) AS jaccard_index FROM ({_metrics_sql()})",
        "inferred_cardinality": f"SELECT relationship, CAST(joined_rows AS BIGINT) AS joined_rows, round(m, 6) AS multiplicity, {_CARDINALITY} AS cardinality FROM ({_metrics_sql()})",
        "relationship_scores": f"SELECT relationship_id, source, target, round(raw_score, 4) AS composite_score, cardinality FROM ({_scores_sql()})",
        "relationship_decisions": f"SELECT relationship_id, CASE WHEN raw_score >= 0.8 THEN 'accepted' ELSE 'rejected' END AS decision, CASE WHEN raw_score < 0.8 THEN 'below_threshold' END AS reason FROM ({_scores_sql()})",
        "dim_values_clean": " UNION ALL ".join(f"SELECT DISTINCT '{n}' AS table_name, '{c}' AS column_name, substr(trim({c}), 1, 1024) AS value FROM {n} WHERE length(trim({c})) > 0" for n, c in dims),
        "dim_value_loads": " UNION ALL ".join(f"SELECT '{n}' AS table_name, '{c}' AS column_name, count(DISTINCT CASE WHEN length(trim({c})) > 0 THEN substr(trim({c}), 1, 1024) END) AS loaded, count(*) - count(CASE WHEN length(trim({c})) > 0 THEN 1 END) AS skipped FROM {n}" for n, c in dims),
        "vector_topk": f"SELECT b.vec_id, round({cosine}, 5) AS similarity FROM (SELECT embedding FROM embeddings WHERE vec_id = 0) a CROSS JOIN embeddings b ORDER BY {cosine} DESC, b.vec_id LIMIT 10",
        "wide_table_keys": W.composite_keys("order_parts", PARTS, f"SELECT {', '.join(f'CAST(o_orderkey // {by} % {mod} AS BIGINT) AS {c}' for c, (by, mod) in PARTS.items())} FROM orders"),
        "name_candidates": W.candidate_pairs(COLUMNS),
        "sketched_decisions": f"SELECT relationship_id, source, source_columns, target, target_columns, decision, reason FROM ({discovered})",
        "vector_index_topk": f"SELECT query_id, vec_id, round(s, 5) AS similarity, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, vec_id) AS rank FROM (SELECT a.vec_id AS query_id, b.vec_id, {cosine} AS s FROM embeddings a CROSS JOIN embeddings b WHERE a.vec_id % 100 = 0)) WHERE rank <= 5",
        "vector_index_recall": "SELECT count(*) AS queries, true AS recall_reached, true AS reads_fewer FROM embeddings WHERE vec_id % 100 = 0",
        "vector_topk_join": f"SELECT query_id, vec_id, round(s, 5) AS similarity, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, vec_id) AS rank FROM (SELECT a.vec_id AS query_id, b.vec_id, {cosine} AS s FROM embeddings a CROSS JOIN embeddings b WHERE a.vec_id % 100 = 0)) WHERE rank <= 5",
        "vector_upsert": "SELECT vec_id, CAST(label AS BIGINT) + CASE WHEN vec_id % 2 = 0 THEN 1000 ELSE 0 END AS label FROM embeddings",
        "example_ids": "SELECT conv_id, turn, 'corpus:' || substr(sha256(role || text), 1, 8) AS example_id FROM conversations",
        "sql_corpus_filter_sort": "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate < TIMESTAMP '1996-01-01' AND o_orderpriority IS NOT NULL ORDER BY o_totalprice DESC, o_orderkey LIMIT 100",
        "sql_corpus_join_group": "SELECT n_name, count(*) AS order_count, count(DISTINCT c_custkey) AS customers, round(sum(o_totalprice), 2) AS revenue FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name",
        "sql_corpus_having": "SELECT l_suppkey, round(sum(l_quantity), 2) AS quantity, count(*) AS lines FROM lineitem GROUP BY l_suppkey HAVING count(*) > 100",
        "sql_corpus_distinct": "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem",
        "sql_corpus_three_tables": "SELECT p_brand, o_orderstatus, CAST(round(sum(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18, 4))), 2) AS DOUBLE) AS revenue, count(DISTINCT o_orderkey) AS order_count FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey WHERE o_orderstatus = 'F' OR o_orderstatus = 'O' GROUP BY p_brand, o_orderstatus",
        "statement_joins": f"""
WITH j(statement, "left", left_column, "right", right_column) AS (VALUES
  ('orders by nation', 'customer', 'c_custkey', 'orders', 'o_custkey'), ('orders by nation', 'customer', 'c_nationkey', 'nation', 'n_nationkey'), ('nations of a region', 'nation', 'n_regionkey', 'region', 'r_regionkey'),
  ('lines of dear orders', 'lineitem', 'l_orderkey', 'orders', 'o_orderkey'), ('suppliers without lines', 'lineitem', 'l_suppkey', 'supplier', 's_suppkey'), ('customers of a supplier''s nation', 'customer', 'c_nationkey', 'supplier', 's_nationkey')),
e AS ({edges}), p AS (SELECT src, dst, "on", relationship_id, cardinality FROM e UNION ALL SELECT dst, src, 'SRC.' || split_part("on", 'DST.', 2) || ' = DST.' || split_part(split_part("on", 'SRC.', 2), ' = ', 1), relationship_id, cardinality FROM e)
SELECT j.*, min(relationship_id) AS relationship_id, arg_min(cardinality, relationship_id) AS cardinality FROM j LEFT JOIN p ON src = 'public.' || "left" AND dst = 'public.' || "right" AND "on" = 'SRC.' || left_column || ' = DST.' || right_column GROUP BY ALL
""",
        "merged_vectors": "SELECT vec_id, CAST(label AS BIGINT) + CASE WHEN vec_id % 2 = 0 THEN 1000 ELSE 0 END AS label, round(CAST(embedding[1] AS DOUBLE), 5) AS first FROM embeddings WHERE vec_id % 5 <> 0",
        "merged_graph": f"SELECT src, dst, cardinality, relationship_id, CASE WHEN cardinality = 'N:1' THEN (SELECT count(*) FROM orders) ELSE (SELECT count(*) FROM lineitem) END AS load FROM ({_SINGLE_EDGES})",
        "corpus_roles": f"WITH record_log AS (SELECT {', '.join(f'{e} AS {c}' for c, e in _LOG.items())} FROM events) SELECT t AS \"table\", c AS \"column\", kind AS data_type, role, confidence, basis, {W.audit_facts()} FROM ({W.roles(CORPUS, {})})",
        "bridge_categories": _LINKED,
        "composite_foreign_keys": _LINKED_KEYS,
        "exempt_relationships": f"SELECT * EXCLUDE (score) FROM ({_EXEMPT_SQL})",
        "graph_single_edges": _SINGLE_EDGES,
        "retrieval_columns": " UNION ALL ".join(f"SELECT 'column' AS object_type, 'public.{t}.{c}' AS object_id, 'public.{t}' AS parent_id, 'from ' || CAST(min({c}) AS VARCHAR) || ' on' AS object_desc, CAST(NULL AS VARCHAR) AS time_col_hint, CAST(NULL AS VARCHAR) AS table_category FROM {t}" for t, some in COMMENTED.items() for c in some),
        "events_stateful_profile": " UNION ALL ".join(f"SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, '{c}' AS column_name, count(*) AS rows, count(*) - count({c}) AS nulls, count(DISTINCT {c}) AS distinct_values, {mean} AS mean FROM events GROUP BY date_trunc('day', ts)" for c, mean in (("value", "round(avg(value), 6)"), ("event_type", "CAST(NULL AS DOUBLE)"))),
        "metadata_files": f"SELECT t AS \"table\", c AS \"column\", ord + 1 AS ordinal, kind AS data_type, kind AS shown_type, role, rows AS sample_count, nulls AS null_count, pk AS in_key FROM ({W.roles(COLUMNS, KEYS)})",
        "events_windowed_profile": " UNION ALL ".join(f"SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, '{c}' AS column_name, count(*) AS rows, count(*) - count({c}) AS nulls, round(avg({c}), 4) AS mean FROM events GROUP BY date_trunc('day', ts)" for c in ("value", "user_id")),
    }
