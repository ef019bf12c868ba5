"""What a statement reads and joins, from Spark's analysed plan.

The analyser has resolved names, aliases, stars, common table expressions and
subqueries; what is left is to follow each column to the table that it comes
from, and to note which columns an equality must hold for.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .sqlcheck import normalise, portable

JOINS = "statement string, left string, left_column string, right string, right_column string"


@dataclass(frozen=True)
class Statement:
    """Tables, (table, column) pairs that are used anywhere, and pairs of columns that must be equal; all sorted."""

    tables: list[str]
    columns: list[tuple[str, str]]
    joins: list[tuple[tuple[str, str], tuple[str, str]]]


def _listed(seq) -> Iterator:
    return (seq.apply(i) for i in range(seq.size()))


def _kind(node) -> str:
    return node.getClass().getSimpleName()


def _bare(e):
    """An expression without casts around it, and a column of an outer query as itself."""
    while _kind(e) in ("Cast", "OuterReference"):
        e = e.e() if _kind(e) == "OuterReference" else e.child()
    return e


@dataclass
class _Walk:
    base: dict[int, tuple[str, str]] = field(default_factory=dict)
    same: dict[int, int] = field(default_factory=dict)
    equal: list[tuple[int, int]] = field(default_factory=list)
    used: set[int] = field(default_factory=set)
    tables: set[str] = field(default_factory=set)
    shared: dict[int, list[int]] = field(default_factory=dict)
    uses: list[tuple[int, list[int]]] = field(default_factory=list)

    def table(self, name: str, node) -> None:
        self.tables.add(name)
        for a in _listed(node.output()):
            self.base.setdefault(a.exprId().id(), (name, a.name()))

    def plan(self, node, name: str | None = None) -> None:
        kind, ids = _kind(node), lambda n: [a.exprId().id() for a in _listed(n.output())]
        if kind == "View":
            return self.table(node.desc().identifier().table(), node)
        if kind == "CTERelationRef":
            self.uses.append((node.cteId(), ids(node)))
            return None
        if kind == "SubqueryAlias":
            name = node.identifier().name()
        children = list(_listed(node.children()))
        if not children and name and kind not in ("LocalRelation", "OneRowRelation"):
            return self.table(name, node)
        for child in children:
            self.plan(child, name if kind == "SubqueryAlias" else None)
        if kind == "CTERelationDef":
            self.shared[node.id()] = ids(node)
        for e in _listed(node.expressions()):
            self.expression(e, kind in ("Join", "Filter"))
        return None

    def expression(self, e, must: bool) -> None:
        kind = _kind(e)
        if kind in ("AttributeReference", "OuterReference"):
            self.used.add(_bare(e).exprId().id())
        elif kind == "Alias":
            inner = _bare(next(_listed(e.children())))
            if _kind(inner) == "AttributeReference":
                self.same[e.exprId().id()] = inner.exprId().id()
        elif kind in ("EqualTo", "EqualNullSafe") and must:
            a, b = (_bare(x) for x in _listed(e.children()))
            if _kind(a) == _kind(b) == "AttributeReference":
                self.equal.append((a.exprId().id(), b.exprId().id()))
        elif kind == "InSubquery" and must:
            for a, b in zip(_listed(e.values()), _listed(e.query().plan().output()), strict=False):
                if _kind(_bare(a)) == "AttributeReference":
                    self.equal.append((_bare(a).exprId().id(), b.exprId().id()))
        if kind in ("ScalarSubquery", "Exists", "ListQuery", "LateralSubquery"):
            self.plan(e.plan())
        for x in _listed(e.children()):
            self.expression(x, must and kind == "And")
        if kind == "InSubquery":
            self.expression(e.query(), False)

    def link(self) -> None:
        """Columns of common tables, once all of their definitions have been seen."""
        for table, mine in self.uses:
            self.same.update({a: b for a, b in zip(mine, self.shared.get(table, []), strict=False) if a != b})

    def source(self, i: int) -> tuple[str, str] | None:
        seen = set()
        while i not in self.base and i in self.same and i not in seen:
            seen.add(i)
            i = self.same[i]
        return self.base.get(i)


def statement(spark: SparkSession, sql: str) -> Statement:
    """What one statement reads, by the session's tables and views; one that cannot be analysed is Spark's error.

    Joins are equalities of columns of two tables, or of two uses of one, that
    every row must meet: in ON, USING, WHERE, HAVING and IN (SELECT ...),
    through aliases, common tables and subqueries.  Those under OR and NOT are
    none.
    """
    walk = _Walk()
    walk.plan(spark.sql(f"SELECT * FROM (\n{portable(normalise(sql))}\n) AS q")._jdf.queryExecution().analyzed())
    walk.link()
    joins = set()
    for i, j in walk.equal:
        a, b = walk.source(i), walk.source(j)
        if a and b and (a != b or i != j):
            joins.add(tuple(sorted((a, b))))
    return Statement(sorted(walk.tables), sorted({x for i in walk.used if (x := walk.source(i))}), sorted(joins))


def joins_of(spark: SparkSession, statements: Mapping[str, str]) -> DataFrame:
    """JOINS rows of statements by name."""
    rows = [(name, *a, *b) for name, sql in statements.items() for a, b in statement(spark, sql).joins]
    return spark.createDataFrame(rows, JOINS)


def supported(joins: DataFrame, edges: DataFrame, schema: str = "public") -> DataFrame:
    """joins with relationship_id and cardinality of the edge (src, dst, source_columns, target_columns) on the same two columns, in either direction; null where no edge says so."""
    one = edges.where(F.size("source_columns") == 1).select("src", "dst", F.element_at("source_columns", 1).alias("a"), F.element_at("target_columns", 1).alias("b"), "relationship_id", "cardinality")
    both = one.unionByName(one.select(F.col("dst").alias("src"), F.col("src").alias("dst"), F.col("b").alias("a"), F.col("a").alias("b"), "relationship_id", "cardinality"))
    best = both.groupBy("src", "dst", "a", "b").agg(F.min(F.struct("relationship_id", "cardinality")).alias("e"))
    full = lambda c: F.concat(F.lit(f"{schema}."), c)
    on = (full(F.col("left")) == F.col("src")) & (full(F.col("right")) == F.col("dst")) & (F.col("left_column") == F.col("a")) & (F.col("right_column") == F.col("b"))
    return joins.join(best, on, "left").select(*joins.columns, F.col("e.relationship_id").alias("relationship_id"), F.col("e.cardinality").alias("cardinality"))
