"""What a load demands of its source, checked on the rows it is about to take in.

CHECK, NOT NULL and length rules of a table are one bitmap per row, so all of them cost one
expression where the rows are read anyway and one aggregate. Keys of several tables, or several keys of
one, are checked by one shuffle of narrow rows. Facts are checked on the unloaded batch alone, which
the load has written before it comes to that; loaded rows are only counted, from file footers.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom import schemas
from claimloom.operators.constraints import ConstraintError, missing_parents, require

# The column that marks the rules a row breaks, a bit for each.
BREACHES = "breaches"

KINDS = ["unique", "not null", "check", "length", "foreign key"]

# Orphan claims and lines are not breaches: they become dead letters.
SOURCE_RULES = [(kind, None) for kind in KINDS if kind != "foreign key"] + [
    ("foreign key", "member_plan_history"), ("foreign key", "provider_network_history"),
]


@dataclass(frozen=True)
class Rule:
    """A predicate that no row of a table may fail; one that is unknown is not failed."""

    kind: str
    name: str
    predicate: str


@dataclass(frozen=True)
class Gate:
    """The rules of a load: pairs of a kind and a table (None: every table), and the declared checks."""

    rules: list[tuple[str, str | None]]
    checks: dict[str, dict[str, str]]

    def wants(self, kind: str, table: str) -> bool:
        return (kind, None) in self.rules or (kind, table) in self.rules

    def row_rules(self, table: str) -> list[Rule]:
        rules = []
        if self.wants("not null", table):
            optional = schemas.NULLABLE.get(table, set())
            rules += [Rule("not null", c, f"{c} is not null") for c in schemas.columns(table) if c not in optional]
        if self.wants("check", table):
            rules += [Rule("check", name, predicate) for name, predicate in self.checks.get(table, {}).items()]
        if self.wants("length", table):
            rules += [Rule("length", c, f"length({c}) <= {n}") for c, n in schemas.LENGTHS.get(table, {}).items()]
        return rules

    def marked(self, df: DataFrame, table: str) -> DataFrame:
        """The rows of a source table with the rules each one breaks; 0 for a clean row."""
        bits = [
            F.when(~F.coalesce(F.expr(rule.predicate), F.lit(True)), F.lit(1 << place)).otherwise(F.lit(0)).cast("bigint")
            for place, rule in enumerate(self.row_rules(table))
        ]
        return df.withColumn(BREACHES, reduce(Column.bitwiseOR, bits, F.lit(0).cast("bigint")))

    def row_breaches(self, marked: DataFrame, table: str) -> DataFrame | None:
        """``table_name, kind, name, violations`` per broken row rule, from one aggregate of the marked rows."""
        rules = self.row_rules(table)
        if not rules:
            return None
        broken = marked.filter(F.col(BREACHES) != 0)
        counts = broken.agg(*[F.count_if(F.col(BREACHES).bitwiseAND(F.lit(1 << i)) != 0).alias(f"r{i}") for i in range(len(rules))])
        found = F.array(*[
            F.struct(F.lit(rule.kind).alias("kind"), F.lit(rule.name).alias("name"), F.col(f"r{i}").alias("violations"))
            for i, rule in enumerate(rules)
        ])
        rows = counts.select(F.explode(found).alias("r")).select(F.lit(table).alias("table_name"), "r.kind", "r.name", "r.violations")
        return rows.filter("violations > 0")

    def key_breaches(self, tables: dict[str, DataFrame]) -> DataFrame | None:
        """Repeated keys of all given tables: every key value is one narrow row, and all share one shuffle.

        A key with a null part is never repeated.
        """
        keys = [(table, key) for table in tables for key in schemas.UNIQUE.get(table, []) if self.wants("unique", table)]
        if not keys:
            return None
        parts = [_key_values(tables[table], key).select(F.lit(at).alias("at"), "*") for at, (table, key) in enumerate(keys)]
        repeated = reduce(DataFrame.unionByName, parts).groupBy(*parts[0].columns).agg(F.count(F.lit(1)).alias("rows"))
        counts = repeated.filter("rows > 1").groupBy("at").agg(F.count(F.lit(1)).alias("violations"))
        names = F.array(*[F.struct(F.lit(table).alias("table_name"), F.lit(", ".join(key)).alias("name")) for table, key in keys])
        return counts.withColumn("key", names[F.col("at")]).select("key.table_name", F.lit("unique").alias("kind"), "key.name", "violations")

    def parent_breaches(self, table: str, source: dict[str, DataFrame]) -> list[DataFrame]:
        """Foreign key values of a table without a parent row, per declared reference."""
        return [
            missing_parents(source[table], column, source[parent], to).agg(F.count(F.lit(1)).alias("violations")).select(
                F.lit(table).alias("table_name"), F.lit("foreign key").alias("kind"), F.lit(column).alias("name"), "violations"
            ).filter("violations > 0")
            for column, parent, to in (schemas.REFERENCES.get(table, []) if self.wants("foreign key", table) else [])
        ]

    def check_whole(self, source: dict[str, DataFrame], names: list[str]) -> None:
        """Raise if one of the named tables breaks a rule: one scan each for the rows, one shuffle for all keys."""
        _raise([
            *[self.row_breaches(self.marked(source[name], name), name) for name in names],
            self.key_breaches({name: source[name] for name in names}),
            *[part for name in names for part in self.parent_breaches(name, source)],
        ])

    def check_parents(self, source: dict[str, DataFrame], table: str) -> None:
        """Raise if a whole table names a parent that is not there, where a rule asks for it."""
        _raise(self.parent_breaches(table, source))

    def check_batch(self, staged: DataFrame, table: str, source: DataFrame, fact: DataFrame) -> None:
        """Raise if the unloaded rows, as written, break a rule, or the source repeats a loaded key.

        A source row is unloaded or has a fact row, which is unique by its key; so there can only be more
        others than fact rows if a key that is loaded comes again. These counts are read from file
        footers.
        """
        _raise([self.row_breaches(staged, table), self.key_breaches({table: staged})])
        if self.wants("unique", table) and source.count() - staged.count() > fact.count():
            raise ConstraintError(f"the source breaks a constraint: {table} repeats a loaded key")


def _key_values(df: DataFrame, key: list[str]) -> DataFrame:
    """The complete keys of a table in columns that keys of any table fit: two whole numbers, and texts of the rest."""
    complete = reduce(Column.__and__, [F.col(c).isNotNull() for c in key])
    numbers = [c for c in key if isinstance(df.schema[c].dataType, T.IntegralType)][:2]
    texts = [F.col(c).cast("string") for c in key if c not in numbers]
    return df.filter(complete).select(
        *[(F.col(numbers[i]) if i < len(numbers) else F.lit(None)).cast("bigint").alias(f"number{i}") for i in range(2)],
        (F.array(*texts) if texts else F.lit(None)).cast("array<string>").alias("texts"),
    )


def _raise(parts: list[DataFrame | None]) -> None:
    found = [part for part in parts if part is not None]
    if found:
        require(reduce(DataFrame.unionByName, found), "the source breaks a constraint")
