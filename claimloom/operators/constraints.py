"""Table constraints as counts of offending rows: Parquet itself enforces none of them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom import schemas


class ConstraintError(ValueError):
    """Data broke a declared constraint."""


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys held by more than one row. A key with a null part is never a duplicate."""
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in key])
    return df.filter(complete).groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def many_current(df: DataFrame, key: str) -> DataFrame:
    """Natural keys with more than one current version (uniqueness among current rows only)."""
    return duplicate_keys(df.filter("is_current"), [key])


def not_one_current(df: DataFrame, key: str) -> DataFrame:
    """Natural keys that have no current version, or several. One partial aggregate before the shuffle."""
    return df.groupBy(key).agg(F.count_if("is_current").alias("rows")).filter("rows <> 1")


def check_violations(df: DataFrame, predicate: str) -> DataFrame:
    """Rows whose predicate is false. Null is not false, as in a declared CHECK."""
    return df.filter(~F.coalesce(F.expr(predicate), F.lit(True)))


def missing_parents(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Distinct foreign key values without a parent row.

    Values are made distinct before the join, so a key that fills a third of the table
    reaches the join once.
    """
    values = df.select(F.col(column).alias("missing")).filter("missing is not null").distinct()
    parents = parent.select(F.col(parent_column).alias("missing"))
    return values.join(parents, "missing", "left_anti")


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row with the number of nulls in each required column, from one scan."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def constraint_report(tables: dict[str, DataFrame], names: list[str] | None = None) -> DataFrame:
    """One row per declared constraint: table, kind, name and number of violations."""
    parts = []
    for table in names or [t for t in schemas.UNIQUE if t in tables]:
        df = tables[table]

        def part(kind: str, name: str, bad: DataFrame, table: str = table) -> None:
            parts.append(
                bad.agg(F.count(F.lit(1)).alias("violations")).select(
                    F.lit(table).alias("table_name"), F.lit(kind).alias("kind"), F.lit(name).alias("name"),
                    "violations",
                )
            )

        for key in schemas.UNIQUE.get(table, []):
            part("unique", ", ".join(key), duplicate_keys(df, key))
        if table in ("dim_member", "dim_provider"):
            natural = schemas.UNIQUE[table][1][0]
            part("one current", natural, many_current(df, natural))
        for name, predicate in schemas.CHECKS.get(table, {}).items():
            part("check", name, check_violations(df, predicate))
        for column, parent, parent_column in schemas.REFERENCES.get(table, []):
            if parent in tables:
                part("foreign key", column, missing_parents(df, column, tables[parent], parent_column))
        required = [c for c in schemas.columns(table) if c not in schemas.NULLABLE.get(table, set())]
        stacked = ", ".join(f"'{c}', {c}" for c in required)
        parts.append(
            null_counts(df, required)
            .selectExpr(f"stack({len(required)}, {stacked}) as (name, violations)")
            .select(F.lit(table).alias("table_name"), F.lit("not null").alias("kind"), "name", "violations")
        )
    return reduce(DataFrame.unionByName, parts)



def require(violations: DataFrame, message: str) -> None:
    """Raise with the first offending row if there is any."""
    first = violations.first()
    if first is not None:
        raise ConstraintError(f"{message}: {first.asDict()}")
