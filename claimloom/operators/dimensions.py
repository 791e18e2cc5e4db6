"""Placeholder rows, the calendar and overwrite-in-place (Type 1) dimensions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom import schemas
from claimloom.fixed_values import CALENDAR_END, CALENDAR_START, UNKNOWN_KEY, UNKNOWN_ROWS
from claimloom.functions import calendar_attributes
from claimloom.operators.keys import assign_keys, next_key
from claimloom.sources.generators import calendar


def key_of(table: str) -> str:
    """The surrogate key is the first column of every warehouse table."""
    return schemas.columns(table)[0]


def unknown_row(spark: SparkSession, table: str) -> DataFrame:
    """The Not Applicable row of a dimension."""
    values = [F.lit(value).alias(column) for column, value in UNKNOWN_ROWS[table].items()]
    return schemas.conform(spark.range(1).select(*values), table)


def seed_unknown(dim: DataFrame, table: str) -> DataFrame:
    """The dimension with its placeholder row, added only if it is missing."""
    placeholder = unknown_row(dim.sparkSession, table).join(dim, key_of(table), "left_anti")
    return dim.unionByName(placeholder.select(*dim.columns))


def load_dim_date(dim: DataFrame, start: str | date = CALENDAR_START, end: str | date = CALENDAR_END) -> DataFrame:
    """The calendar with every missing day of the range added; days present keep their key."""
    seeded = seed_unknown(dim, "dim_date")
    missing = calendar(dim.sparkSession, start, end).join(seeded, "calendar_date", "left_anti")
    days = missing.select(*[value.alias(name) for name, value in calendar_attributes(F.col("calendar_date")).items()])
    keyed = assign_keys(days, "date_key", ["calendar_date"], next_key(dim, "date_key"), buckets=1)
    return seeded.unionByName(schemas.conform(keyed, "dim_date"))


def upsert_type1(dim: DataFrame, source: DataFrame, table: str, natural_key: str) -> DataFrame:
    """Overwrite the attributes of known keys and add new ones.

    A surrogate key, once given, stays; a row that vanished from the source is kept as it is.
    """
    key = key_of(table)
    attributes = [c for c in schemas.columns(table) if c not in (key, natural_key)]
    incoming = source.select(natural_key, F.struct(*attributes).alias("incoming"))
    seeded = seed_unknown(dim, table)
    known = seeded.join(incoming, natural_key, "left").select(
        key,
        natural_key,
        *[
            F.when(F.col("incoming").isNotNull(), F.col(f"incoming.{c}")).otherwise(F.col(c)).alias(c)
            for c in attributes
        ],
    )
    fresh = source.select(natural_key, *attributes).join(seeded, natural_key, "left_anti")
    keyed = assign_keys(fresh, key, [natural_key], next_key(dim, key))
    return schemas.conform(known, table).unionByName(schemas.conform(keyed, table))


def load_dim_plan(dim: DataFrame, source: DataFrame) -> DataFrame:
    return upsert_type1(dim, source, "dim_plan", "plan_id")


def load_dim_diagnosis(dim: DataFrame, source: DataFrame) -> DataFrame:
    return upsert_type1(dim, source, "dim_diagnosis", "diagnosis_code")


def load_dim_procedure(dim: DataFrame, source: DataFrame) -> DataFrame:
    return upsert_type1(dim, source, "dim_procedure", "procedure_code")


def real_rows(dim: DataFrame, table: str) -> DataFrame:
    """The dimension without its placeholder row."""
    return dim.filter(F.col(key_of(table)) != UNKNOWN_KEY)
