"""Row generators. ``spark.range`` keeps them distributed and lets the planner know their exact size."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def series(spark: SparkSession, low: int, high: int, name: str = "n") -> DataFrame:
    """The integers low..high, both included."""
    return spark.range(low, high + 1).withColumnRenamed("id", name)


def calendar(spark: SparkSession, start: str | date, end: str | date) -> DataFrame:
    """One row per day, both ends included."""
    first, last = date.fromisoformat(str(start)), date.fromisoformat(str(end))
    days = spark.range(0, max((last - first).days + 1, 0), 1, 1)
    return days.select(F.date_add(F.lit(first), F.col("id").cast("int")).alias("calendar_date"))


def spanned(extent: DataFrame, low: str, high: str, name: str) -> DataFrame:
    """Every value between two columns of a one-row relation, both included; none if one is null.

    For ranges that only the data know: nothing runs while the plan is built. One task writes the
    range out, so it is for calendars and the like.
    """
    return extent.select(F.explode(F.sequence(low, high)).alias(name))


def values_relation(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A literal relation; the planner sees its size and joins it by broadcast without a hint."""
    return spark.createDataFrame(rows, schema)
