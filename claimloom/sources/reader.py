"""The nine source tables as Parquet folders with a fixed schema."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession

from claimloom import schemas
from claimloom.session import CODEC, together


def read_source(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Every source table under ``folder``; the schema is given, never inferred."""
    return {
        name: spark.read.schema(schemas.struct(name)).parquet(f"{folder.rstrip('/')}/{name}")
        for name in schemas.SOURCE
    }


def write_source(tables: dict[str, DataFrame], folder: str) -> None:
    """Write source tables to a new folder."""

    def write(name: str) -> None:
        schemas.conform(tables[name], name).write.mode("errorifexists").parquet(f"{folder.rstrip('/')}/{name}", compression=CODEC)

    spark = tables["claims"].sparkSession
    together(spark, *[partial(write, name) for name in schemas.SOURCE])
