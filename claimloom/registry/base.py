"""Registration of a query with its result types and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom import schemas, session
from claimloom.plans.load import LOAD, RESET, SUMMARY, publish
from claimloom.registry import mapping, model_sql
from claimloom.sources import TableStore, read_source, write_source

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

# result type -> (Spark type, SQL type); both sides are cast, so the schemas agree
_TYPES = {
    "bigint": ("bigint", "BIGINT"),
    "money": ("decimal(18,2)", "DECIMAL(18,2)"),
    "double": ("double", "DOUBLE"),
    "date": ("date", "DATE"),
    "string": ("string", "VARCHAR"),
    "boolean": ("boolean", "BOOLEAN"),
}


def query(name: str, columns: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query. ``columns`` is ``name type, ...``; ``sql`` may use the shared model."""
    types = [tuple(c.split()) for c in columns.split(",")]

    def register(build: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            df = build(spark, folder)
            return df.select(*[F.col(c).cast(_TYPES[t][0]).alias(c) for c, t in types])

        run.__name__, run.__doc__ = name, build.__doc__
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = run
        if sql is not None:
            casts = ", ".join(f"CAST({c} AS {_TYPES[t][1]}) AS {c}" for c, t in types)
            ORACLE[name] = f"{model_sql.with_model(sql)}\nSELECT {casts} FROM answer"
        return run

    return register


@dataclass(frozen=True)
class Loaded:
    """A warehouse loaded from one folder of general tables."""

    source: dict[str, DataFrame]
    tables: dict[str, DataFrame]
    store: TableStore
    calendar: mapping.Calendar


_LOADED: dict[tuple[str, str], Loaded] = {}


def _load(spark: SparkSession, folder: str) -> Loaded:
    root = f"{session.shared_dir(spark)}/claimloom-{uuid4().hex[:12]}"
    write_source(mapping.source_tables(spark, folder), f"{root}/source")
    source = read_source(spark, f"{root}/source")
    store = TableStore(spark, f"{root}/warehouse")
    calendar = mapping.calendar(spark, folder)
    publish(store, source, [RESET, *LOAD, SUMMARY], calendar.days, checks=schemas.checks_for(mapping.VALUES))
    return Loaded(source, store.read_all(), store, calendar)


def loaded(spark: SparkSession, folder: str) -> Loaded:
    """The warehouse of a folder: loaded once per application into the shared folder, then read.

    Users query a loaded warehouse, and so do the registered queries.
    """
    session.configure(spark)
    key = (spark.sparkContext.applicationId, folder.rstrip("/"))
    if key not in _LOADED:
        _LOADED[key] = _load(spark, key[1])
    return _LOADED[key]
