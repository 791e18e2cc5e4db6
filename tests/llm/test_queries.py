"""Registered queries with SQL against it, and the pipeline's result."""

from __future__ import annotations

import duckdb
import pytest

import corpus_pipeline
from claimloom.llm import queries

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, name):
    base = duckdb.connect()
    for table in ("documents", "embeddings", "labels", "benchmark"):
        base.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    got = queries.QUERIES[name](spark, FOLDER)
    want = base.execute(queries.ORACLE[name])
    assert got.columns == [c[0] for c in want.description]
    assert sorted(tuple(r) for r in got.collect()) == sorted(want.fetchall())


def test_pipeline(spark):
    pieces = corpus_pipeline.run(spark, FOLDER).collect()
    assert pieces and all(r.sequence_tokens <= 4096 for r in pieces)
    ends = {}
    for r in sorted(pieces, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
