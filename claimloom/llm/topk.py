"""Exact top-k inner products by pivot-table elimination.

Every vector's distances to the pivots, a bounded sample of the vectors, are worked out once and
written: the pivot table. By the triangle inequality one distance bounds an inner product; all of a
row together fix the vector's coordinates in the pivots' span and the length of what is left of it,
and q.x is at most the product of the coordinates plus that of the lengths left. This is the
strongest bound that the row allows. A query looks at the candidates in the order of their bounds and
stops for good when the next bound lies below the k-th score found.

Queries go out in blocks of ``QUERY_BLOCK``; each is searched in all rows of the table where they are
read, so rows are not shuffled. A task keeps the best of its rows for each query, and a window per
query merges what the tasks kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.session import cut_lineage

PIVOTS = 48

# Queries sent to the executors at once, and rows of the table whose bounds are in memory at once.
QUERY_BLOCK = 16_384
ROWS_AT_ONCE = 8_192
QUERIES_AT_ONCE = 64

# Candidates whose scores are computed at once, in order of their bounds.
STEP = 256

# Floating error that a bound is raised by, relative to the vectors' lengths.
SLACK = 1e-6

# Products of 64-bit floats are exact while a whole inner product stays below 2^53.
_EXACT = float(1 << 53)


def usable(vector: str) -> Column:
    """True for a vector without null or non-finite components; false for a null one."""
    column = F.col(vector)
    good = F.forall(column, lambda x: F.coalesce(x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    return F.coalesce(good, F.lit(False))


def quantised(vector: str, scale: int = 1024) -> Column:
    """floor(scale * x) of every component, x as a double."""
    return F.transform(F.col(vector), lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("bigint"))


def _matrix(vectors: list, width: int) -> np.ndarray:
    """Rows of one width; a shorter vector's missing components count as 0."""
    out = np.zeros((len(vectors), width), dtype=np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of rows of ``a`` with rows of ``b``."""
    largest = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if largest < _EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return np.array(a.astype(object) @ b.astype(object).T, dtype=object)


def _rows(column: pa.ListArray, width: int) -> np.ndarray:
    """A list column's rows of one width; missing components count as 0."""
    lengths = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False)
    if (lengths == width).all():
        return values.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), dtype=values.dtype)
    out[np.arange(width)[None, :] < lengths[:, None]] = values
    return out


class Span:
    """The span of the pivots, with what turns distances to them into coordinates in it."""

    def __init__(self, pivots: np.ndarray):
        wide = pivots.astype(np.float64)
        base, triangle = np.linalg.qr(wide.T)
        kept = np.abs(np.diag(triangle)) > 1e-9 * max(1.0, np.abs(triangle).max(initial=0))  # a pivot in the others' span adds nothing
        self.pivots = wide[: len(kept)][kept]
        if kept.all() and len(kept) == len(wide):
            triangle = triangle[:, : len(kept)]
        else:
            base, triangle = np.linalg.qr(self.pivots.T)
        self.squares = (self.pivots * self.pivots).sum(axis=1)
        self.turn = np.linalg.inv(triangle) if len(self.pivots) else np.zeros((0, 0))

    def distances(self, vectors: np.ndarray) -> np.ndarray:
        """To every pivot; a row of the pivot table."""
        wide = vectors.astype(np.float64)
        square = (wide * wide).sum(axis=1)
        return np.sqrt(np.maximum(square[:, None] + self.squares[None, :] - 2 * wide @ self.pivots.T, 0))

    def coordinates(self, square: np.ndarray, distances: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of vectors of the given squared lengths: coordinates in the span, and the length of the rest."""
        inner = (square[:, None] + self.squares[None, :] - distances * distances) / 2
        inside = inner @ self.turn
        return inside, np.sqrt(np.maximum(square - (inside * inside).sum(axis=1), 0))


class Search:
    """The best ``k`` rows for every query of a block among all rows that were added."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, span: Span, k: int):
        self.ids, self.vectors, self.span, self.k = ids, vectors, span, k
        wide = vectors.astype(np.float64)
        self.lengths = np.sqrt((wide * wide).sum(axis=1))
        self.inside, self.rest = span.coordinates(self.lengths**2, span.distances(vectors))
        self.best = [(np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)) for _ in ids]
        self.evaluated = 0

    def add(self, ids: np.ndarray, vectors: np.ndarray, distances: np.ndarray) -> None:
        wide = vectors.astype(np.float64)
        square = (wide * wide).sum(axis=1)
        inside, rest = self.span.coordinates(square, distances)
        longest = float(np.sqrt(square.max(initial=0)))
        for begin in range(0, len(self.ids), QUERIES_AT_ONCE):
            part = slice(begin, begin + QUERIES_AT_ONCE)
            bounds = self.inside[part] @ inside.T + self.rest[part, None] * rest[None, :]
            bounds += SLACK * (self.lengths[part, None] * longest + 1)
            for at, bound in enumerate(bounds, begin):
                self._look(at, ids, vectors, bound)

    def _look(self, query: int, ids: np.ndarray, vectors: np.ndarray, bound: np.ndarray) -> None:
        best_ids, best_scores = self.best[query]
        chosen = np.flatnonzero(bound >= float(best_scores[-1])) if len(best_ids) == self.k else np.arange(len(ids))
        chosen = chosen[ids[chosen] != self.ids[query]]
        order = chosen[np.argsort(-bound[chosen], kind="stable")]
        for at in range(0, len(order), STEP):
            chosen = order[at : at + STEP]
            if len(best_ids) == self.k:
                chosen = chosen[bound[chosen] >= float(best_scores[-1])]
                if not len(chosen):
                    break
            self.evaluated += len(chosen)
            scores = _products(vectors[chosen], self.vectors[query][None, :])[:, 0]
            found_ids, found_scores = np.concatenate([best_ids, ids[chosen]]), np.concatenate([best_scores, scores])
            rank = np.lexsort((found_ids, -found_scores))[: self.k]
            best_ids, best_scores = found_ids[rank], found_scores[rank]
        self.best[query] = best_ids, best_scores


def _searched(block: Broadcast, span: Broadcast, width: int, k: int):
    """A function of Arrow batches of the table: ``query, vec_id, score`` of a task's best rows for each query."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(block.value["id"], block.value["v"], span.value, k)
        kept: list[pa.RecordBatch] = []

        def settled() -> None:
            whole = pa.Table.from_batches(kept).combine_chunks()
            ids, vectors, distances = (whole.column(i).combine_chunks() for i in range(3))
            search.add(ids.to_numpy(), _rows(vectors, width), _rows(distances, len(span.value.pivots)))

        for batch in batches:
            if kept and sum(b.num_rows for b in kept) + batch.num_rows > ROWS_AT_ONCE:
                settled()
                kept = []
            kept.append(batch)
        if kept:
            settled()
        counts = [len(ids) for ids, _ in search.best]
        columns = [np.repeat(np.arange(len(counts)), counts), *(np.concatenate([b[i] for b in search.best]).astype(np.int64) for i in (0, 1))]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query", "vec_id", "score"])

    return run


def _tabled(span: Broadcast, width: int):
    """A function of Arrow batches that adds the distances to the pivots."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            distances = span.value.distances(_rows(batch.column(1), width))
            offsets = np.arange(len(distances) + 1, dtype=np.int32) * distances.shape[1]
            listed = pa.ListArray.from_arrays(pa.array(offsets), pa.array(distances.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), listed, batch.column(2)], names=["id", "v", "distances", "q"])

    return run


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 10, key: str = "vec_id", vector: str = "embedding", scale: int = 1024, pivots: int = PIVOTS
) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` candidates of highest integer inner product.

    Queries are the usable rows for which ``is_query`` holds; candidates all usable rows with
    another id. Ties go to the smaller id. Null, non-finite or partly null vectors and null ids take
    no part. A shorter vector counts as padded with zeros. Repeated ids are candidates each, but
    never for a query of their own id; a query that is repeated in every component is one query. Fewer
    candidates than ``k`` give all of them; empty tables no rows. Products beyond 53 bits are computed in
    whole numbers; a score must fit 64 bits.
    """
    spark = vectors.sparkSession
    named = vectors.where(F.col(key).isNotNull() & usable(vector)).select(
        F.col(key).cast("bigint").alias("id"), quantised(vector, scale).alias("v"), F.coalesce(is_query, F.lit(False)).alias("q")
    )
    width = named.agg(F.max(F.size("v")).alias("width")).first().width or 0
    chosen = named.orderBy(F.xxhash64("id"), "id", "v").limit(pivots).select("v").collect()  # at most ``pivots`` rows
    span = spark.sparkContext.broadcast(Span(_matrix([r.v for r in chosen], width)))
    table = cut_lineage(named.mapInArrow(_tabled(span, width), "id bigint, v array<bigint>, distances array<double>, q boolean"))
    ranked = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    found = []
    queries = table.where("q").select("id", "v").distinct().toLocalIterator()
    while part := list(islice(queries, QUERY_BLOCK)):
        block = spark.sparkContext.broadcast({"id": np.array([r.id for r in part]), "v": _matrix([r.v for r in part], width)})
        numbers = spark.createDataFrame([(i, r.id) for i, r in enumerate(part)], "query bigint, query_id bigint")
        near = table.select("id", "v", "distances").mapInArrow(_searched(block, span, width, k), "query bigint, vec_id bigint, score bigint")
        best = near.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")))
        found.append(cut_lineage(best.where(F.col("rank") <= k).join(numbers, "query").select("query_id", "vec_id", "score")))
        block.unpersist()
    if not found:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    every = reduce(DataFrame.union, found)
    return every.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
