"""Hard negatives by exact integer scores from a residue-number-system matrix product.

The components of all vectors are whole numbers. Rows and anchors are taken modulo several small
primes, residues centred on 0, and each prime's matrices are multiplied in float32: a sum of
``INNER`` products of residues below 2^7 in size stays below 2^24, so every step is exact; longer
vectors are summed modulo the prime chunk by chunk. Garner's mixed-radix form of the Chinese
remainder theorem puts the residues together to signed 64-bit scores. There are as many primes as
the largest possible score of the given vectors needs.

Anchors go out in blocks of ``ANCHOR_BLOCK``; each block is scored against all rows where they are
read, so rows are not shuffled. A task keeps of its rows an anchor's best ones only, and a window per
anchor merges what the tasks kept. A first pass finds the positives, a second one the negatives in
the score window of each positive.
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

from claimloom.llm.topk import quantised, usable
from claimloom.session import cut_lineage

# Anchors sent to the executors at once: of 64 dimensions some 16 MB.
ANCHOR_BLOCK = 32_768

# Rows and anchors whose scores are in memory at once.
ROWS_AT_ONCE = 4_096
ANCHORS_AT_ONCE = 256

# Dimensions summed in float32 at once: INNER * 125^2 < 2^24 for the residues of the primes below.
INNER = 1_024


def primes_for(bound: int) -> list[int]:
    """The largest odd primes below 2^8 whose product exceeds twice the bound, so that signs are kept."""
    found, product = [], 1
    for p in range(251, 2, -2):
        if all(p % d for d in range(3, int(p**0.5) + 1, 2)):
            found.append(p)
            product *= p
            if product > 2 * bound:
                return found
    raise ValueError(f"scores of up to {bound} are beyond the primes' product")


def residues(matrix: np.ndarray, prime: int) -> np.ndarray:
    """The whole numbers of a matrix modulo a prime, between -(prime - 1) / 2 and (prime - 1) / 2, as float32."""
    half = prime // 2
    return ((matrix + half) % prime - half).astype(np.float32)


def product_modulo(a: np.ndarray, b: np.ndarray, prime: int) -> np.ndarray:
    """Rows of ``a`` times rows of ``b``, both residues of the prime, modulo it, as numbers from 0."""
    total = np.zeros((len(a), len(b)), dtype=np.int64)
    for at in range(0, a.shape[1], INNER):
        total += (a[:, at : at + INNER] @ b[:, at : at + INNER].T).astype(np.int64)
    return total % prime


def reconstruct(parts: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """The signed numbers of which ``parts`` are the residues, by mixed-radix digits.

    A number above half of the primes' product stands for a negative one; that is seen on the digits,
    so sums may wrap around 64 bits on the way and the result is right if it fits them.
    """
    digits: list[np.ndarray] = []
    for part, p in zip(parts, primes, strict=True):
        digit, weight = part.copy(), 1
        for earlier, q in zip(digits, primes, strict=False):
            digit -= earlier * (weight % p)
            digit %= p
            weight = weight * q
        digits.append(digit * pow(weight, -1, p) % p)
    half, limits = reduce(lambda x, y: x * y, primes, 1) // 2, []
    for p in primes:
        half, limit = divmod(half, p)
        limits.append(limit)
    negative = np.zeros(digits[0].shape, dtype=bool)
    for digit, limit in zip(digits, limits, strict=True):
        negative = (digit > limit) | ((digit == limit) & negative)
    value, weight = np.zeros(digits[0].shape, dtype=np.uint64), 1
    for digit, p in zip(digits, primes, strict=True):
        value += digit.astype(np.uint64) * np.uint64(weight % (1 << 64))
        weight *= p
    value[negative] -= np.uint64(weight % (1 << 64))
    return value.view(np.int64)


class Scorer:
    """Exact inner products of rows with a fixed block of anchors, whose residues are made once."""

    def __init__(self, anchors: np.ndarray, primes: list[int]):
        self.primes = primes
        self.anchors = [residues(anchors, p) for p in primes]

    def scores(self, rows: list[np.ndarray], part: slice) -> np.ndarray:
        """A part of the anchors by rows; ``rows`` are their residues by prime."""
        parts = [product_modulo(a[part], r, p) for a, r, p in zip(self.anchors, rows, self.primes, strict=True)]
        return reconstruct(parts, self.primes)


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """Rows of one width; a shorter vector's missing components count as 0."""
    lengths = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False)
    if (lengths == width).all():
        return values.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), dtype=np.int64)
    out[np.arange(width)[None, :] < lengths[:, None]] = values
    return out


def _first(groups: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of each group's first ``k`` entries by descending score, then ascending id."""
    order = np.lexsort((ids, -scores, groups))
    ranked = groups[order]
    starts = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1]))) if len(ranked) else np.zeros(0, dtype=np.int64)
    number = np.arange(len(ranked)) - np.repeat(starts, np.diff(np.append(starts, len(ranked))))
    return order[number < k]


def _chunks(batches: Iterator[pa.RecordBatch], width: int, primes: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray, list[np.ndarray]]]:
    """Ids, labels and residues of up to ``ROWS_AT_ONCE`` rows at a time."""
    kept: list[pa.RecordBatch] = []

    def settled() -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        whole = pa.Table.from_batches(kept).combine_chunks()
        matrix = _matrix(whole.column(2).combine_chunks(), width)
        return whole.column(0).to_numpy(), whole.column(1).to_numpy(), [residues(matrix, p) for p in primes]

    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            part = batch.slice(at, ROWS_AT_ONCE)
            if sum(b.num_rows for b in kept) + part.num_rows > ROWS_AT_ONCE:
                yield settled()
                kept = []
            kept.append(part)
    if kept:
        yield settled()


class _Best:
    """The first ``k`` (group, score, id) entries of every group among all that were added."""

    def __init__(self, k: int):
        self.k, self.kept = k, tuple(np.zeros(0, dtype=np.int64) for _ in range(3))

    def add(self, groups: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        groups, scores, ids = (np.concatenate(pair) for pair in zip(self.kept, (groups, scores, ids), strict=True))
        chosen = _first(groups, scores, ids, self.k)
        self.kept = groups[chosen], scores[chosen], ids[chosen]


def _same_label(anchors: Broadcast, width: int, primes: list[int], k: int):
    """A function of Arrow batches: the best ``k`` rows with an anchor's label among those of a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, best = anchors.value, _Best(k)
        scorer = Scorer(block["v"], primes)
        for ids, labels, rows in _chunks(batches, width, primes):
            for begin in range(0, len(block["id"]), ANCHORS_AT_ONCE):
                part = slice(begin, begin + ANCHORS_AT_ONCE)
                scores = scorer.scores(rows, part)
                fit = (block["label"][part, None] == labels) & (block["id"][part, None] != ids)
                if len(ids) > k:
                    held = np.where(fit, scores, np.iinfo(np.int64).min)
                    fit &= scores >= np.partition(held, len(ids) - k, axis=1)[:, len(ids) - k, None]
                anchor, row = np.nonzero(fit)
                best.add(begin + anchor, scores[anchor, row], ids[row])
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in best.kept], names=["anchor", "score", "id"])

    return run


def _other_label(anchors: Broadcast, width: int, primes: list[int], k: int):
    """A function of Arrow batches: per positive the best ``k`` rows of other labels in its window."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, best = anchors.value, _Best(k)
        scorer = Scorer(block["v"], primes)
        low, high = block["low"], block["high"]  # a row per anchor, a column per positive; low > high: no such positive
        for ids, labels, rows in _chunks(batches, width, primes):
            for begin in range(0, len(block["id"]), ANCHORS_AT_ONCE):
                part = slice(begin, begin + ANCHORS_AT_ONCE)
                scores = scorer.scores(rows, part)
                fit = (block["label"][part, None] != labels) & (scores >= low[part].min(axis=1)[:, None]) & (scores <= high[part].max(axis=1)[:, None])
                anchor, row = np.nonzero(fit)
                value, anchor = scores[anchor, row], begin + anchor
                for j in range(low.shape[1]):
                    inside = np.flatnonzero((value >= low[anchor, j]) & (value <= high[anchor, j]))
                    best.add(anchor[inside] * low.shape[1] + j, value[inside], ids[row[inside]])
        group, score, found = best.kept
        anchor, j = np.divmod(group, low.shape[1])
        columns = [anchor, block["id"][anchor], j, block["positive"][anchor, j], high[anchor, j], found, score]
        names = ["anchor", "anchor_id", "place", "positive_id", "positive_score", "negative_id", "negative_score"]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=names)

    return run


def _blocks(anchors: DataFrame, width: int) -> Iterator[dict]:
    """Anchors in blocks of a bounded number of rows, streamed partition by partition."""
    rows = anchors.toLocalIterator()
    while part := list(islice(rows, ANCHOR_BLOCK)):
        vectors = np.zeros((len(part), width), dtype=np.int64)
        for at, row in enumerate(part):
            vectors[at, : len(row.v)] = row.v
        yield {"id": np.array([r.id for r in part]), "label": np.array([r.label for r in part]), "v": vectors}


def mine(
    vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, least: tuple[int, int] = (80, 100),
    key: str = "vec_id", vector: str = "embedding", label: str = "label", scale: int = 256,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Components count as floor(scale * x). An anchor is a row for which ``is_anchor`` holds; its
    positives are the first ``positives`` rows of its label with another id, by descending integer inner
    product, then ascending id. Per positive the first ``negatives`` rows of other labels, in the
    same order, whose score lies between the share ``least`` (numerator, denominator) of the
    positive's score and that score; a negative positive score leaves an empty window.

    Rows with a null id, label or vector, or with a null or non-finite component, take no part. A
    shorter vector counts as padded with zeros. Repeated rows are each a candidate and, if anchors,
    each an anchor. Anchors without a positive, and positives without a negative, give no rows; nor
    does an empty table. Other columns are left alone, whatever their names. A score must fit 64 bits.
    """
    spark = vectors.sparkSession
    named = vectors.where(F.col(key).isNotNull() & F.col(label).isNotNull() & usable(vector)).select(
        F.col(key).cast("bigint").alias("id"), F.col(label).cast("bigint").alias("label"), quantised(vector, scale).alias("v"),
        F.coalesce(is_anchor, F.lit(False)).alias("chosen"),
    )
    rows = named.select("id", "label", "v")
    facts = named.agg(F.max(F.size("v")).alias("width"), F.max(F.array_max("v")).alias("most"), F.min(F.array_min("v")).alias("least")).first()
    width = int(facts.width or 0)
    primes = primes_for(max(1, width) * max(abs(facts.most or 0), abs(facts.least or 0)) ** 2)
    by_score = [F.col("score").desc(), F.col("id")]
    ranked = Window.partitionBy("anchor", "place").orderBy(F.col("negative_score").desc(), "negative_id")
    found = []
    for block in _blocks(cut_lineage(named.where("chosen").select("id", "label", "v")), width):
        sent = spark.sparkContext.broadcast(block)
        kept = rows.mapInArrow(_same_label(sent, width, primes, positives), "anchor bigint, score bigint, id bigint")
        first = kept.withColumn("place", F.row_number().over(Window.partitionBy("anchor").orderBy(*by_score))).where(F.col("place") <= positives)
        block["positive"] = np.zeros((len(block["id"]), positives), dtype=np.int64)
        block["high"] = np.zeros_like(block["positive"])
        block["low"] = np.ones_like(block["positive"])
        for r in first.collect():  # at most ``positives`` rows for each anchor of the block
            place = r.anchor, r.place - 1
            block["positive"][place], block["high"][place] = r.id, r.score
            block["low"][place] = -(-least[0] * r.score // least[1])
        windows = spark.sparkContext.broadcast(block)
        schema = "anchor bigint, anchor_id bigint, place bigint, positive_id bigint, positive_score bigint, negative_id bigint, negative_score bigint"
        near = rows.mapInArrow(_other_label(windows, width, primes, negatives), schema)
        found.append(cut_lineage(near.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= negatives)))
        sent.unpersist()
        windows.unpersist()
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    if not found:
        kinds = {"rank": "int"}
        return spark.createDataFrame([], ", ".join(f"{n} {kinds.get(n, 'bigint')}" for n in names))
    return reduce(DataFrame.union, found).select(*names)
