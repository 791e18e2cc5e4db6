"""Token ids in 64-bit words: Simple-8b coding with escapes and an offset for every block.

The top four bits of a word select how many ids it holds and how wide each is; the other sixty hold
them, the first id lowest. An id of more than sixty bits is an escape: its word holds a position in
a list of raw 64-bit ids. Ids are coded in blocks of ``BLOCK`` ids that start on a word of their own,
and the first word of every block is listed, so blocks are decoded independently and all at once.

A file is a Parquet table with one row per segment: a run of whole documents in order, with the
number of ids of the shard before it, the documents' ids and lengths, the coded words, the block
offsets and the escapes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimloom.llm.common import partitions
from claimloom.llm.tokens import encoder

# The format: ids in a word and bits of each, by selector 1 to 15. Selector 0 is the escape.
COUNTS = np.array([1, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
BITS = np.array([60, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
BLOCK = 1024

# Blocks that a reader decodes at once.
GROUP = 256

# Bytes of words and their ids that a worker keeps: more than where other stages share the executor's memory.
KEPT_BYTES = 128 << 20

# Bytes of texts whose words are looked up together; a single batch may have more.
TEXT_BYTES = 12 << 20

# A segment ends with the document that brings it to so many ids.
SEGMENT_IDS = 1 << 16

SCHEMA = (
    "shard int, segment int, shard_ids bigint, doc_ids array<bigint>, lengths array<bigint>, "
    "words binary, block_words binary, escapes binary"
)
NAMES = [column.split()[0] for column in SCHEMA.split(", ")]
KINDS = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary()]


def _widths(ids: np.ndarray) -> np.ndarray:
    """Bits each id needs; exact for all 64-bit ids."""
    if len(ids) and ids.max() < 1 << 32:
        return np.frexp(ids.astype(np.float64))[1]
    high, low = (ids >> np.uint64(32)).astype(np.float64), (ids & np.uint64(0xFFFFFFFF)).astype(np.float64)
    return np.where(high > 0, 32 + np.frexp(high)[1], np.frexp(low)[1])


def encode_ids(ids: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """Words, first word of each block and escapes of ids given as unsigned 64-bit numbers.

    All blocks take their next word together, so the work is in array operations.
    """
    ids = np.ascontiguousarray(ids, dtype=np.uint64)
    n = len(ids)
    if n == 0:
        return b"", b"", b""
    escaped = ids >> np.uint64(60) > 0
    escapes = ids[escaped]
    coded = ids.copy()
    coded[escaped] = np.arange(len(escapes), dtype=np.uint64)
    need = np.where(escaped, 61, _widths(ids))
    # the widest id among the next c, for each c of the format; ids after the block's end fit no word
    blocks = -(-n // BLOCK)
    grid = np.full((blocks, BLOCK + 120), 99, dtype=np.int8)
    whole = np.full(blocks * BLOCK, 99, dtype=np.int8)
    whole[:n] = need
    grid[:, :BLOCK] = whole.reshape(blocks, BLOCK)
    best = np.zeros((blocks, BLOCK), dtype=np.int8)
    widest, span = grid, 1
    fits: dict[int, np.ndarray] = {}
    for count in sorted(set(COUNTS[1:].tolist())):
        while span < count:  # windows of a length made of two overlapping shorter ones
            step = min(span, count - span)
            widest = np.maximum(widest[:, : widest.shape[1] - step], widest[:, step:])
            span += step
        fits[count] = widest[:, :BLOCK]
    for selector in range(15, 0, -1):
        held = fits[int(COUNTS[selector])] <= BITS[selector]
        if held.any():
            np.copyto(best, selector, where=held)
    best = best.reshape(-1)
    taken = COUNTS[best]
    # follow every block's words at once; a word that ends its block leads to n, which leads nowhere else
    follower = np.arange(len(taken) + 1)
    follower[:-1] += taken
    follower[:-1][(follower[:-1] % BLOCK == 0) | (follower[:-1] > n)] = n
    follower[n:] = n
    begins = np.zeros(len(follower), dtype=bool)
    at = np.arange(blocks) * BLOCK
    while at[0] < n or at.min() < n:
        begins[at] = True
        at = follower[at]
    start = np.flatnonzero(begins[:n])
    block_of = start // BLOCK
    selectors = best[start]
    words = selectors.astype(np.uint64) << np.uint64(60)
    for selector in range(16):
        which = np.flatnonzero(selectors == selector)
        width = int(BITS[selector])
        if len(which) and width:
            at, filled = start[which], words[which]
            for k in range(int(COUNTS[selector])):
                filled |= coded[at + k] << np.uint64(width * k)
            words[which] = filled
    first = np.searchsorted(block_of, np.arange(blocks))
    return words.astype("<u8").tobytes(), first.astype("<u4").tobytes(), escapes.astype("<u8").tobytes()


def decode_ids(words: bytes | memoryview, escapes: bytes) -> np.ndarray:
    """The ids of whole blocks; cut ``words`` at block offsets to decode some of them."""
    words = np.frombuffer(words, dtype="<u8").astype(np.uint64)
    raw = np.frombuffer(escapes, dtype="<u8").astype(np.uint64)
    selectors = (words >> np.uint64(60)).astype(np.int64)
    counts = COUNTS[selectors]
    start = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), dtype=np.uint64)
    for selector in range(16):
        which = np.flatnonzero(selectors == selector)
        width = int(BITS[selector])
        if len(which) and width:
            mask = np.uint64((1 << width) - 1)
            for k in range(int(COUNTS[selector])):
                out[start[which] + k] = (words[which] >> np.uint64(width * k)) & mask
    escaped = start[selectors == 0]
    out[escaped] = raw[out[escaped].astype(np.int64)]
    return out


def decode_range(words: bytes, block_words: bytes, escapes: bytes, begin: int, end: int) -> np.ndarray:
    """The ids from ``begin`` to before ``end``: only the blocks that hold them are decoded, found by their offsets."""
    if begin >= end:
        return np.zeros(0, dtype=np.uint64)
    offsets = np.frombuffer(block_words, dtype="<u4")
    first, last = begin // BLOCK, -(-end // BLOCK)
    stop = int(offsets[last]) if last < len(offsets) else len(words) // 8
    ids = decode_ids(memoryview(words)[8 * int(offsets[first]) : 8 * stop], escapes)
    return ids[begin - first * BLOCK : end - first * BLOCK]


def _by_size(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The batches in order, several together until they hold ``TEXT_BYTES``."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= TEXT_BYTES:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def write_token_files(
    docs: DataFrame, folder: str, tokenizer_path: str, end_id: int, key: str = "doc_id", text: str = "text"
) -> None:
    """Write the ids of every text and ``end_id`` after it, in ascending key order, to a new folder.

    Rows are sorted by ranges of the key, equal keys by their text's hash; each range is one shard,
    coded by one task as a stream. Null keys come first. Null text: as empty. Rows that are equal
    are written each. An empty table gives a folder without rows.
    """
    spark = docs.sparkSession
    chosen = docs.select(F.col(key).cast("bigint").alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    order = [F.col("k").asc_nulls_first(), F.xxhash64("t"), F.col("t")]
    ordered = chosen.repartitionByRange(partitions(spark), *order[:2]).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path, KEPT_BYTES).encode_all
        end = int(end_id).to_bytes(4, "little")
        shard, segment, written = TaskContext.get().partitionId(), 0, 0
        keys, parts, total = [], [], 0

        def flush() -> pa.RecordBatch:
            words, offsets, escapes = encode_ids(np.frombuffer(b"".join(parts), dtype="<u4"))
            row = (shard, segment, written, keys, [len(p) // 4 for p in parts], words, offsets, escapes)
            return pa.RecordBatch.from_arrays([pa.array([value], kind) for value, kind in zip(row, KINDS, strict=True)], names=NAMES)

        for found in _by_size(batches):
            for k, ids in zip(found["k"].to_pylist(), encode(found["t"].combine_chunks()), strict=True):
                keys.append(k)
                parts.append(ids + end)
                total += len(ids) // 4 + 1
                if total >= SEGMENT_IDS:
                    yield flush()
                    written += total
                    keys, parts, total, segment = [], [], 0, segment + 1
        if parts:
            yield flush()

    ordered.mapInArrow(run, SCHEMA).write.parquet(folder)


def read_token_files(spark: SparkSession, folder: str, wanted: list[int] | None = None) -> DataFrame:
    """Every document of the files, or those of the ids ``wanted``: ``doc_id, start, n_tokens, ids`` (little-endian unsigned 32-bit).

    ``start`` counts the ids before the document: those of earlier shards, summed over one row per
    shard, and those before it in its own. The words are decoded where they are read, ``GROUP`` blocks at
    a time by their offsets; of wanted documents only the blocks that they lie in, in the segments that
    hold one.
    """
    files = spark.read.schema(SCHEMA).parquet(folder)
    size = F.aggregate("lengths", F.lit(0).cast("bigint"), lambda total, n: total + n)
    shards = files.select("shard", size.alias("n")).groupBy("shard").agg(F.sum("n").alias("n"))
    before = shards.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("before"))
    held = files if wanted is None else files.where(F.arrays_overlap("doc_ids", F.array(*[F.lit(k).cast("bigint") for k in wanted])))
    coded = held.join(before, "shard").select(
        "doc_ids", "lengths", "words", "block_words", "escapes", (F.col("before") + F.col("shard_ids")).alias("start")
    )
    chosen = None if wanted is None else set(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                keys, lengths, words, block_words, escapes, start = (column[row].as_py() for column in batch.columns)
                ends = np.cumsum(np.array(lengths, dtype=np.int64))
                begins = ends - lengths
                if chosen is not None:
                    held = [i for i, k in enumerate(keys) if k in chosen]
                    keys, lengths, begins, ends = [keys[i] for i in held], [lengths[i] for i in held], begins[held], ends[held]
                    texts = [decode_range(words, block_words, escapes, a, b).astype("<u4").tobytes() for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
                else:
                    ids = np.empty(int(ends[-1]) if len(ends) else 0, dtype="<u4")
                    for at in range(0, len(ids), GROUP * BLOCK):
                        ids[at : at + GROUP * BLOCK] = decode_range(words, block_words, escapes, at, min(len(ids), at + GROUP * BLOCK))
                    texts = [ids[a:b].tobytes() for a, b in zip(begins, ends, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64()), pa.array(start + begins), pa.array(lengths, pa.int64()), pa.array(texts, pa.binary())],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )

    return coded.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids binary")
