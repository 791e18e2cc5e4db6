"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints at most r bits apart both lie within r/2 bits of some value between them. So every
distinct fingerprint emits all values within r/2 bits of it, equal values meet, and the fingerprints
that meet are linked. All of them lie within r/2 of one value, hence within r of each other: a star
to one of them links them all, without listing pairs.

The values travel grouped: those of a fingerprint that agree in their leading ``KEY_BITS`` bits go
as one row (value's leading bits, fingerprint, flips left), and the receiving task writes them out.
For 64 bits and radius 4 that is 137 narrow rows for 2,081 values. Where a key has more values than
``VALUES_AT_ONCE``, its rows go by ``MORE_BITS`` further bits of the same values, and so on; of a
whole value only the fingerprints within r/2 of it are left, 2,081 at most.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations, pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.llm.components import components
from claimloom.session import cut_lineage

BITS = 64
KEY_BITS = 16

# Further leading bits that the rows of a key with too many values are told apart by.
MORE_BITS = 8

# Values written out at once in one task; a key with more is told apart by further bits.
VALUES_AT_ONCE = 3_000_000

# Hashes whose bits are counted at once.
HASHES_AT_ONCE = 200_000

_CUTS = "\t\n\v\f\r"
_TO_SPACE = {ord(c): " " for c in _CUTS} | {ord(c): chr(ord(c) + 32) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def fingerprint(text: str | None, shingle: int = 4, seed: int = 42) -> int:
    """The 64-bit SimHash of a text's word shingles; zero for a text without words."""
    words = [w for w in (text or "").translate(_TO_SPACE).split(" ") if w]
    if not words:
        return 0
    data = " ".join(words).encode("utf-8", "surrogatepass")
    space = np.flatnonzero(np.frombuffer(data, dtype=np.uint8) == 32)
    starts = np.concatenate(([0], space + 1))
    ends = np.concatenate((space, [len(data)]))
    if len(words) > shingle:
        starts, ends = starts[: -(shingle - 1)] if shingle > 1 else starts, ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    set_in = np.zeros(BITS, dtype=np.int64)
    pairs = zip(starts.tolist(), ends.tolist(), strict=True)
    hashes = np.fromiter((digest(data[s:e], seed) for s, e in pairs), dtype="<u8", count=len(starts))
    for at in range(0, len(hashes), HASHES_AT_ONCE):
        part = hashes[at : at + HASHES_AT_ONCE].view(np.uint8).reshape(-1, 8)
        set_in += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_in > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 4, seed: int = 42, also: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, fp``: the fingerprint of every whole text as a signed number, and the columns ``also``. Null text: as empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t, shingle, seed) for t in batch.column(1).to_pylist()], dtype=np.uint64)
            columns = [batch.column(0), pa.array(prints.view(np.int64)), *batch.columns[2:]]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "fp", *also])

    chosen = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"), *also)
    kinds = "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[2:])
    return chosen.mapInArrow(run, f"doc_id bigint, fp bigint{kinds}")


def _flips(bits: range, most: int) -> list[tuple[int, int]]:
    """(mask, number of bits) of all ways to flip at most ``most`` of the given bits."""
    return [(sum(1 << b for b in chosen), n) for n in range(most + 1) for chosen in combinations(bits, n)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _meet(keys: np.ndarray, prints: np.ndarray, left: np.ndarray, masks: list[np.ndarray], radius: int, low_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, another one at most ``radius`` bits away) forests of what meets among the given rows."""
    low = np.uint64((1 << low_bits) - 1)
    nodes, index = np.unique(prints, return_inverse=True)
    lows = (keys << np.uint64(low_bits)) | (prints & low)
    values, sources = [], []
    for flips, mask in enumerate(masks):
        which = np.flatnonzero(left == flips)
        values.append((lows[which][:, None] ^ mask[None, :]).ravel())
        sources.append(np.repeat(index[which], len(mask)))
    value, source = np.concatenate(values), np.concatenate(sources)
    ranked = np.sort(value)
    twice = np.unique(ranked[1:][ranked[1:] == ranked[:-1]])
    if not len(twice):
        return nodes[:0], nodes[:0]
    place = np.minimum(np.searchsorted(twice, value), len(twice) - 1)
    hit = np.flatnonzero(twice[place] == value)
    place, source = place[hit], source[hit]
    order = np.argsort(place, kind="stable")
    place, source = place[order], source[order]
    first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    length = np.diff(np.append(first, len(place)))
    # what meets at a value links to the first there; the distance is verified all the same
    centre = np.repeat(source[first], length)
    near = np.bitwise_count(nodes[centre] ^ nodes[source]) <= radius
    a, b = centre[near], source[near]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        np.minimum.at(new, label[a], least)
        np.minimum.at(new, label[b], least)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def _narrowed(rows: DataFrame, had: int, bits: int, half: int) -> DataFrame:
    """``key, fp, left`` rows of ``had`` leading bits as rows of ``bits`` leading bits, with the same values."""
    low, all_flips = BITS - bits, _flips(range(bits - had), half)
    ways = F.array(*[F.struct(F.lit(_signed(m << low)).alias("m"), F.lit(n).cast("tinyint").alias("n")) for m, n in all_flips])
    own = F.shiftrightunsigned(F.shiftleft(F.col("fp").bitwiseXOR(F.col("s.m")), had), had + low)
    spread = rows.select("key", "fp", "left", F.explode(ways).alias("s")).where(F.col("s.n") <= F.col("left"))
    key = F.shiftleft("key", bits - had).bitwiseOR(own)
    return spread.select(key.alias("key"), "fp", (F.col("left") - F.col("s.n")).cast("tinyint").alias("left"))


def _masks(low_bits: int, half: int) -> list[np.ndarray]:
    """The flips of at most 0, 1, ... ``half`` of the low bits."""
    return [np.array([m for m, _ in _flips(range(low_bits), n)], dtype=np.uint64) for n in range(half + 1)]


def _heavy(rows: DataFrame, masks: list[np.ndarray]) -> DataFrame:
    """``key``: those with more than ``VALUES_AT_ONCE`` values, so at most one in as many of all values."""
    values = F.get(F.array(*[F.lit(len(m)).cast("bigint") for m in masks]), F.col("left").cast("int"))
    return cut_lineage(rows.groupBy("key").agg(F.sum(values).alias("n")).where(F.col("n") > VALUES_AT_ONCE).select("key"))


def _met(rows: DataFrame, masks: list[np.ndarray], radius: int, low_bits: int) -> DataFrame:
    """``a, b``: links of what meets among the values of ``key, fp, left`` rows."""
    written_out = np.array([len(m) for m in masks])
    met = rows.repartition("key").sortWithinPartitions("key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, size = [], 0

        def settled(parts: list[tuple]) -> pa.RecordBatch:
            keys, prints, left = (np.concatenate(x) for x in zip(*parts, strict=True))
            a, b = _meet(keys.view(np.uint64), prints.view(np.uint64), left, masks, radius, low_bits)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for batch in batches:
            part = tuple(c.to_numpy(zero_copy_only=False) for c in batch.columns)
            kept.append(part)
            size += int(written_out[part[2]].sum())
            if size >= VALUES_AT_ONCE:
                whole = tuple(np.concatenate(x) for x in zip(*kept, strict=True))
                starts = np.flatnonzero(np.concatenate(([True], whole[0][1:] != whole[0][:-1])))
                sizes = np.add.reduceat(written_out[whole[2]], starts)
                at = (np.cumsum(sizes) - sizes) // VALUES_AT_ONCE
                last = int(starts[-1])  # the last key may go on
                bounds = np.unique(np.concatenate(([0], starts[1:][at[1:] != at[:-1]], [last])))
                for begin, end in pairwise(bounds.tolist()):
                    yield settled([tuple(x[begin:end] for x in whole)])
                kept = [tuple(x[last:] for x in whole)]
                size = int(sizes[-1])
        if kept:
            yield settled(kept)

    return met.mapInArrow(run, "a bigint, b bigint")


def links(distinct: DataFrame, radius: int = 4, fp: str = "fp") -> DataFrame:
    """``a, b``: links of distinct fingerprints whose components are those of all pairs within ``radius`` bits."""
    if radius < 0 or radius % 2:
        raise ValueError("the radius must be even: both sides emit the values within half of it")
    half, bits = radius // 2, KEY_BITS
    whole = distinct.select(F.lit(0).cast("bigint").alias("key"), F.col(fp).alias("fp"), F.lit(half).cast("tinyint").alias("left"))
    rows, found = _narrowed(whole, 0, bits, half), []
    while bits < BITS:
        masks = _masks(BITS - bits, half)
        heavy = _heavy(rows, masks)
        if heavy.isEmpty():
            break
        found.append(_met(rows.join(F.broadcast(heavy), "key", "left_anti"), masks, radius, BITS - bits))
        rows = _narrowed(rows.join(F.broadcast(heavy), "key", "left_semi"), bits, bits + MORE_BITS, half)
        bits += MORE_BITS
    found.append(_met(rows, _masks(BITS - bits, half), radius, BITS - bits))
    return reduce(DataFrame.union, found)


def _rooted(nodes: DataFrame, radius: int) -> DataFrame:
    """``fp, least, root`` of ``fp, least`` rows: the least fingerprint that each one reaches."""
    roots = components(cut_lineage(links(nodes, radius)))
    return nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))


def firsts(docs: DataFrame, text_hash: str, key: str = "doc_id", text: str = "text", shingle: int = 4, radius: int = 4, seed: int = 42) -> DataFrame:
    """``doc_id, text_hash`` of the first document with an id of every component of near-duplicates.

    Texts under one id are told apart by their hash, the column named ``text_hash``.
    """
    printed = cut_lineage(fingerprints(docs.where(F.col(key).isNotNull()), key, text, shingle, seed, (text_hash,)))
    linking = printed.select("fp").union(fingerprints(docs.where(F.col(key).isNull()), key, text, shingle, seed).select("fp"))
    nodes = cut_lineage(linking.distinct().select("fp", F.lit(None).cast("bigint").alias("least")))
    first = F.min(F.struct("doc_id", text_hash)).alias("first")
    chosen = printed.join(cut_lineage(_rooted(nodes, radius)), "fp").groupBy("root").agg(first)
    return chosen.select("first.doc_id", F.col(f"first.{text_hash}").alias(text_hash))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 4, radius: int = 4, seed: int = 42) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every document.

    ``fingerprint``: 16 hex digits. ``component_id``: the smallest id among the documents that a
    document reaches over links of at most ``radius`` bits, itself included. Equal fingerprints are
    linked, so copies meet as one node, and documents without words share fingerprint zero. Null
    text: as empty. A null id takes part but names a component only if all its ids are null.
    Repeated rows appear each. An empty table gives no rows.
    """
    printed = cut_lineage(fingerprints(docs, key, text, shingle, seed))
    nodes = cut_lineage(printed.groupBy("fp").agg(F.min("doc_id").alias("least")))
    rooted = cut_lineage(_rooted(nodes, radius))
    named = rooted.where("root != fp").groupBy("root").agg(F.min("least").alias("others"))
    ids = rooted.join(named, "root", "left").join(
        nodes.select(F.col("fp").alias("root"), F.col("least").alias("root_least")), "root"
    )
    named_prints = cut_lineage(ids.select("fp", F.least("others", "root_least").alias("component_id")))
    return printed.join(named_prints, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
