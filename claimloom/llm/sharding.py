"""Shards of near-equal size by balanced label propagation.

Documents that share a group are linked; a shard is a label. In each round every group counts its
documents by shard and its members want to join the shard that most of them are in. A shard takes
newcomers up to its quota of bytes, so each target admits a fraction of what asks for it, chosen by
hash. A group too large for the fraction to mean anything gets a plan of its own: its members fill
the shards it is strongest in, up to their quotas. Unlinked documents have no neighbours; they fill
what the linked ones leave, which makes the sizes near equal.

Only sums by shard, and groups and documents of at least a fixed fraction of a quota, of which
there can be only so many, come to the driver.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.llm.common import sums_before
from claimloom.session import cut_lineage

ROUNDS = 3

# A group or document of at least quota / PARTS is large; there are at most shards * PARTS of them.
PARTS = 256

# Part of a shard's room that a split group is planned into; its members come by hash, so not to the byte.
SPLIT_ROOM = 0.95

# Ranges that the order of a prefix sum is cut into.
RANGES = 4096


def _unit(*columns: str | Column) -> Column:
    """A hash of the columns as a number from 0 up to, not including, 1."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 11).cast("double") / F.lit(float(1 << 53))


def _choose(cuts: list[float], at: Column) -> Column:
    """How many of the ascending cuts are at most ``at``."""
    return F.size(F.filter(F.array(*[F.lit(float(c)) for c in cuts]), lambda c: c <= at)) if cuts else F.lit(0)


def _fill(level_of: list[float], total: float) -> list[float]:
    """What each bin takes of ``total`` so that the lower ones rise to one level."""
    order = sorted(level_of)
    level, left = 0.0, total
    for n, low in enumerate(order, 1):
        top = order[n] if n < len(order) else float("inf")
        if (top - low) * n >= left:
            level = low + left / n
            break
        left -= (top - low) * n
    return [max(0.0, level - low) for low in level_of]


def _loads(state: DataFrame, shards: int) -> list[float]:
    loads = [0.0] * shards
    for row in state.groupBy("shard").agg(F.sum("size").alias("size")).collect():  # one row per shard
        loads[row.shard] = float(row["size"])
    return loads


def _round(state: DataFrame, shards: int, quota: float, turn: int) -> DataFrame:
    """One round of moves of linked documents (``id, grp, size, shard, ...``)."""
    spark = state.sparkSession
    loads = _loads(state, shards)
    by_shard = cut_lineage(state.groupBy("grp", "shard").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size")))
    wish = by_shard.groupBy("grp").agg(
        F.max_by("shard", F.struct("n", (-F.col("shard")).alias("s"))).alias("wish"), F.count(F.lit(1)).alias("spread"),
        F.sum("size").alias("all"),
    ).where("spread > 1")
    wish = cut_lineage(wish)  # settled groups have no link between shards left
    large = wish.where(F.col("all") >= quota / PARTS)
    # at most shards * PARTS groups are large, each with at most one row per shard
    spread = large.select("grp", "all").join(by_shard, "grp").select("grp", "all", "shard", "n", "size").collect()
    room = [max(0.0, quota - load) for load in loads]
    for row in spread:
        room[row.shard] += row["size"]  # these move as planned, so they do not stay
    groups: dict[int, list] = {}
    for row in spread:
        groups.setdefault(row.grp, []).append(row)
    plan = []
    for grp in sorted(groups, key=lambda g: (-groups[g][0]["all"], g)):
        rows = groups[grp]
        total, left, edge = float(rows[0]["all"]), float(rows[0]["all"]), 0.0
        strength = {r.shard: r.n for r in rows}
        whole = [s for s in range(shards) if room[s] >= total]
        # whole to the strongest shard with room for it, else to the fewest shards
        best = sorted(whole or range(shards), key=lambda s: (0 if whole else -room[s], -strength.get(s, 0), s))
        for s in best:
            if left <= 0:
                break
            take = min(left, room[s] if whole else SPLIT_ROOM * room[s])
            if take > 0:
                plan.append((grp, edge / total, (edge + take) / total, s))
                room[s] -= take
                edge, left = edge + take, left - take
        if left > 0:  # no room anywhere: the rest goes to the strongest shard and is released later
            plan.append((grp, edge / total, 1.01, best[0]))
    planned = spark.createDataFrame(plan, "grp bigint, low double, high double, target int")
    small = wish.where(F.col("all") < quota / PARTS).select("grp", "wish")
    moving = state.join(small, "grp", "left")
    asked = [0.0] * shards
    for row in moving.where("wish != shard").groupBy("wish").agg(F.sum("size").alias("size")).collect():  # one row per shard
        asked[row.wish] = float(row["size"])
    part = F.element_at(F.array(*[F.lit(min(1.0, room[s] / asked[s]) if asked[s] else 0.0) for s in range(shards)]), F.col("wish") + 1)
    moved = moving.withColumn("shard", F.when(
        F.col("wish").isNotNull() & (_unit("grp", F.lit(turn)) < part), F.col("wish")).otherwise(F.col("shard"))).drop("wish")
    at = _unit("grp", "id", "check")
    with_plan = moved.withColumn("_at", at).join(
        F.broadcast(planned.groupBy("grp").agg(F.sort_array(F.collect_list(F.struct("low", "high", "target"))).alias("plan"))), "grp", "left"
    )
    target = F.element_at(F.filter("plan", lambda p: F.col("_at") < p["high"]), 1)["target"]
    return with_plan.withColumn("shard", F.coalesce(target, F.col("shard"))).drop("plan", "_at")


def propagate(linked: DataFrame, shards: int, quota: float, rounds: int = ROUNDS) -> DataFrame:
    """Linked documents with their shard after some rounds, from a shard by hash of the id.

    What lies beyond a shard's quota in the end is given no shard (null).
    """
    state = cut_lineage(linked.withColumn("shard", F.pmod(F.xxhash64("id", "check"), F.lit(shards)).cast("int")))
    for turn in range(rounds):
        state = cut_lineage(_round(state, shards, quota, turn))
    over = [s for s, load in enumerate(_loads(state, shards)) if load > quota]
    if not over:
        return state
    full = state.where(F.col("shard").isin(over))
    ordered = full.withColumn("_range", F.pmod(F.xxhash64("grp"), F.lit(RANGES)))
    summed = sums_before(ordered, ["shard"], "_range", [F.xxhash64("grp"), F.col("grp"), F.col("id"), F.col("check")], "size", "_before")
    released = summed.withColumn("shard", F.when(F.col("_before") + F.col("size") <= quota, F.col("shard"))).drop("_range", "_before")
    return state.where(~F.col("shard").isin(over)).unionByName(released)


def shard_documents(
    docs: DataFrame, shards: int = 40, key: str = "doc_id", text: str = "text", overhead: int = 16, rounds: int = ROUNDS
) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot``: every document in one of the shards, 0 upwards.

    Documents of equal texts are linked. Size: UTF-8 bytes plus ``overhead``. Shards end near equal in bytes:
    linked documents go by label propagation; of the others, those of at least quota / 256, which
    are few, go largest first to the lightest shard, and the rest fill every shard to one level.
    ``slot`` numbers a shard's rows without gaps from 0. Null and empty texts are one group each with their
    equals; null ids and repeated rows are placed like others. An empty table gives no rows.
    """
    if shards < 1:
        raise ValueError("there must be a shard")
    body = F.col(text).cast("string").cast("binary")
    rows = cut_lineage(docs.select(
        F.col(key).cast("bigint").alias("id"), (F.coalesce(F.octet_length(body), F.lit(0)) + overhead).cast("bigint").alias("size"),
        F.crc32(F.coalesce(body, F.lit("").cast("binary"))).cast("bigint").alias("check"),
        F.xxhash64(body, F.octet_length(body), F.crc32(body)).alias("grp"),
    ))
    total = rows.agg(F.sum("size").alias("size")).first()["size"]
    if not total:
        return rows.select(F.col("id").alias("doc_id"), "size", F.col("check").alias("text_crc32"), F.lit(0).alias("shard"), F.lit(0).cast("bigint").alias("slot"))
    quota = total / shards
    counts = cut_lineage(rows.groupBy("grp").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("grp"))
    linked = rows.join(counts, "grp", "left_semi")
    placed = cut_lineage(propagate(linked, shards, quota, rounds))
    kept = placed.where("shard is not null")
    loads = _loads(kept, shards)
    free = cut_lineage(
        rows.join(counts, "grp", "left_anti").select("id", "size", "check", "grp")
        .unionByName(placed.where("shard is null").select("id", "size", "check", "grp"))
    )
    spark = docs.sparkSession
    # largest first to the lightest shard: at most shards * PARTS distinct rows by their size
    heavy = free.where(F.col("size") >= quota / PARTS)
    sizes = heavy.groupBy("size", "grp", "id", "check").agg(F.count(F.lit(1)).alias("n")).collect()
    lightest = [(load, s) for s, load in enumerate(loads)]
    heapq.heapify(lightest)
    given: dict[tuple, list[int]] = {}
    for row in sorted(sizes, key=lambda r: (-r["size"], r.grp, r.id is not None, r.id or 0, r.check)):
        for _ in range(row.n):
            load, s = heapq.heappop(lightest)
            given.setdefault((row.id, row["size"], row.check, row.grp), []).append(s)
            heapq.heappush(lightest, (load + row["size"], s))
    chosen = spark.createDataFrame(
        [(*row, s) for row, several in given.items() for s in several], "id bigint, size bigint, check bigint, grp bigint, shard int"
    )
    for load, s in lightest:
        loads[s] = load
    light = free.where(F.col("size") < quota / PARTS).withColumn("_at", F.xxhash64("grp", "id")).withColumn("_range", F.pmod("_at", F.lit(RANGES)))
    summed = sums_before(light, [], "_range", [F.col("_at"), F.col("id"), F.col("check")], "size", "_before")
    rest = total - sum(loads)
    cuts, edge = [], 0.0
    for part in _fill(loads, float(rest))[:-1]:
        edge += part
        cuts.append(edge)
    filled = summed.withColumn("shard", _choose(cuts, F.col("_before") + F.col("size") / 2).cast("int"))
    columns = ["id", "size", "check", "grp", "shard"]
    everything = cut_lineage(
        kept.select(*columns).unionByName(chosen.select(*columns)).unionByName(filled.select(*columns))
    )
    ranged = everything.withColumn("_range", F.pmod(F.xxhash64("id", "check"), F.lit(RANGES))).withColumn("_one", F.lit(1).cast("bigint"))
    numbered = sums_before(ranged, ["shard"], "_range", [F.col("id"), F.col("check"), F.col("size")], "_one", "slot")
    return numbered.select(F.col("id").alias("doc_id"), "size", F.col("check").alias("text_crc32"), "shard", "slot")
