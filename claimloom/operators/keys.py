"""Surrogate keys: dense, increasing over loads, never the placeholder key, stable once assigned."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def next_key(existing: DataFrame, key: str) -> Column:
    """Largest key handed out so far as a scalar subquery; 0 in an empty table."""
    return existing.agg(F.greatest(F.coalesce(F.max(key), F.lit(0)), F.lit(0)).alias("last_key")).scalar()


def assign_keys(
    df: DataFrame, key: str, natural_key: list[str], start_after: Column | int = 0, buckets: int | None = None
) -> DataFrame:
    """Number rows ``start_after + 1`` onwards.

    Rows go to buckets by the hash of their unique natural key; a row's number is the size of the
    buckets before its own plus its rank inside it. Only values decide, so recomputing a lost
    task gives every row the number it had. No window spans the table: the offset table has one
    row per bucket, which bounds both its single-task prefix sum and its broadcast.
    """
    if buckets is None:
        buckets = 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bucketed = df.withColumn("_bucket", F.pmod(F.xxhash64(*natural_key), F.lit(buckets)).cast("int"))
    by_bucket = Window.orderBy("_bucket")
    offsets = (
        bucketed.groupBy("_bucket")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_bucket", (F.sum("_rows").over(by_bucket) - F.col("_rows")).alias("_before"))
    )
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy(*natural_key))
    start = F.lit(start_after) if isinstance(start_after, int) else start_after
    return (
        bucketed.withColumn("_rank", rank)
        .join(F.broadcast(offsets), "_bucket")
        .withColumn(key, (start + F.col("_before") + F.col("_rank")).cast("bigint"))
        .drop("_bucket", "_rank", "_before")
    )


# Value ranges that a hot group is cut into by one column.
_RANGES = 64


def _part(cuts: str, value: str) -> Column:
    """Where a value lies among ascending cuts: 2 n between two of them, 2 n + 1 on the n-th; nulls come first."""
    below = F.size(F.filter(F.col(cuts), lambda c: c < F.col(value)))
    on = F.array_contains(cuts, F.col(value)).cast("int")
    return F.when(F.col(cuts).isNull(), 0).when(F.col(value).isNull(), -1).otherwise(2 * below + on)


def _cut(df: DataFrame, among: DataFrame, group: list[str], column: str, share: Column, part: str, whole: str | None) -> tuple[DataFrame, DataFrame]:
    """The rows with the column ``part``, and those of ``among`` that are in hot groups, with it.

    ``part`` is where a row lies in its group's value ranges, 0 in a group that is not hot. Hot is a group
    of more than ``share`` of the rows ``among``; given ``whole``, the part column of the cut before,
    only if it holds a single value of that one. A share is one part in as many as there are shuffle
    partitions, so there are at most that many hot groups, with ``_RANGES`` numbers each to broadcast.
    """
    sizes = among.groupBy(*group).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > share)
    hot = sizes.filter(F.pmod(F.col(whole), F.lit(2)) == 1) if whole else sizes
    at = [i / _RANGES for i in range(1, _RANGES)]
    within = among.join(F.broadcast(hot.select(*group)), group, "left_semi")
    cuts = F.broadcast(within.groupBy(*group).agg(F.array_distinct(F.percentile_approx(column, at, 100 * _RANGES)).alias("_cuts")))
    placed = df.join(cuts, group, "left").withColumn(part, _part("_cuts", column)).drop("_cuts")
    return placed, within.join(cuts, group).withColumn(part, _part("_cuts", column)).drop("_cuts")


def number_within(df: DataFrame, key: list[str], coarse: str, order: list[str], output: str) -> DataFrame:
    """``row_number`` of each row within its key, ordered by ``coarse`` and then by ``order``.

    Rows move once, by their key, and are sorted there. Only keys with more than their share of all rows,
    of which there are fewer than shuffle partitions, are numbered by groups instead. Rows without
    a key or a ``coarse`` value have no place and are left out.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = df.agg((F.count(F.lit(1)) / partitions).alias("share")).scalar()
    sizes = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_rows"))
    hot = F.broadcast(sizes.filter(F.col("_rows") > share).select(*[F.col(c).alias(f"_hot{i}") for i, c in enumerate(key)]))
    # null-safe, so that no filter keeps the sizes from being shared with a caller's own count of the keys
    is_hot = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_hot{i}")) for i, c in enumerate(key)])
    placed = df.filter(reduce(Column.__and__, [F.col(c).isNotNull() for c in [*key, coarse]]))
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(coarse, *order)).cast("bigint")
    numbered = placed.join(hot, is_hot, "left_anti").withColumn(output, rank)
    return numbered.unionByName(_number_hot(placed.join(hot, is_hot, "left_semi"), key, coarse, order, output, share))


def _number_hot(df: DataFrame, key: list[str], coarse: str, order: list[str], output: str, share: Column) -> DataFrame:
    """The same for keys of many rows.

    A row's number is the rows of its key in earlier groups plus its rank in its own group. Groups are
    those of ``coarse``; one with more than its share of all rows is cut further by ranges of the first
    order column, and a range of a single value by the second, as far as these are numbers, dates or
    times. So neither a hot key nor a hot group is sorted in one task. The prefix sum of a key sees one
    row per group, of which a date column has few, and few more for each that is cut.
    """
    group, parts, placed, among = [*key, coarse], [], df, df
    for column in order[:2]:
        if not isinstance(df.schema[column].dataType, (T.NumericType, T.DateType, T.TimestampType)):
            break
        whole = parts[-1] if parts else None
        placed, among = _cut(placed, among, [*group, *parts], column, share, f"_part{len(parts)}", whole)
        parts.append(f"_part{len(parts)}")
    group = [*group, *parts]
    counts = placed.groupBy(*group).agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy(*key).orderBy(coarse, *parts)
    before = counts.select(*group, (F.sum("_rows").over(earlier) - F.col("_rows")).alias("_before"))
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    numbered = placed.withColumn("_rank", rank).join(before, group)
    return numbered.withColumn(output, F.col("_before") + F.col("_rank")).drop("_before", "_rank", *parts)


def assign_keys_by_file(written: DataFrame, key: str, start_after: Column | int = 0) -> DataFrame:
    """Number the rows of a table just written, without moving them.

    A row's number is the row count of the files before its own plus its position in its file.
    Written files do not change, so the numbers are stable, and fact-sized tables are numbered
    without a shuffle. ``written`` must be read straight from its folder. Files are told apart by a
    64-bit hash of their path; two files of one hash raise. The offset table has one row of 16 bytes
    per file, some 13 MB for 100 TB in files of 128 MB, so it is broadcast.
    """
    path = F.col("_metadata.file_path")
    located = written.select("*", F.xxhash64(path).alias("_file"), F.col("_metadata.row_index").alias("_at"))
    per_file = (
        written.select(path.alias("_path"))
        .groupBy("_path")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .groupBy(F.xxhash64("_path").alias("_file"))
        .agg(F.min("_path").alias("_path"), F.max("_path").alias("_other"), F.sum("_rows").alias("_rows"))
    )
    in_order = Window.orderBy("_path")
    before = F.sum("_rows").over(in_order) - F.col("_rows")
    told_apart = F.when(F.col("_path") == F.col("_other"), before).otherwise(
        F.raise_error(F.lit("two files share a path hash; rewrite one of them")).cast("bigint")
    )
    offsets = F.broadcast(per_file.select("_file", told_apart.alias("_before")))
    start = F.lit(start_after) if isinstance(start_after, int) else start_after
    return (
        located.join(offsets, "_file")
        .withColumn(key, (start + F.col("_before") + F.col("_at") + 1).cast("bigint"))
        .drop("_file", "_at", "_before")
    )
