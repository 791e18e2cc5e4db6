"""Reading the tables and small helpers that several operators share."""

from __future__ import annotations

import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimloom.session import configure

# Rows and bytes in one Arrow batch; a single row may have more bytes.
BATCH_ROWS = 256
BATCH_BYTES = 16 << 20

# The characters between words: space and the ASCII controls from tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"


_SHIPPED: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Let Spark send this package to the executors, once, unless their Python path names it."""
    context, package = spark.sparkContext, Path(__file__).resolve().parents[1]
    if str(package.parent) in os.environ.get("PYTHONPATH", "").split(os.pathsep) or context.applicationId in _SHIPPED:
        return
    _SHIPPED.add(context.applicationId)
    archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='code-')}/{package.name}", "zip", package.parent, package.name)
    context.addPyFile(archive)


def settle(spark: SparkSession) -> SparkSession:
    """The library's session settings and code, and Arrow batches that whole texts fit in."""
    configure(spark)
    ship_code(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the given folder, read by Spark alone, whatever store the folder lies in."""
    return settle(spark).read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    """The number of partitions that the session's owner has sized shuffles for."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def word_count(text: str | Column) -> Column:
    """Number of words; 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """The wanted names for helper columns, lengthened where the table has them in any case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def doc_bucket(doc_id: str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo a small number; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def sums_before(df: DataFrame, groups: list[str], bucket: str, order: list[Column], value: str, output: str) -> DataFrame:
    """Sum of ``value`` over the earlier rows of a row's group: a distributed prefix sum.

    ``bucket`` cuts a group into ranges of the order, so a hot group is spread over its buckets.
    A row's sum is that of the earlier buckets, of which a group has few, plus that of the earlier
    rows in its own bucket. Group columns must not be null.
    """
    per_bucket = df.groupBy(*groups, bucket).agg(F.sum(value).alias("_all"))
    earlier = Window.partitionBy(*groups).orderBy(bucket)
    offsets = per_bucket.select(*groups, bucket, (F.sum("_all").over(earlier) - F.col("_all")).alias("_offset"))
    inside = Window.partitionBy(*groups, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        df.withColumn("_inside", F.sum(value).over(inside) - F.col(value))
        .join(offsets, [*groups, bucket])
        .withColumn(output, (F.col("_offset") + F.col("_inside")).cast("bigint"))
        .drop("_offset", "_inside")
    )
