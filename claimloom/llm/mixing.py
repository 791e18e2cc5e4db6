"""Mixing sources to target weights: hash-random order, distributed prefix sums, exact budgets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.llm.common import free_names, sums_before

# A source gives at most so many times its own size.
MOST_EPOCHS = 3

# Weights of the sources in order, repeating.
WEIGHTS = (5, 2, 1)

# Leading hex digits of the random key that cut a source into ranges: 4,096 ranges per source.
RANGE_DIGITS = 3


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS, share: float = 1.0) -> DataFrame:
    """``source, source_size, target`` of every source from its ``source, size`` rows.

    Sources in code point order, null last, weigh ``weights`` in turn. They share ``share`` of all
    sizes by weight; a target stops at ``most`` times its source's size and the excess goes to the
    others by weight until none is above. In the order of size per weight the stopped sources come
    first, so one running sum finds them all. The windows see one row per source.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").cast("decimal(38,0)").alias("source_size"))
    listed = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(listed) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (turn + 1).cast("int")).cast("decimal(38,0)")
    weighed = per_source.select("source", "source_size", weight.alias("w")).withColumn("cap", F.col("source_size") * most)
    by_ratio = Window.orderBy((F.col("cap").cast("double") / F.col("w").cast("double")), F.col("source").asc_nulls_last())
    so_far = by_ratio.rowsBetween(Window.unboundedPreceding, 0)
    everything = Window.partitionBy(F.lit(0))
    summed = weighed.select(
        "*", F.sum("source_size").over(everything).cast("double").alias("total"), F.sum("w").over(everything).cast("double").alias("all_w"),
        (F.sum("cap").over(so_far) - F.col("cap")).cast("double").alias("caps_before"),
        (F.sum("w").over(so_far) - F.col("w")).cast("double").alias("w_before"),
    )
    cap, w = F.col("cap").cast("double"), F.col("w").cast("double")
    budget = F.lit(float(share)) * F.col("total")
    stopped = cap * (F.col("all_w") - F.col("w_before")) <= w * (budget - F.col("caps_before"))
    marked = summed.select("*", budget.alias("budget"), stopped.alias("stopped"))
    stopped_only = F.when(F.col("stopped"), F.lit(1.0)).otherwise(F.lit(0.0))
    rest = F.col("budget") - F.sum(stopped_only * cap).over(everything)
    free_w = F.col("all_w") - F.sum(stopped_only * w).over(everything)
    target = F.when(F.col("stopped"), cap).otherwise(w * rest / free_w)
    return marked.select("source", F.col("source_size").cast("bigint").alias("source_size"), target.alias("target"))


def mix(
    docs: DataFrame, size: Column, source: str = "source", key: str = "doc_id", seed: int = 42,
    weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS, share: float = 1.0,
) -> DataFrame:
    """Every document with what the mix takes of it.

    Adds ``size, source_size, target, epochs, part, taken``: the mix takes the document ``epochs``
    times whole and ``part`` of its size once more; ``taken`` is the sum. Each document has a random
    key, the md5 of its id and the seed. In that order within its source, a source gives whole
    epochs and then documents up to its budget, the rounded target; the one that crosses it is taken
    in part. So a source's taken size is its budget to the unit.

    Null sources are one source; null sizes count as 0 and are not taken. Documents with equal ids
    are told apart by their sizes; equal rows are interchangeable. Sources of size 0 give nothing.
    An empty table gives no rows. Columns with the names added here are replaced.
    """
    added = ["size", "source_size", "target", "epochs", "part", "taken"]
    kept = [c for c in docs.columns if c.lower() not in added]
    order = F.md5(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(f":{seed}")).cast("binary"))
    source_of = F.col(source).cast("string")
    # the document's own columns go by number, so that none of them meets a name used here
    sized = docs.select(
        *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)], F.col(key).alias("id"),
        F.coalesce(size, F.lit(0)).cast("bigint").alias("size"), order.alias("_key"), source_of.alias("_source"),
    )
    targets = source_targets(sized.select(F.col("_source").alias("source"), "size"), weights, most, share)
    named = targets.select(
        F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")).alias("_group"), "source_size", "target",
        F.floor(F.col("target") + 0.5).cast("bigint").alias("_budget"),
    )
    grouped = (
        sized.withColumn("_group", F.coalesce(F.concat(F.lit("s"), "_source"), F.lit("n")))
        .drop("_source")
        .withColumn("_range", F.left("_key", F.lit(RANGE_DIGITS)))
    )
    summed = sums_before(grouped, ["_group"], "_range", [F.col("_key"), F.col("id"), F.col("size")], "size", "_before")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("_budget") / F.col("source_size"))).otherwise(F.lit(0)).cast("bigint")
    return (
        summed.join(named, "_group")
        .withColumn("epochs", epochs)
        .withColumn("part", F.greatest(F.lit(0), F.least(
            F.col("size"), F.col("_budget") - F.col("epochs") * F.col("source_size") - F.col("_before"))).cast("bigint"))
        .withColumn("taken", F.col("epochs") * F.col("size") + F.col("part"))
        .select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(kept)], *added)
    )


def mixed_texts(mixed: DataFrame, columns: list[str], text: str = "text", word: str = r"[^\x20\x09-\x0D]+") -> DataFrame:
    """The documents of a mix by words, repeated as often as taken; a part is cut after its last word.

    Cutting keeps the text's own white space up to that word; ``n_chars`` is counted anew.
    """
    gap = r"[\x20\x09-\x0D]*"
    head = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(gap + word), F.lit(0)), F.lit(1), F.col("part").cast("int")), "")
    whole = (F.col("epochs") + F.when((F.col("part") == F.col("size")) & (F.col("size") > 0), 1).otherwise(0)).cast("int")
    whole_copies = mixed.where(whole > 0).withColumn(free_names(mixed, "copy")[0], F.explode(F.sequence(F.lit(1), whole)))
    parts = mixed.where((F.col("part") > 0) & (F.col("part") < F.col("size"))).withColumn(text, head)
    both = whole_copies.select(*columns).unionByName(parts.select(*columns))
    return both.withColumn("n_chars", F.length(text).cast("bigint")) if "n_chars" in columns else both
