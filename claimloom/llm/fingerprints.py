"""Document fingerprints by consistent weighted sampling, in DataFrame expressions alone.

A document is the multiset of its lower-case words. For each of the samples every word draws
r, c ~ Gamma(2, 1) and b ~ Uniform(0, 1) from hashes of itself, and its count w gives
t = floor(ln w / r + b) and ln a = ln c - r (t - b + 1). The word with the least a is the sample,
written as a hash of (word, t). Two documents agree in a sample with a probability equal to their
generalised Jaccard similarity, sum of min over sum of max of the counts.

A Gamma(2, 1) draw is -ln(u v) for two uniform numbers. The least ln a is found as a minimum over
whole numbers whose high half is ln a in fixed point and whose low half is the hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.llm.common import partitions
from claimloom.session import cut_lineage

SAMPLES = 32

# Hex digits of one sample in a fingerprint.
DIGITS = 8

_SPACES = r"[\x20\x09-\x0D]+"
_LOW = (1 << 32) - 1
_FIXED = float(1 << 23)  # ln a lies between -128 and 128
_OFFSET = 128.0


def _uniform(bits: Column) -> Column:
    """A number inside (0, 1) from the low 32 bits."""
    return (bits.bitwiseAND(F.lit(_LOW)).cast("double") + 0.5) / float(1 << 32)


def _sample(word: Column, log_weight: Column, sample: int) -> Column:
    """ln a in fixed point above the hash of (word, t), or null for a null weight."""
    first = F.xxhash64(word, F.lit(sample))
    second = F.xxhash64(first)
    r = -F.log(_uniform(first) * _uniform(F.shiftrightunsigned(first, 32)))
    log_c = F.log(-F.log(_uniform(second) * _uniform(F.shiftrightunsigned(second, 32))))
    b = _uniform(F.xxhash64(second))
    t = F.floor(log_weight / r + b)
    log_a = log_c - r * (t.cast("double") - b + 1.0)
    high = F.floor((log_a + _OFFSET) * _FIXED)
    return F.shiftleft(high, 32).bitwiseOR(F.xxhash64(word, t).bitwiseAND(F.lit(_LOW)))


def signatures(words: DataFrame, groups: list[str], weights: dict[str, str], word: str = "word", samples: int = SAMPLES) -> DataFrame:
    """Per group one fingerprint for each weight column: ``{output: weight}``; rows are distinct words.

    A weight of 0 or null is no occurrence. A group whose weights are all 0 gets a null fingerprint.
    """
    logs = words.select(*groups, word, *[
        F.when(F.col(w) > 0, F.log(F.col(w).cast("double"))).alias(f"_log_{out}") for out, w in weights.items()
    ])
    least = logs.groupBy(*groups).agg(*[
        F.min(_sample(F.col(word), F.col(f"_log_{out}"), j)).alias(f"_{out}_{j}") for j in range(samples) for out in weights
    ])

    def digits(name: str) -> Column:
        return F.substring(F.hex(F.col(name).bitwiseAND(F.lit(_LOW)) + F.lit(_LOW + 1)), 2, DIGITS)

    return least.select(*groups, *[F.lower(F.concat(*[digits(f"_{out}_{j}") for j in range(samples)])).alias(out) for out in weights])


def likeness(a: Column, b: Column, samples: int = SAMPLES) -> Column:
    """Part of the samples in which two fingerprints agree."""
    same = F.filter(
        F.sequence(F.lit(0), F.lit(samples - 1)),
        lambda i: F.substring(a, i * DIGITS + 1, F.lit(DIGITS)) == F.substring(b, i * DIGITS + 1, F.lit(DIGITS)),
    )
    return F.size(same).cast("double") / samples


# Parts that a range of one id, or of none, may be cut into.
_PARTS = 1 << 20


def _ranges(docs: DataFrame, many: int) -> Column:
    """The number of the id's range, ascending, by approximate quantiles; -1 without an id.

    The cuts are as many as ranges; they are searched in two steps.
    """
    at = [float(i) / many for i in range(1, many)]
    found = docs.agg(F.percentile_approx("id", at, 20 * many).alias("cuts")).first().cuts or []
    cuts = sorted(set(found))
    width = max(1, int(len(cuts) ** 0.5))
    chunks = [cuts[i : i + width] for i in range(0, len(cuts), width)]
    if not chunks:
        return F.when(F.col("id").isNull(), F.lit(-1)).otherwise(F.lit(0))
    at_most = lambda array: F.coalesce(F.size(F.filter(array, lambda c: c <= F.col("id"))), F.lit(0))
    heads = F.array(*[F.lit(c[0]).cast("bigint") for c in chunks])
    inner = F.array(*[F.array(*[F.lit(x).cast("bigint") for x in c]) for c in chunks])
    chunk = at_most(heads)
    place = F.when(chunk == 0, F.lit(0)).otherwise((chunk - 1) * width + at_most(F.element_at(inner, F.greatest(chunk, F.lit(1)))))
    return F.when(F.col("id").isNull(), F.lit(-1)).otherwise(place)


def _ordered_ranges(named: DataFrame, many: int) -> DataFrame:
    """``range, id, text, h``: documents in ranges such that a higher range comes first.

    A range that holds a single id, or the documents without one, and more than its share of rows is cut by
    the text's hash, which decides among equal ids.
    """
    ranged = named.withColumn("at", _ranges(named.select("id"), many).cast("bigint"))
    sizes = ranged.groupBy("at").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("least"), F.max("id").alias("most"))
    sizes = sizes.collect()  # one row per range
    share = max(1, sum(r.n for r in sizes) // many)
    hot = {r["at"]: min(_PARTS, -(-r.n // share)) for r in sizes if r.least == r.most and r.n > 2 * share}
    hashed = ranged.withColumn("h", F.xxhash64("text"))
    part = F.lit(0).cast("bigint")
    if hot:
        parts = F.create_map(*[F.lit(x).cast("bigint") for pair in hot.items() for x in pair])
        # the hash's place among all numbers, ascending, times the number of parts
        unit = (F.shiftright("h", 32) + F.lit(1 << 31)).cast("double") / float(1 << 32)
        part = F.coalesce(F.floor(unit * parts[F.col("at")]), F.lit(0)).cast("bigint")
    return hashed.select((F.col("at") * _PARTS + (_PARTS - 1 - part)).alias("range"), "id", "text", "h")


def _with_next(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``range, place, id, text, next``: documents with the text of the next one by descending id.

    Ranges of the id are ordered on their own; each also gets, as a row after its last, the first
    row of the range that follows, found from one narrow row per range.
    """
    named = docs.select(F.col(key).cast("bigint").alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    ranged = _ordered_ranges(named, 4 * partitions(docs.sparkSession))
    # the first of a range has its greatest id, then the least hash; a range is all with ids or all without
    top = ranged.groupBy("range").agg(F.max(F.struct(F.col("id"), F.bitwise_not("h").alias("not_h"))).alias("top"))
    downwards = Window.orderBy(F.col("range").desc())
    around = downwards.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # the range after whose rows this one's first row comes: the one above, or for the highest the lowest
    above = top.select("top", F.coalesce(F.lag("range").over(downwards), F.last("range").over(around)).alias("after"), F.col("range").alias("own"))
    above = cut_lineage(above.select("after", "own", F.col("top.id").alias("top_id"), F.bitwise_not(F.col("top.not_h")).alias("top_h")))
    guards = (
        ranged.join(above, (ranged["range"] == above["own"]) & ranged["id"].eqNullSafe(above["top_id"]) & (ranged["h"] == above["top_h"]))
        .select(F.col("after").alias("range"), F.col("own"), F.lit(None).cast("bigint").alias("id"), "text", "h")
        .dropDuplicates(["range", "own"]).drop("own").withColumn("guard", F.lit(1))
    )
    everything = ranged.withColumn("guard", F.lit(0)).unionByName(guards)
    order = Window.partitionBy("range").orderBy("guard", F.col("id").desc_nulls_last(), "h")
    placed = everything.select("range", "id", "text", "guard", F.row_number().over(order).alias("place"), F.lead("text").over(order).alias("next"))
    return placed.where("guard = 0").select("range", "place", "id", "text", "next")


def _words(text: Column) -> Column:
    return F.split(F.lower(text), _SPACES)


def fingerprint_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", samples: int = SAMPLES) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.

    The edited text has its last floor(n_chars / 2) code points replaced by the first as many, or all,
    of the next document by descending id, the first one following the last. ``near_*`` is the part
    of the samples in which the text's fingerprint agrees with that of the edited text or of the next
    document. Null text: as empty. Texts without a word share one fingerprint of zeros. Null ids come
    last; equal ids are ordered by their text's hash; a single document is its own next. Repeated
    rows appear each. An empty table gives no rows.
    """
    nothing = F.lit("0" * (DIGITS * samples))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.left("text", n - half), F.left("next", half))
    sha = F.sha2(edited.cast("binary"), 256)
    # what is said of a document goes along with its words as numbers, so that its text is read once
    shares = [F.conv(F.substring(sha, 1 + 16 * i, 16), 16, -10).cast("bigint").alias(f"sha{i}") for i in range(4)]
    facts = ["id", "n_chars", *[f"sha{i}" for i in range(4)]]
    both = _with_next(docs, key, text).select("range", "place", "id", n.cast("bigint").alias("n_chars"), *shares, "text", edited.alias("edited"))
    arrays = both.select("range", "place", *facts, _words(F.col("text")).alias("own"), _words(F.col("edited")).alias("other"))
    listed = arrays.select("range", "place", *facts, F.size("own").alias("n_own"), F.posexplode(F.concat("own", "other")).alias("at", "w"))
    counted = (
        listed.where("w != '' or at = 0")  # a text without words keeps one row
        .groupBy("range", "place", *facts, F.xxhash64("w").alias("word"))
        .agg(
            F.sum(F.when((F.col("w") != "") & (F.col("at") < F.col("n_own")), 1).otherwise(0)).alias("weight"),
            F.sum(F.when(F.col("w") != "", 1).otherwise(0)).alias("all"),
        )
        .withColumn("edited_weight", F.col("all") - F.col("weight"))
    )
    prints = signatures(counted, ["range", "place", *facts], {"fingerprint": "weight", "edited_fingerprint": "edited_weight"}, samples=samples)
    joined = cut_lineage(
        prints.withColumn("fingerprint", F.coalesce("fingerprint", nothing))
        .withColumn("edited_fingerprint", F.coalesce("edited_fingerprint", nothing))
        .withColumn("edited_sha256", F.lower(F.concat(*[F.lpad(F.hex(f"sha{i}"), 16, "0") for i in range(4)])))
    )
    firsts = joined.where("place = 1").select("range", F.col("fingerprint").alias("first"))
    downwards = Window.orderBy(F.col("range").desc())
    around = downwards.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    following = firsts.select("range", F.coalesce(F.lead("first").over(downwards), F.first("first").over(around)).alias("after"))
    within = Window.partitionBy("range").orderBy("place")
    led = joined.withColumn("_next", F.lead("fingerprint").over(within))
    return led.join(following, "range").select(
        F.col("id").alias("doc_id"), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint"), samples).alias("near_edited"),
        likeness(F.col("fingerprint"), F.coalesce("_next", "after"), samples).alias("near_next"),
    )
