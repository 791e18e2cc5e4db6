"""Versioned (Type 2) dimensions: history folding, version checks and point-in-time lookup.

How a history becomes versions. Rows of one key are read in (start, id) order against the open
version. A row opens the next version if it starts later than the open one and differs from it
in a tracked attribute; any other row is absorbed. Several rows may share a start day; then the
first one that differs from the open version wins.

How that runs without collecting a key's rows anywhere:

* Only the first and the first different row of a start day can ever matter. A partial
  aggregate and a top-2 limit, both applied before the shuffle, cut the history to two rows per
  key and day, so even a key with a third of all rows brings at most two rows per calendar day
  to its window.
* Whether a day's second row is the open one after that day is a yes/no state that each day
  either sets to "no", keeps or flips. It is therefore the parity of flips since the last set,
  which running sums give. Nothing is looped over or gathered into arrays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom import schemas
from claimloom.fixed_values import OPEN_END, UNKNOWN_KEY
from claimloom.functions import day_shift, same
from claimloom.operators.constraints import not_one_current, require
from claimloom.operators.dimensions import key_of, seed_unknown
from claimloom.operators.keys import assign_keys, next_key, number_within

MEMBER_TRACKED = ["plan_id", "state", "zip_code"]
PROVIDER_TRACKED = ["network_status", "specialty"]


def history_versions(history: DataFrame, entity: DataFrame, key: str, stable: list[str]) -> DataFrame:
    """History with its entity's stable attributes and a rank per key in (start, id) order."""
    ranked = number_within(history, [key], "effective_start", ["history_id"], "version_rank")
    return ranked.join(entity.select(key, *stable), key)


def member_history(history: DataFrame, members: DataFrame) -> DataFrame:
    stable = ["first_name", "last_name", "date_of_birth", "gender", "enrollment_date"]
    return history_versions(history, members, "member_id", stable)


def provider_history(history: DataFrame, providers: DataFrame) -> DataFrame:
    stable = ["npi", "provider_name", "provider_type", "city", "state"]
    return history_versions(history, providers, "provider_id", stable)


def fold_history(
    history: DataFrame,
    key: str,
    tracked: list[str],
    carried: tuple[str, ...] = (),
    opened: DataFrame | None = None,
    start: str = "effective_start",
    order: str = "history_id",
) -> DataFrame:
    """Versions of a change history: key, tracked and carried columns, start, end, is_current.

    ``opened`` holds the versions open before this run (key, start, tracked, carried). They come
    back with ``is_new`` false, closed if a later row replaced them; history up to their start
    is not applied again.
    """
    attributes = [*tracked, *carried]
    # earliest row of each distinct (key, day, tracked attributes)
    distinct = history.groupBy(key, start, *tracked).agg(
        *[F.min_by(c, order).alias(c) for c in carried], F.min(order).alias("_order")
    )
    in_day = Window.partitionBy(key, start).orderBy("_order")
    leading = distinct.withColumn("_nth", F.row_number().over(in_day)).filter("_nth <= 2")
    days = (
        leading.withColumn("_second", F.lead(F.struct(*attributes)).over(in_day))
        .filter("_nth = 1")
        .select(key, start, F.struct(*attributes).alias("_first"), "_second", F.lit(True).alias("is_new"))
    )
    by_key = Window.partitionBy(key)
    in_order = by_key.orderBy(start)
    if opened is not None:
        origin = opened.select(
            key, start, F.struct(*attributes).alias("_first"),
            F.lit(None).cast(days.schema["_second"].dataType).alias("_second"), F.lit(False).alias("is_new"),
        )
        known_until = F.max(F.when(~F.col("is_new"), F.col(start))).over(by_key)
        days = (
            days.unionByName(origin)
            .withColumn("_until", known_until)
            .filter(F.col("_until").isNull() | ~F.col("is_new") | (F.col(start) > F.col("_until")))
            .drop("_until")
        )

    def equal(left: Column, right: Column) -> Column:
        return same([left[c] for c in tracked], [right[c] for c in tracked])

    # a key's first day opens with its first row, whatever else that day holds
    ranked = days.withColumn("_day", F.row_number().over(in_order)).withColumn(
        "_second", F.when(F.col("_day") > 1, F.col("_second"))
    )
    first, second = F.col("_first"), F.col("_second")
    compared = (
        ranked.withColumn("_prior_first", F.lag("_first").over(in_order))
        .withColumn("_prior_second", F.lag("_second").over(in_order))
        .withColumn("_repeats", (F.col("_day") > 1) & equal(first, F.col("_prior_first")))
        .withColumn(
            "_repeats_second",
            (F.col("_day") > 1) & F.col("_prior_second").isNotNull() & equal(first, F.col("_prior_second")),
        )
    )
    stateful = (
        compared.withColumn("_flip", (second.isNotNull() & F.col("_repeats")).cast("int"))
        .withColumn("_flips", F.sum("_flip").over(in_order))
        .withColumn(
            "_flips_at_set",
            F.max(
                F.when(second.isNull() | (~F.col("_repeats") & ~F.col("_repeats_second")), F.col("_flips"))
            ).over(in_order),
        )
        .withColumn("_took_second", (F.col("_flips") - F.col("_flips_at_set")) % 2 == 1)
        .withColumn("_prior_took_second", F.coalesce(F.lag("_took_second").over(in_order), F.lit(False)))
    )
    unchanged = F.when(F.col("_prior_took_second"), F.col("_repeats_second")).otherwise(F.col("_repeats"))
    versions = stateful.filter((F.col("_day") == 1) | second.isNotNull() | ~unchanged)
    chosen = F.when(F.col("_took_second"), second).otherwise(first)
    next_start = F.lead(start).over(in_order)
    return versions.select(
        key,
        *[chosen[c].alias(c) for c in attributes],
        start,
        F.coalesce(day_shift(next_start, -1), F.lit(OPEN_END).cast("date")).alias("effective_end"),
        next_start.isNull().alias("is_current"),
        "is_new",
    )


def _is_open(table: str) -> Column:
    return F.col("is_current") & (F.col(key_of(table)) != UNKNOWN_KEY)


def scd2_changes(
    dim: DataFrame,
    table: str,
    history: DataFrame,
    entity: DataFrame,
    key: str,
    tracked: list[str],
    carried: tuple[str, ...] = (),
    plans: DataFrame | None = None,
) -> DataFrame:
    """What a history does to the dimension: its new versions, and the open ones as they end up.

    New rows (``is_new``) carry every column but the surrogate key.
    """
    opened = dim.filter(_is_open(table))
    versions = fold_history(history, key, tracked, carried, opened)
    stable = [c for c in schemas.columns(table) if c in entity.columns and c not in {key, *tracked, *carried}]
    changes = versions.join(entity.select(key, *stable), key)
    if plans is not None:
        changes = changes.join(plans.select("plan_id", "plan_key"), "plan_id")
    return changes


def scd2_merge(dim: DataFrame, table: str, key: str, changes: DataFrame, keyed: DataFrame) -> DataFrame:
    """The dimension with replaced versions closed and the new, numbered ones added."""
    closing = changes.filter("not is_new and not is_current").select(key, F.col("effective_end").alias("_closed_on"))
    closes = _is_open(table) & F.col("_closed_on").isNotNull()
    kept = (
        seed_unknown(dim, table)
        .join(closing, key, "left")
        .withColumns({
            "effective_end": F.when(closes, F.col("_closed_on")).otherwise(F.col("effective_end")),
            "is_current": F.col("is_current") & ~closes,
        })
    )
    return schemas.conform(kept, table).unionByName(schemas.conform(keyed, table))


def scd2_apply(
    dim: DataFrame,
    table: str,
    history: DataFrame,
    entity: DataFrame,
    key: str,
    tracked: list[str],
    carried: tuple[str, ...] = (),
    plans: DataFrame | None = None,
) -> DataFrame:
    """The dimension after a history has been applied to it. Applying it again changes nothing."""
    changes = scd2_changes(dim, table, history, entity, key, tracked, carried, plans)
    surrogate = key_of(table)
    keyed = assign_keys(changes.filter("is_new"), surrogate, [key, "effective_start"], next_key(dim, surrogate))
    return scd2_merge(dim, table, key, changes, keyed)


def member_changes(dim: DataFrame, history: DataFrame, members: DataFrame, plans: DataFrame) -> DataFrame:
    return scd2_changes(dim, "dim_member", history, members, "member_id", MEMBER_TRACKED, plans=plans)


def provider_changes(dim: DataFrame, history: DataFrame, providers: DataFrame) -> DataFrame:
    return scd2_changes(
        dim, "dim_provider", history, providers, "provider_id", PROVIDER_TRACKED, ("network_effective_date",)
    )


def load_dim_member(dim: DataFrame, history: DataFrame, members: DataFrame, plans: DataFrame) -> DataFrame:
    return scd2_apply(dim, "dim_member", history, members, "member_id", MEMBER_TRACKED, plans=plans)


def load_dim_provider(dim: DataFrame, history: DataFrame, providers: DataFrame) -> DataFrame:
    return scd2_apply(
        dim, "dim_provider", history, providers, "provider_id", PROVIDER_TRACKED, ("network_effective_date",)
    )


def overlapping_versions(dim: DataFrame, key: str) -> DataFrame:
    """Keys with a version that ends on or after the start of a later one.

    Two versions with one start overlap. For the others it is enough to compare each start with
    the latest end before it. Versions are reduced to one row per key and start day first, which
    bounds what a key brings to its window.
    """
    starts = dim.groupBy(key, "effective_start").agg(
        F.count(F.lit(1)).alias("_versions"), F.max("effective_end").alias("_end")
    )
    earlier = Window.partitionBy(key).orderBy("effective_start").rowsBetween(Window.unboundedPreceding, -1)
    latest_end = F.coalesce(F.max("_end").over(earlier) >= F.col("effective_start"), F.lit(False))
    return starts.withColumn("_meets", latest_end).filter("_versions > 1 or _meets").select(key).distinct()


def check_versions(dim: DataFrame, table: str, key: str) -> None:
    """Raise unless every key has exactly one current version and no two versions overlap."""
    require(not_one_current(dim, key), f"{table} has none or more than one current row for a {key}")
    require(overlapping_versions(dim, key), f"{table} has overlapping versions")


def scd2_lookup(
    facts: DataFrame, dim: DataFrame, table: str, key: str, day: str, take: dict[str, str]
) -> DataFrame:
    """Left join to the version in force on a day. ``take`` maps dimension to output columns.

    The identifier is the join key and the date range a residual test, so the planner hashes or
    sorts on the identifier and splits a hot one at run time. The placeholder row spans all
    dates and is left out.
    """
    versions = dim.filter(F.col(key_of(table)) != UNKNOWN_KEY).select(
        F.col(key).alias("_id"), F.col("effective_start").alias("_from"), F.col("effective_end").alias("_to"),
        *[F.col(c).alias(f"_take_{c}") for c in take],
    )
    covers = (F.col(key) == F.col("_id")) & F.col(day).between(F.col("_from"), F.col("_to"))
    joined = facts.join(versions, covers, "left").drop("_id", "_from", "_to")
    return joined.withColumnsRenamed({f"_take_{c}": name for c, name in take.items()})
