"""The audit ledger: every source row has one outcome, and outcomes add back to the source."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom import fixed_values as fv
from claimloom.functions import same
from claimloom.operators.constraints import ConstraintError
from claimloom.operators.dimensions import real_rows
from claimloom.operators.facts import latest_reject, not_loaded
from claimloom.operators.scd2 import MEMBER_TRACKED, PROVIDER_TRACKED

# a warehouse row without a source row; not an outcome of any source row
WAREHOUSE_ONLY = "warehouse_only"
OUTCOMES = [fv.LOADED, fv.REJECTED, fv.HELD, fv.COLLAPSED, fv.CONFLICT, fv.UNACCOUNTED]


def claim_disposition(claims: DataFrame, fact_claim: DataFrame, letters: DataFrame) -> DataFrame:
    """Outcome and reject reason of every source claim."""
    return _claim_outcomes(claims, fact_claim, letters, "left")


def _claim_outcomes(claims: DataFrame, fact_claim: DataFrame, letters: DataFrame, how: str) -> DataFrame:
    """Outcomes from a ``left`` join, or with fact rows that have no source row from a ``full`` one."""
    in_source = claims.select("claim_id", F.lit(True).alias("_source"))
    on_fact = fact_claim.select("claim_id", F.lit(True).alias("_loaded"))
    rejects = latest_reject(letters, fv.CLAIM_PIPELINE)
    joined = (
        in_source.join(on_fact, "claim_id", how)
        .withColumn("source_key", F.col("claim_id").cast("string"))
        .join(rejects, "source_key", "left")
    )
    loaded, rejected = F.col("_loaded").isNotNull(), F.col("reject_reason").isNotNull()
    outcome = (
        F.when(F.col("_source").isNull(), WAREHOUSE_ONLY)
        .when(loaded & rejected, fv.CONFLICT)
        .when(loaded, fv.LOADED)
        .when(rejected, fv.REJECTED)
        .otherwise(fv.UNACCOUNTED)
    )
    return joined.select("claim_id", "source_key", outcome.alias("disposition"), "reject_reason")


def claim_line_disposition(lines: DataFrame, fact_line: DataFrame, letters: DataFrame) -> DataFrame:
    """Outcome and reject reason of every source line; the line's own reason comes first."""
    return _line_outcomes(lines, fact_line, letters, "left")


def _line_outcomes(lines: DataFrame, fact_line: DataFrame, letters: DataFrame, how: str) -> DataFrame:
    on_fact = fact_line.select("claim_id", "line_number", F.lit(True).alias("_placed"))
    own = latest_reject(letters, fv.LINE_PIPELINE).withColumnRenamed("reject_reason", "_own")
    header = latest_reject(letters, fv.CLAIM_PIPELINE).select(
        F.col("source_key").cast("bigint").alias("claim_id"), F.col("reject_reason").alias("_header")
    )
    joined = (
        lines.select("claim_line_id", "claim_id", "line_number")
        .join(on_fact, ["claim_id", "line_number"], how)
        .withColumn("source_key", F.col("claim_line_id").cast("string"))
        .join(own, "source_key", "left")
        .join(header, "claim_id", "left")
    )
    placed, own_reject, held = (F.col(c).isNotNull() for c in ("_placed", "_own", "_header"))
    outcome = (
        F.when(F.col("claim_line_id").isNull(), WAREHOUSE_ONLY)
        .when(placed & (own_reject | held), fv.CONFLICT)
        .when(placed, fv.LOADED)
        .when(own_reject, fv.REJECTED)
        .when(held, fv.HELD)
        .otherwise(fv.UNACCOUNTED)
    )
    return joined.select(
        "claim_line_id", "claim_id", "line_number", "source_key", outcome.alias("disposition"),
        F.coalesce("_own", "_header").alias("reject_reason"),
    )


def _rejected(letters: DataFrame, pipeline: str, key: str) -> DataFrame:
    """Source keys with a dead letter of a pipeline, each once."""
    return letters.filter(F.col("pipeline_name") == pipeline).select(F.col("source_key").cast("bigint").alias(key)).distinct()


def _flags(parts: dict[str, DataFrame], key: list[str]) -> DataFrame:
    """Per key the number of rows of each part, from a tagged union and one shuffle of narrow rows."""
    tagged = [rows.select(*key, F.lit(name).alias("part")) for name, rows in parts.items()]
    counts = [F.count_if(F.col("part") == name).alias(name) for name in parts]
    return reduce(DataFrame.unionByName, tagged).groupBy(*key).agg(*counts)


def _tallied(flags: DataFrame, outcome: Column) -> DataFrame:
    """One row: source rows, keys of each outcome, and fact keys without a source row.

    Source rows are counted by their own tag and outcomes once a key, so a source that repeats a key, or
    a join that multiplied rows, does not add up.
    """
    known = F.col("source") > 0
    return flags.agg(
        F.coalesce(F.sum("source"), F.lit(0)).alias("source_rows"),
        *[F.count_if(known & (outcome == name)).alias(name) for name in OUTCOMES],
        F.coalesce(F.sum(F.when(~known, F.col("fact"))), F.lit(0)).alias(WAREHOUSE_ONLY),
    )


def _claim_tally(claims: DataFrame, fact_claim: DataFrame, letters: DataFrame) -> DataFrame:
    parts = {"source": claims, "fact": fact_claim, "letter": _rejected(letters, fv.CLAIM_PIPELINE, "claim_id")}
    loaded, rejected = F.col("fact") > 0, F.col("letter") > 0
    outcome = F.when(loaded & rejected, fv.CONFLICT).when(loaded, fv.LOADED).when(rejected, fv.REJECTED).otherwise(fv.UNACCOUNTED)
    return _tallied(_flags(parts, ["claim_id"]), outcome)


def _line_tally(lines: DataFrame, fact_line: DataFrame, letters: DataFrame) -> DataFrame:
    """Letters are few: they find their lines first, so that the lines as a whole move once."""
    key = ["claim_id", "line_number"]
    own = lines.join(_rejected(letters, fv.LINE_PIPELINE, "claim_line_id"), "claim_line_id", "left_semi")
    held = lines.join(_rejected(letters, fv.CLAIM_PIPELINE, "claim_id"), "claim_id", "left_semi")
    loaded, rejected, waits = F.col("fact") > 0, F.col("own") > 0, F.col("held") > 0
    outcome = (
        F.when(loaded & (rejected | waits), fv.CONFLICT).when(loaded, fv.LOADED)
        .when(rejected, fv.REJECTED).when(waits, fv.HELD).otherwise(fv.UNACCOUNTED)
    )
    return _tallied(_flags({"source": lines, "fact": fact_line, "own": own, "held": held}, key), outcome)


def _covering_version(history: DataFrame, dim: DataFrame, key: str, tracked: list[str]) -> DataFrame:
    """Per (key, start day) of the history: the version in force on it, as ``_start`` and ``_attrs``.

    Days are made distinct first, so a key with very many history rows meets its versions once
    per calendar day. Versions of a key do not overlap (checked on load), so one version at
    most covers a day, and one that starts on it is that version.
    """
    days = history.select(key, "effective_start").distinct()
    versions = dim.select(
        F.col(key).alias("_id"), F.col("effective_start").alias("_start"), F.col("effective_end").alias("_end"),
        F.struct(*tracked).alias("_attrs"),
    )
    covers = (F.col(key) == F.col("_id")) & F.col("effective_start").between(F.col("_start"), F.col("_end"))
    return days.join(versions, covers).drop("_id", "_end")


def _history_disposition(history: DataFrame, dim: DataFrame, key: str, tracked: list[str]) -> DataFrame:
    covering = _covering_version(history, dim, key, tracked)
    joined = history.join(covering, [key, "effective_start"], "left")
    unchanged = same([F.col(c) for c in tracked], [F.col("_attrs")[c] for c in tracked])
    outcome = (
        F.when(F.col("_start") == F.col("effective_start"), fv.LOADED)
        .when(F.col("_start").isNotNull() & unchanged, fv.COLLAPSED)
        .otherwise(fv.UNACCOUNTED)
    )
    return joined.select(
        "history_id", key, F.col("history_id").cast("string").alias("source_key"), outcome.alias("disposition")
    )


def member_history_disposition(history: DataFrame, dim_member: DataFrame) -> DataFrame:
    """Loaded if a version starts on the row's day, collapsed if the version in force equals it."""
    return _history_disposition(history, real_rows(dim_member, "dim_member"), "member_id", MEMBER_TRACKED)


def provider_history_disposition(history: DataFrame, dim_provider: DataFrame) -> DataFrame:
    return _history_disposition(history, real_rows(dim_provider, "dim_provider"), "provider_id", PROVIDER_TRACKED)


def _catalog_disposition(source: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Outcome of entity rows: on the dimension or not."""
    known = dim.select(key).distinct().withColumn("_known", F.lit(True))
    outcome = F.when(F.col("_known"), fv.LOADED).otherwise(fv.UNACCOUNTED)
    return source.select(key).join(known, key, "left").select(outcome.alias("disposition"))


def _extra_rows(dim: DataFrame, source: DataFrame, key: list[str], distinct: bool = False) -> DataFrame:
    """Warehouse rows (or distinct keys) without a source row, counted."""
    extra = not_loaded(dim, source, key).select(*key)
    return (extra.distinct() if distinct else extra).agg(F.count(F.lit(1)).alias("warehouse_only"))


def source_balance(source: dict[str, DataFrame], tables: dict[str, DataFrame]) -> DataFrame:
    """Counts per source table: rows, each outcome, and warehouse rows without a source row."""
    member = real_rows(tables["dim_member"], "dim_member")
    provider = real_rows(tables["dim_provider"], "dim_provider")
    letters = tables["etl_dead_letter"]
    entities: list[tuple[str, DataFrame, DataFrame]] = []
    for name, table, key in (
        ("plan_types", "dim_plan", "plan_id"),
        ("diagnosis_codes", "dim_diagnosis", "diagnosis_code"),
        ("procedure_codes", "dim_procedure", "procedure_code"),
    ):
        dim = real_rows(tables[table], table)
        entities.append((name, _catalog_disposition(source[name], dim, key), _extra_rows(dim, source[name], [key])))
    for name, dim, history, disposition in (
        ("members", member, "member_plan_history", member_history_disposition),
        ("providers", provider, "provider_network_history", provider_history_disposition),
    ):
        key = f"{name[:-1]}_id"
        entities.append(
            (name, _catalog_disposition(source[name], dim, key), _extra_rows(dim, source[name], [key], distinct=True))
        )
        entities.append(
            (
                history,
                disposition(source[history], tables[f"dim_{name[:-1]}"]),
                _extra_rows(dim, source[history].select(key, "effective_start").distinct(), [key, "effective_start"]),
            )
        )
    tallies = [
        (name, disposition.agg(
            *[F.count_if(F.col("disposition") == outcome).alias(outcome) for outcome in OUTCOMES],
        ).select(_rows_of(source[name]).alias("source_rows"), "*", extra.scalar().alias(WAREHOUSE_ONLY)))
        for name, disposition, extra in entities
    ]
    # the two large facts meet their source once
    tallies.append(("claims", _claim_tally(source["claims"], tables["fact_claim"], letters)))
    tallies.append(("claim_lines", _line_tally(source["claim_lines"], tables["fact_claim_line"], letters)))
    rows = [
        counts.select(F.lit(order).alias("sort_order"), F.lit(name).alias("entity"), "*")
        for order, (name, counts) in enumerate(tallies, start=1)
    ]
    return reduce(DataFrame.unionByName, rows)


def _rows_of(df: DataFrame) -> Column:
    """The number of a table's own rows, whatever it is joined with."""
    return df.agg(F.count(F.lit(1)).alias("n")).scalar()


def balance_failures(balance: DataFrame) -> DataFrame:
    """Entities whose ledger does not add up."""
    total = reduce(lambda a, b: a + b, [F.col(outcome) for outcome in OUTCOMES])
    return balance.filter(
        (F.col(fv.UNACCOUNTED) != 0)
        | (F.col(fv.CONFLICT) != 0)
        | (F.col("warehouse_only") != 0)
        | (F.col("source_rows") != total)
    )


def assert_balance(balance: DataFrame) -> None:
    """Raise with one line per failing entity. The ledger has one row per source table."""
    bad = balance_failures(balance).sort("sort_order").collect()
    if bad:
        lines = [", ".join(f"{name} {value}" for name, value in row.asDict().items()) for row in bad]
        raise ConstraintError(f"source balance failed ({len(bad)}):\n" + "\n".join(lines))
