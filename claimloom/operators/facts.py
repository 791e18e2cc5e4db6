"""Fact loads: key resolution, rejects, dead letters and the progress mark."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom import fixed_values as fv
from claimloom import schemas
from claimloom.operators.scd2 import scd2_lookup


def date_role(facts: DataFrame, dim_date: DataFrame, day: str, output: str) -> DataFrame:
    """Left join to the calendar in one role. The calendar has one row per day, whatever the facts."""
    role = dim_date.filter("calendar_date is not null").select(
        F.col("calendar_date").alias("_day"), F.col("date_key").alias(output)
    )
    return facts.join(role, F.col(day) == F.col("_day"), "left").drop("_day")


def code_key(facts: DataFrame, dim: DataFrame, code: str, dim_code: str, dim_key: str, output: str) -> DataFrame:
    """Left join to a code catalog; an unknown code gets the placeholder key and the row stays."""
    codes = dim.filter(F.col(dim_key) != fv.UNKNOWN_KEY).select(
        F.col(dim_code).alias("_code"), F.col(dim_key).alias("_code_key")
    )
    joined = facts.join(codes, F.col(code) == F.col("_code"), "left")
    return joined.withColumn(output, F.coalesce("_code_key", F.lit(fv.UNKNOWN_KEY))).drop("_code", "_code_key")


def beside(batch: DataFrame, known: DataFrame, by: list[str], take: list[str]) -> DataFrame:
    """Left join of what was looked up for (claim, ``by``) to a batch that lies by its claim and stays there.

    ``known`` holds narrow rows, the first of ``take`` null where nothing was found. The first column of ``by`` is
    returned as an aggregate, so that the planner takes these rows to the batch and not the batch to them.
    """
    found = known.filter(F.col(take[0]).isNotNull()).groupBy("claim_id", *by, *take).agg(F.max(by[0]).alias("_by0"))
    renamed = [F.col("claim_id").alias("_claim"), "_by0", *[F.col(c).alias(f"_by{i}") for i, c in enumerate(by) if i]]
    met = [F.col("claim_id") == F.col("_claim"), *[F.col(c) == F.col(f"_by{i}") for i, c in enumerate(by)]]
    joined = batch.join(found.select(*renamed, *take), reduce(Column.__and__, met), "left")
    return joined.drop("_claim", *[f"_by{i}" for i in range(len(by))])


def code_key_beside(
    batch: DataFrame, unloaded: DataFrame, dim: DataFrame, code: str, dim_code: str, dim_key: str, output: str
) -> DataFrame:
    """``code_key`` for a batch that lies by its claim: only pairs of its ``unloaded`` rows meet the catalog."""
    known = code_key(unloaded.select("claim_id", code), dim, code, dim_code, dim_key, output)
    joined = beside(batch, known.filter(F.col(output) != fv.UNKNOWN_KEY), [code], [output])
    return joined.withColumn(output, F.coalesce(output, F.lit(fv.UNKNOWN_KEY)))


def not_loaded(source: DataFrame, fact: DataFrame, key: list[str]) -> DataFrame:
    """Source rows without a fact row. The progress mark is not a filter: late rows must load too."""
    return source.join(fact.select(*key), key, "left_anti")


def resolve_claims(
    claims: DataFrame, lines: DataFrame, dims: dict[str, DataFrame], fact_claim: DataFrame, also: tuple[str, ...] = ()
) -> DataFrame:
    """Every claim not yet on the fact with its dimension keys, or the reason it cannot load.

    Claims move once, by their number; versions and codes are looked up with narrow rows that come back to it.
    Lines are counted for these claims alone; the lines of loaded claims are sorted out before they are
    counted. Columns named by ``also`` are kept as they are.
    """
    unloaded = not_loaded(claims, fact_claim, ["claim_id"])
    own = lines.select("claim_id").join(unloaded.select("claim_id"), "claim_id", "left_semi")
    counts = own.groupBy("claim_id").agg(F.count(F.lit(1)).alias("_lines"))
    batch = unloaded.join(counts, "claim_id", "left")
    for table, key, take in (
        ("dim_member", "member_id", ["member_key", "plan_key"]), ("dim_provider", "provider_id", ["provider_key"]),
    ):
        named = unloaded.select("claim_id", key, "service_date")
        known = scd2_lookup(named, dims[table], table, key, "service_date", {c: c for c in take})
        batch = beside(batch, known, [key, "service_date"], take)
    batch = code_key_beside(
        batch, unloaded, dims["dim_diagnosis"], "primary_diagnosis_code", "diagnosis_code", "diagnosis_key", "diagnosis_key"
    )
    batch = date_role(batch, dims["dim_date"], "service_date", "service_date_key")
    batch = date_role(batch, dims["dim_date"], "processed_date", "processed_date_key")
    return schemas.conform(
        batch.withColumn("line_count", F.coalesce("_lines", F.lit(0))).withColumn("reject_reason", claim_reject()),
        "claim_load_batch", also,
    )


def claim_reject() -> Column:
    """The first failed lookup names the reason; null means the claim can load."""
    return (
        F.when(F.col("member_key").isNull(), fv.NO_MEMBER)
        .when(F.col("provider_key").isNull(), fv.NO_PROVIDER)
        .when(F.col("service_date_key").isNull(), fv.NO_SERVICE_DATE)
        .when(F.col("processed_date_key").isNull(), fv.NO_PROCESSED_DATE)
    )


def split_rejects(batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that can load, and rows with a reason not to."""
    return batch.filter("reject_reason is null"), batch.filter("reject_reason is not null")


def claim_dead_letters(batch: DataFrame, now: datetime) -> DataFrame:
    """Dead letters of a claim batch."""
    _, rejected = split_rejects(batch)
    return dead_letters(rejected, fv.CLAIM_PIPELINE, fv.CLAIM_SOURCE, "claim_id", now)


def dead_letters(
    rejected: DataFrame, pipeline: str, source: str, key: str, now: datetime, reason_length: int | None = None
) -> DataFrame:
    """Letters of rejected rows. Only the line pipeline cuts its reasons, to ``REASON_LENGTH`` characters."""
    reason = F.col("reject_reason") if reason_length is None else F.left("reject_reason", F.lit(reason_length))
    return rejected.select(
        *_if_numbered(rejected, "dead_letter_id"),
        F.lit(pipeline).alias("pipeline_name"),
        F.lit(source).alias("source_table"),
        F.col(key).cast("string").alias("source_key"),
        reason.alias("reject_reason"),
        F.lit(now).alias("rejected_at"),
    )


def _if_numbered(df: DataFrame, key: str) -> list[str]:
    """The surrogate key, once the rows have been given one."""
    return [key] if key in df.columns else []


def retained_dead_letters(prior: DataFrame, batch: DataFrame) -> DataFrame:
    """Dead letters a claim batch leaves alone: other pipelines', and claims it does not hold."""
    retried = batch.select(F.lit(fv.CLAIM_PIPELINE).alias("pipeline_name"), F.col("claim_id").cast("string").alias("source_key"))
    return prior.join(retried, ["pipeline_name", "source_key"], "left_anti").select(*prior.columns)


def latest_reject(letters: DataFrame, pipeline: str) -> DataFrame:
    """Newest dead letter per source key of one pipeline."""
    return (
        letters.filter(F.col("pipeline_name") == pipeline)
        .groupBy("source_key")
        .agg(F.max_by("reject_reason", "dead_letter_id").alias("reject_reason"))
    )


def claim_facts(batch: DataFrame, now: datetime) -> DataFrame:
    """Fact columns of the accepted claims."""
    accepted, _ = split_rejects(batch)
    owed = F.when(F.col("claim_status") == "Denied", F.lit(0)).otherwise(
        F.greatest(F.col("total_allowed") - F.col("total_paid"), F.lit(0))
    )
    return accepted.select(
        *_if_numbered(batch, "claim_key"), "claim_id", "member_key", "provider_key", "plan_key",
        F.col("diagnosis_key").alias("primary_diagnosis_key"), "service_date_key", "processed_date_key",
        "claim_type", "claim_status", "denial_reason", "total_billed", "total_allowed", "total_paid",
        owed.cast(schemas.MONEY).alias("member_responsibility"), "line_count", F.lit(now).alias("loaded_at"),
    )


def resolve_lines(
    lines: DataFrame,
    dims: dict[str, DataFrame],
    fact_claim: DataFrame,
    fact_line: DataFrame,
    letters: DataFrame,
) -> DataFrame:
    """Every line not yet on the fact with its keys, or the reason it cannot be placed.

    Version keys are the header's, so a line reports under the versions its claim does. One
    pass over the lines serves both the fact and the dead letters. Lines are placed by their claim
    once, for the header, its reject, the loaded lines and their codes' keys; the join to headers lies directly
    over that exchange, so a claim with very many lines is split there.
    """
    headers = fact_claim.select("claim_id", "claim_key", "member_key", "provider_key")
    header_rejects = latest_reject(letters, fv.CLAIM_PIPELINE).select(
        F.col("source_key").cast("bigint").alias("claim_id"), F.col("reject_reason").alias("_header_reason")
    )
    batch = lines.join(headers, "claim_id", "left").join(header_rejects, "claim_id", "left")
    batch = not_loaded(batch, fact_line, ["claim_id", "line_number"])
    unloaded = not_loaded(lines, fact_line, ["claim_id", "line_number"])
    batch = code_key_beside(
        batch, unloaded, dims["dim_procedure"], "procedure_code", "procedure_code", "procedure_key", "procedure_key"
    )
    batch = code_key_beside(
        batch, unloaded, dims["dim_diagnosis"], "diagnosis_code", "diagnosis_code", "diagnosis_key", "diagnosis_key"
    )
    batch = date_role(batch, dims["dim_date"], "service_date", "service_date_key")
    return batch.withColumn("reject_reason", line_reject())


def line_reject(placed: Column | None = None) -> Column:
    """Why a line is not on the fact. ``placed`` false marks lines that could have been but are not."""
    missing = F.col("claim_key").isNull()
    reason = (
        F.when(missing & F.col("_header_reason").isNotNull(), F.concat(F.lit(fv.HEADER_REJECTED), "_header_reason"))
        .when(missing, fv.NO_HEADER)
        .when(F.col("service_date_key").isNull(), fv.NO_SERVICE_DATE)
    )
    if placed is not None:
        reason = reason.when(~placed, fv.NOT_PLACED)
    return reason


def line_facts(batch: DataFrame, now: datetime) -> DataFrame:
    """Fact columns of the placed lines."""
    accepted, _ = split_rejects(batch)
    return accepted.select(
        *_if_numbered(batch, "claim_line_key"), "claim_key", "claim_id", "line_number", "member_key", "provider_key", "procedure_key", "diagnosis_key",
        "service_date_key", F.col("procedure_code").alias("source_procedure_code"), "units", "billed_amount",
        "allowed_amount", "paid_amount", F.lit(now).alias("loaded_at"),
    )


def line_dead_letters(
    lines: DataFrame,
    dim_date: DataFrame,
    fact_claim: DataFrame,
    fact_line: DataFrame,
    letters: DataFrame,
    now: datetime,
) -> DataFrame:
    """A dead letter for every line that is not on the fact, whatever state the warehouse is in."""
    dims = {"dim_date": dim_date}
    headers = fact_claim.select("claim_id", "claim_key")
    header_rejects = latest_reject(letters, fv.CLAIM_PIPELINE).select(
        F.col("source_key").cast("bigint").alias("claim_id"), F.col("reject_reason").alias("_header_reason")
    )
    unplaced = not_loaded(lines, fact_line, ["claim_id", "line_number"])
    unplaced = unplaced.join(headers, "claim_id", "left").join(header_rejects, "claim_id", "left")
    explained = date_role(unplaced, dims["dim_date"], "service_date", "service_date_key").withColumn(
        "reject_reason", line_reject(placed=F.lit(False))
    )
    return dead_letters(explained, fv.LINE_PIPELINE, fv.LINE_SOURCE, "claim_line_id", now, fv.REASON_LENGTH)


def replace_line_letters(prior: DataFrame, current: DataFrame) -> DataFrame:
    """All letters of the line pipeline make room for the current ones; the others stay."""
    return prior.filter(F.col("pipeline_name") != fv.LINE_PIPELINE).unionByName(current, allowMissingColumns=True)


def advance_watermark(prior: DataFrame, batch: DataFrame, now: datetime) -> DataFrame:
    """The claim mark after a batch: it never moves back, and an empty batch leaves it alone.

    Rejected claims move it as well; only loaded ones are counted.
    """
    seen = batch.agg(
        F.max("processed_date").alias("high_water_mark"),
        F.count_if(F.col("reject_reason").isNull()).alias("rows_loaded"),
    ).filter("high_water_mark is not null")
    incoming = seen.select(
        F.lit(fv.CLAIM_PIPELINE).alias("pipeline_name"), "high_water_mark", "rows_loaded", F.lit(now).alias("updated_at")
    )
    merged = (
        prior.filter(F.col("pipeline_name") == fv.CLAIM_PIPELINE)
        .unionByName(incoming)
        .groupBy("pipeline_name")
        .agg(
            F.max("high_water_mark").alias("high_water_mark"),
            F.sum("rows_loaded").alias("rows_loaded"),
            F.max("updated_at").alias("updated_at"),
        )
    )
    return prior.filter(F.col("pipeline_name") != fv.CLAIM_PIPELINE).unionByName(merged)


def line_watermark(marks: DataFrame, placed: DataFrame, now: datetime) -> DataFrame:
    """The line mark: lines have no processed date, so it copies the claim mark as it stands."""
    header = marks.filter(F.col("pipeline_name") == fv.CLAIM_PIPELINE)
    before = marks.filter(F.col("pipeline_name") == fv.LINE_PIPELINE)
    loaded = placed.agg(F.count(F.lit(1)).alias("n")).scalar()
    earlier = before.agg(F.coalesce(F.sum("rows_loaded"), F.lit(0)).alias("n")).scalar()
    row = marks.sparkSession.range(1).select(
        F.lit(fv.LINE_PIPELINE).alias("pipeline_name"),
        header.agg(F.max("high_water_mark").alias("m")).scalar().alias("high_water_mark"),
        (earlier + loaded).alias("rows_loaded"),
        F.lit(now).alias("updated_at"),
    )
    return marks.filter(F.col("pipeline_name") != fv.LINE_PIPELINE).unionByName(row)
