"""Integrity assertions of a loaded warehouse: one row each, collected and raised together."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom import fixed_values as fv
from claimloom.functions import average_over, same
from claimloom.operators.constraints import ConstraintError, many_current
from claimloom.operators.dimensions import key_of, real_rows
from claimloom.operators.scd2 import overlapping_versions
from claimloom.plans import analytics, summary
from claimloom.plans.analytics import Tables
from claimloom.plans.load import DIMENSIONS


def _verdict(name: str, df: DataFrame, failed: Column, *detail: Column | str) -> DataFrame:
    """Turn a one-row result into (test_name, failed, detail)."""
    parts = [F.lit(d) if isinstance(d, str) else d.cast("string") for d in detail]
    return df.select(F.lit(name).alias("test_name"), failed.alias("failed"), F.concat(*parts).alias("detail"))


def _none(name: str, bad: DataFrame, what: str) -> DataFrame:
    """The assertion that there is no such row."""
    return _verdict(name, bad.agg(F.count(F.lit(1)).alias("n")), F.col("n") > 0, F.col("n"), f" {what}")


def calendar_complete(
    tables: Tables, start: str = fv.CALENDAR_START, end: str = fv.CALENDAR_END
) -> DataFrame:
    first, last = date.fromisoformat(str(start)), date.fromisoformat(str(end))
    expected = (last - first).days + 1
    found = (
        tables["dim_date"]
        .filter(F.col("calendar_date").between(F.lit(first), F.lit(last)))
        .agg(F.count(F.lit(1)).alias("n"), F.min("calendar_date").alias("lo"), F.max("calendar_date").alias("hi"))
    )
    right = (F.col("n") == expected) & F.col("lo").eqNullSafe(F.lit(first)) & F.col("hi").eqNullSafe(F.lit(last))
    return _verdict("calendar complete", found, ~right, F.col("n"), f" of {expected} days")


def unknown_rows_present(tables: Tables) -> DataFrame:
    counts = [
        _verdict(
            f"unknown row of {table}",
            tables[table].agg(F.count_if(F.col(key_of(table)) == fv.UNKNOWN_KEY).alias("n")),
            F.col("n") != 1, F.col("n"), " rows",
        )
        for table in DIMENSIONS
    ]
    return reduce(DataFrame.unionByName, counts)


def _has_versions(tables: Tables, table: str, key: str) -> DataFrame:
    many = real_rows(tables[table], table).groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    counted = many.agg(F.count(F.lit(1)).alias("n"))
    return _verdict(f"{table} has a second version", counted, F.col("n") == 0, F.col("n"), " keys with versions")


def member_has_versions(tables: Tables) -> DataFrame:
    return _has_versions(tables, "dim_member", "member_id")


def provider_has_versions(tables: Tables) -> DataFrame:
    return _has_versions(tables, "dim_provider", "provider_id")


def member_no_overlap(tables: Tables) -> DataFrame:
    return _none("dim_member versions overlap", overlapping_versions(tables["dim_member"], "member_id"), "members")


def provider_no_overlap(tables: Tables) -> DataFrame:
    bad = overlapping_versions(tables["dim_provider"], "provider_id")
    return _none("dim_provider versions overlap", bad, "providers")


def member_one_current(tables: Tables) -> DataFrame:
    return _none("dim_member current rows", many_current(tables["dim_member"], "member_id"), "members")


def provider_one_current(tables: Tables) -> DataFrame:
    return _none("dim_provider current rows", many_current(tables["dim_provider"], "provider_id"), "providers")


def _inside_version(tables: Tables, table: str) -> DataFrame:
    """Claims outside their version's dates, counted per version and day before the join."""
    key = key_of(table)
    per_day = tables["fact_claim"].groupBy(key, "service_date_key").agg(F.count(F.lit(1)).alias("rows"))
    outside = (
        per_day.join(tables[table].select(key, "effective_start", "effective_end"), key)
        .join(tables["dim_date"].select(F.col("date_key").alias("service_date_key"), "calendar_date"), "service_date_key")
        .filter(~F.col("calendar_date").between(F.col("effective_start"), F.col("effective_end")))
        .agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n"))
    )
    return _verdict(f"service date inside {table} version", outside, F.col("n") > 0, F.col("n"), " claims outside")


def member_version_covers(tables: Tables) -> DataFrame:
    return _inside_version(tables, "dim_member")


def provider_version_covers(tables: Tables) -> DataFrame:
    return _inside_version(tables, "dim_provider")


def line_count_matches(tables: Tables) -> DataFrame:
    counts = tables["fact_claim_line"].groupBy("claim_id").agg(F.count(F.lit(1)).alias("rows"))
    bad = tables["fact_claim"].join(counts, "claim_id", "left").filter(
        ~F.col("line_count").eqNullSafe(F.coalesce("rows", F.lit(0)))
    )
    return _none("line count equals loaded lines", bad, "headers disagree")


def totals_match(tables: Tables) -> DataFrame:
    names = ["billed", "allowed", "paid"]
    sums = tables["fact_claim_line"].groupBy("claim_id").agg(*[F.sum(f"{n}_amount").alias(n) for n in names])
    equal = same([F.col(f"total_{n}") for n in names], [F.col(n) for n in names])
    bad = tables["fact_claim"].join(sums, "claim_id").filter(~equal)
    return _none("header totals equal line sums", bad, "headers disagree")


def both_reject_reasons(tables: Tables) -> DataFrame:
    """Holds for data with unknown members and unknown providers planted in it."""
    found = (
        tables["etl_dead_letter"]
        .filter((F.col("pipeline_name") == fv.CLAIM_PIPELINE) & F.col("reject_reason").isin(fv.NO_MEMBER, fv.NO_PROVIDER))
        .agg(F.count_distinct("reject_reason").alias("n"))
    )
    return _verdict("both reject reasons occur", found, F.col("n") != 2, F.col("n"), " reasons")


def rejects_not_loaded(tables: Tables) -> DataFrame:
    rejected = tables["etl_dead_letter"].filter(F.col("pipeline_name") == fv.CLAIM_PIPELINE).select("source_key")
    bad = rejected.join(
        tables["fact_claim"].select(F.col("claim_id").cast("string").alias("source_key")), "source_key", "left_semi"
    )
    return _none("rejected claims stayed out", bad, "rejected claims loaded")


def top_providers_size(tables: Tables) -> DataFrame:
    rows = analytics.top_providers_yoy(tables).agg(F.count(F.lit(1)).alias("n"))
    return _verdict("top providers size", rows, ~F.col("n").between(1, analytics.TOP), F.col("n"), " rows")


def spend_rank_from_one(tables: Tables) -> DataFrame:
    least = analytics.diagnosis_category_spend(tables).agg(F.min("spend_rank").alias("n"))
    return _verdict(
        "spend rank starts at one", least, ~F.col("n").eqNullSafe(F.lit(1)),
        "smallest rank ", F.coalesce(F.col("n").cast("string"), F.lit("none")),
    )


def denial_rate_range(tables: Tables, rates: DataFrame | None = None) -> DataFrame:
    """Over the query's own rows, or given ones."""
    rates = analytics.denial_rate(tables) if rates is None else rates
    bad = rates.filter(~F.col("denial_rate_pct").between(0, 100))
    return _none("denial rate between 0 and 100", bad, "rows out of range")


def summary_matches(tables: Tables) -> DataFrame:
    """The summary and the fact give the same months; rows missing on either side count."""
    columns = ["year_month", "claim_count", "total_paid"]
    base = analytics.monthly_totals(tables).select(*columns)
    stored = tables["monthly_claim_volume"].select(*columns)
    return _none("summary equals fact", base.exceptAll(stored).unionByName(stored.exceptAll(base)), "rows differ")


def moving_average_matches(tables: Tables, volume: DataFrame | None = None) -> DataFrame:
    """The average recomputed in month order, from the third month on, for the query's own rows or given ones."""
    in_order = Window.orderBy("year_month")
    volume = analytics.monthly_volume(tables) if volume is None else volume
    bad = (
        volume
        .withColumn("month", F.row_number().over(in_order))
        .withColumn("expected", average_over(F.col("claim_count"), in_order.rowsBetween(-2, 0), 2))
        .filter((F.col("month") >= 3) & ~F.col("claim_count_3_month_avg").eqNullSafe(F.col("expected")))
    )
    return _none("three-month average", bad, "months disagree")


def threshold_flag_matches(tables: Tables) -> DataFrame:
    bad = analytics.provider_ytd_threshold(tables).filter(
        ~F.col("crossed_one_million").eqNullSafe(F.col("crossed_one_million_on").isNotNull()) | (F.col("ytd_paid") < 0)
    )
    return _none("threshold flag equals crossing date", bad, "provider-years disagree")


# the order they are listed in is the order of the inventory
ASSERTIONS = [
    calendar_complete, unknown_rows_present, member_has_versions, provider_has_versions, member_no_overlap,
    provider_no_overlap, member_one_current, provider_one_current, member_version_covers, provider_version_covers,
    line_count_matches, totals_match, both_reject_reasons, rejects_not_loaded, top_providers_size,
    spend_rank_from_one, denial_rate_range, summary_matches, moving_average_matches, threshold_flag_matches,
]

VIEWS = {
    "q01_top_providers_yoy": analytics.top_providers_yoy,
    "q02_diagnosis_category_spend": analytics.diagnosis_category_spend,
    "q03_member_utilization": analytics.member_utilization,
    "q04_denial_rate": analytics.denial_rate,
    "q05_oon_cost_comparison": analytics.oon_cost_comparison,
    "q06_monthly_volume": analytics.monthly_volume,
    "q06_monthly_volume_mv": summary.monthly_volume_from_summary,
    "q07_member_cohort": analytics.member_cohort,
    "q08_provider_ytd_threshold": analytics.provider_ytd_threshold,
}


def integrity_report(tables: Tables, calendar: tuple | None = None) -> DataFrame:
    """Every assertion with its verdict. ``calendar`` is the range the calendar was loaded for."""
    rows = [
        check(tables, *calendar) if calendar and check is calendar_complete else check(tables) for check in ASSERTIONS
    ]
    return reduce(DataFrame.unionByName, rows)


def integrity_failures(report: DataFrame) -> DataFrame:
    return report.filter("failed").select("test_name", "detail").orderBy("test_name")


def assert_integrity(report: DataFrame) -> None:
    """Raise one error naming every failed assertion; the report has a row per assertion."""
    bad = integrity_failures(report).collect()
    if bad:
        lines = [f"{row.test_name}: {row.detail}" for row in bad]
        raise ConstraintError(f"integrity tests failed ({len(bad)}):\n" + "\n".join(lines))


def smoke_counts(tables: Tables, **arguments: tuple) -> DataFrame:
    """Rows returned by each analytic query. ``arguments`` are extra positional ones by query name."""
    counts = [
        query(tables, *arguments.get(name, ())).agg(F.count(F.lit(1)).alias("result_rows"))
        .select(F.lit(name).alias("query_name"), "result_rows")
        for name, query in VIEWS.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def assert_not_empty(counts: DataFrame) -> None:
    empty = [row.query_name for row in counts.filter("result_rows = 0").orderBy("query_name").collect()]
    if empty:
        raise ConstraintError(f"queries returned no rows: {', '.join(empty)}")
