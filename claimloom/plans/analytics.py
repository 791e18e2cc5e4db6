"""The eight analytic queries over the warehouse tables.

Each query first shrinks the fact on its own keys, so that what meets the version dimensions is
provider-years or day totals instead of claims. A provider with a third of all claims is then
a handful of rows before it is ever shuffled or joined.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimloom import fixed_values as fv
from claimloom.functions import average_over, rate, safe_divide
from claimloom.operators.dimensions import real_rows

Tables = dict[str, DataFrame]
TOP = 20
THRESHOLD = 1_000_000


def _with_day(facts: DataFrame, dim_date: DataFrame, *columns: str, key: str = "service_date_key") -> DataFrame:
    """Join the calendar in the given role. It has a row per day, whatever the size of the facts."""
    return facts.join(dim_date.select(F.col("date_key").alias(key), *columns), key)


def _provider_ids(dim_provider: DataFrame) -> DataFrame:
    return dim_provider.select("provider_key", "provider_id")


def _current_provider(dim_provider: DataFrame, *columns: str) -> DataFrame:
    return dim_provider.filter("is_current").select("provider_id", *columns)


def top_providers_yoy(tables: Tables, top: int = TOP) -> DataFrame:
    """Best paid providers of the latest service year, with the change against the year before.

    All versions of a provider count, under its current name. A gap year has no prior amount.
    """
    per_version = (
        _with_day(tables["fact_claim"].filter("provider_key is not null"), tables["dim_date"], "year_number")
        .groupBy("provider_key", "year_number")
        .agg(F.sum("total_paid").alias("paid"))
    )
    # taken over the amount as well, so that the planner reuses the exchange of the aggregate above
    latest = per_version.agg(F.max(F.struct("year_number", "paid"))["year_number"].alias("year")).scalar()
    # one exchange on the provider serves the year totals and the window over them
    provider_year = (
        per_version.join(_provider_ids(tables["dim_provider"]), "provider_key")
        .repartition("provider_id")
        .groupBy("provider_id", "year_number")
        .agg(F.sum("paid").alias("total_paid"))
    )
    by_year = Window.partitionBy("provider_id").orderBy("year_number")
    with_prior = provider_year.select(
        "*",
        F.when(F.lag("year_number").over(by_year) == F.col("year_number") - 1, F.lag("total_paid").over(by_year))
        .alias("prior_year_paid"),
    ).filter(F.col("year_number") == latest)
    change = F.lit("100.0").cast("decimal(4,1)") * (F.col("total_paid") - F.col("prior_year_paid"))
    best = (
        with_prior.join(_current_provider(tables["dim_provider"], "provider_name", "specialty"), "provider_id")
        .orderBy(F.desc("total_paid"), "provider_id")
        .limit(top)
    )
    in_order = Window.orderBy(F.desc("total_paid"), "provider_id")
    return best.select(
        F.row_number().over(in_order).alias("provider_rank"),
        "provider_id", "provider_name", "specialty", "year_number", "total_paid", "prior_year_paid",
        F.round(safe_divide(change, F.col("prior_year_paid")), 1).alias("yoy_change_pct"),
    ).orderBy("provider_rank")


def diagnosis_category_spend(tables: Tables) -> DataFrame:
    """Paid claims and amount per diagnosis category, ranked by amount; unknown codes are left out."""
    per_code = (
        tables["fact_claim"]
        .filter("claim_status = 'Paid'")
        .groupBy(F.col("primary_diagnosis_key").alias("diagnosis_key"))
        .agg(F.count(F.lit(1)).alias("claims"), F.sum("total_paid").alias("paid"))
    )
    known = real_rows(tables["dim_diagnosis"], "dim_diagnosis").select("diagnosis_key", "category_name")
    return (
        per_code.join(known, "diagnosis_key")
        .groupBy("category_name")
        .agg(F.sum("claims").alias("paid_claims"), F.sum("paid").alias("total_paid"))
        .withColumn("spend_rank", F.rank().over(Window.orderBy(F.desc("total_paid"))))
        .orderBy("spend_rank", "category_name")
    )


def enrolled_members(tables: Tables, low: str, high: str) -> DataFrame:
    """Members covered in each month per plan type, for months with at least one.

    A member counts once per month and plan type, however many versions touch the month. The
    versions are not spread over months: each adds one at the first month it newly covers and
    takes one away after its last, and running totals over those few sums give every month.
    """
    days = tables["dim_date"].filter(F.col("calendar_date").between(F.lit(low).cast("date"), F.lit(high).cast("date")))
    first_day = days.agg(F.min("calendar_date").alias("d")).scalar()
    last_day = days.agg(F.max("calendar_date").alias("d")).scalar()

    def month_number(day):
        return F.year(day) * 12 + F.month(day) - 1

    spans = (
        real_rows(tables["dim_member"], "dim_member")
        .join(tables["dim_plan"].select("plan_key", "plan_type"), "plan_key")
        .select(
            "member_id", "plan_type",
            F.greatest("effective_start", first_day).alias("since"), F.least("effective_end", last_day).alias("until"),
        )
        .filter("since <= until")
        .select("member_id", "plan_type", month_number("since").alias("first"), month_number("until").alias("last"))
    )
    earlier = Window.partitionBy("member_id", "plan_type").orderBy("first", "last").rowsBetween(
        Window.unboundedPreceding, -1
    )
    newly = (
        spans.withColumn("covered", F.max("last").over(earlier))
        .withColumn("first", F.greatest("first", F.col("covered") + 1))
        .filter("first <= last")
    )
    steps = (
        newly.selectExpr("plan_type", "stack(2, first, 1, last + 1, -1) as (month, step)")
        .groupBy("plan_type", "month")
        .agg(F.sum("step").alias("step"))
    )
    by_month = Window.partitionBy("plan_type").orderBy("month")
    levels = steps.select(
        "plan_type", "month", F.sum("step").over(by_month).alias("member_count"),
        F.lead("month").over(by_month).alias("next_month"),
    ).filter("member_count > 0")
    months = days.select("year_month", month_number("calendar_date").alias("month")).distinct()
    return (
        levels.withColumn("month", F.explode(F.sequence("month", F.col("next_month") - 1)))
        .join(months, "month")
        .select("plan_type", "year_month", "member_count")
    )


def member_utilization(
    tables: Tables, low: str = fv.CALENDAR_START, high: str = fv.LAST_SERVICE_MONTH_END
) -> DataFrame:
    """Claims per 1,000 covered members by plan type and month, and the months seen so far."""
    claims = (
        _with_day(
            tables["fact_claim"].groupBy("service_date_key", "plan_key").agg(F.count(F.lit(1)).alias("claims")),
            tables["dim_date"], "year_month",
        )
        .join(tables["dim_plan"].select("plan_key", "plan_type"), "plan_key")
        .groupBy("plan_type", "year_month")
        .agg(F.sum("claims").alias("claims"))
    )
    so_far = Window.partitionBy("plan_type").orderBy("year_month").rowsBetween(Window.unboundedPreceding, 0)
    joined = enrolled_members(tables, low, high).join(claims, ["plan_type", "year_month"], "left")
    count = F.coalesce("claims", F.lit(0))
    return joined.select(
        "plan_type", "year_month", "member_count", count.alias("claim_count"),
        rate(count, F.col("member_count"), "1000.0", 2).alias("claims_per_1000_members"),
        F.count(F.lit(1)).over(so_far).alias("cumulative_months"),
    ).orderBy("plan_type", "year_month")


def denial_rate(tables: Tables) -> DataFrame:
    """Share of denied claims by the specialty on the service date and claim type."""
    per_version = tables["fact_claim"].groupBy("provider_key", "claim_type").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("claim_status") == "Denied").alias("denied")
    )
    return (
        per_version.join(tables["dim_provider"].select("provider_key", "specialty"), "provider_key")
        .groupBy("specialty", "claim_type")
        .agg(F.sum("rows").alias("claims"), F.sum("denied").alias("denied_claims"))
        .withColumn("denial_rate_pct", rate(F.col("denied_claims"), F.col("claims"), "100.0", 2))
        .orderBy(F.desc("denial_rate_pct"), F.desc("claims"))
    )


def oon_cost_comparison(tables: Tables) -> DataFrame:
    """In- and out-of-network amounts per member with a claim in the year.

    The amounts depend on the provider version only and the member count on the member only, so
    each is aggregated by itself and the claims never meet a version dimension row by row.
    """
    claims = _with_day(tables["fact_claim"], tables["dim_date"], "year_number")
    members = (
        claims.select("year_number", "member_key")
        .distinct()
        .join(tables["dim_member"].select("member_key", "member_id"), "member_key")
        .select("year_number", "member_id")
        .distinct()
        .groupBy("year_number")
        .agg(F.count(F.lit(1)).alias("members_with_claims"))
    )
    networks = (
        claims.groupBy("year_number", "provider_key")
        .agg(F.sum("total_paid").alias("paid"))
        .join(tables["dim_provider"].select("provider_key", "network_status"), "provider_key")
    )
    zero = F.lit(0).cast("decimal(22,2)")

    def paid_to(status: str):
        return F.sum(F.when(F.col("network_status") == status, F.col("paid")).otherwise(zero))

    amounts = networks.groupBy("year_number").agg(
        paid_to("In-Network").alias("in_network_paid"), paid_to("Out-of-Network").alias("out_of_network_paid")
    )
    per_member = [
        F.round(safe_divide(F.col(c), F.col("members_with_claims")), 2).alias(f"{c}_per_member")
        for c in ("in_network_paid", "out_of_network_paid")
    ]
    return (
        members.join(amounts, "year_number")
        .select("year_number", "members_with_claims", "in_network_paid", "out_of_network_paid", *per_member)
        .orderBy("year_number")
    )


def monthly_totals(tables: Tables, role: str = "service_date_key") -> DataFrame:
    """Claims and paid amount per month; a month starts on its first day that has a claim."""
    per_day = (
        tables["fact_claim"]
        .groupBy(role)
        .agg(F.count(F.lit(1)).alias("claims"), F.sum("total_paid").alias("paid"))
    )
    return (
        _with_day(per_day, tables["dim_date"], "year_month", "calendar_date", key=role)
        .groupBy("year_month")
        .agg(
            F.min("calendar_date").alias("month_start"),
            F.sum("claims").alias("claim_count"),
            F.sum("paid").cast("decimal(22,2)").alias("total_paid"),
        )
    )


def moving_average(months: DataFrame) -> DataFrame:
    """Three-row mean of the monthly claim count. The window runs over one row per month."""
    three = Window.orderBy("month_start").rowsBetween(-2, 0)
    return months.select(
        "year_month", "claim_count", "total_paid",
        average_over(F.col("claim_count"), three, 2).alias("claim_count_3_month_avg"),
    ).orderBy("year_month")


def monthly_volume(tables: Tables, role: str = "service_date_key") -> DataFrame:
    """Monthly claim volume by service month, or by processed month in that role."""
    return moving_average(monthly_totals(tables, role))


def member_cohort(tables: Tables) -> DataFrame:
    """Claims per member in the first 12 months after enrolment, by enrolment year.

    A cohort's mean needs only its claims and its members, so claims are counted per cohort
    and never regrouped per member.
    """
    versions = real_rows(tables["dim_member"], "dim_member").select("member_key", "member_id", "enrollment_date")
    cohort = versions.groupBy("member_id").agg(F.year(F.min("enrollment_date")).alias("cohort_year"))
    members = cohort.groupBy("cohort_year").agg(F.count(F.lit(1)).alias("members"))
    claims = (
        _with_day(tables["fact_claim"].select("member_key", "service_date_key"), tables["dim_date"], "calendar_date")
        .join(versions.join(cohort, "member_id"), "member_key")
        .filter(
            (F.col("calendar_date") >= F.col("enrollment_date"))
            & (F.col("calendar_date") < F.add_months("enrollment_date", 12))
        )
        .groupBy("cohort_year")
        .agg(F.count(F.lit(1)).alias("claims"))
    )
    summary = members.join(claims, "cohort_year", "left").select(
        "cohort_year", "members",
        F.round(F.coalesce("claims", F.lit(0)).cast("decimal(20,0)") / F.col("members"), 2)
        .cast("decimal(18,2)")
        .alias("avg_claims_first_12_months"),
    )
    mean = F.col("avg_claims_first_12_months")
    so_far = Window.orderBy("cohort_year").rowsBetween(Window.unboundedPreceding, 0)
    return summary.select(
        "cohort_year", "members", "avg_claims_first_12_months",
        F.rank().over(Window.orderBy(F.desc("avg_claims_first_12_months"))).alias("frequency_rank"),
        average_over(mean, so_far, 2).alias("cumulative_avg_frequency"),
    ).orderBy("cohort_year")


def provider_ytd_threshold(tables: Tables, threshold: int = THRESHOLD) -> DataFrame:
    """Year-to-date amount per provider and the day its running total reached the threshold."""
    per_day = tables["fact_claim"].groupBy("provider_key", "service_date_key").agg(F.sum("total_paid").alias("paid"))
    placed = _with_day(per_day, tables["dim_date"], "year_number", "calendar_date").join(
        _provider_ids(tables["dim_provider"]), "provider_key"
    )
    # one exchange on provider and year serves the day totals, the running sum and the last aggregate
    daily = (
        placed.repartition("provider_id", "year_number")
        .groupBy("provider_id", "year_number", "calendar_date")
        .agg(F.sum("paid").alias("paid"))
    )
    so_far = (
        Window.partitionBy("provider_id", "year_number")
        .orderBy("calendar_date")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    running = daily.withColumn("ytd", F.sum("paid").over(so_far))
    crossing = (F.col("ytd") >= threshold) & (F.col("ytd") - F.col("paid") < threshold)
    totals = running.groupBy("provider_id", "year_number").agg(
        F.max("ytd").alias("ytd_paid"),
        F.min(F.when(crossing, F.col("calendar_date"))).alias("crossed_one_million_on"),
    )
    # sorting samples its input first; an exchange of the few totals keeps that from running the window twice
    return (
        totals.repartition("provider_id")
        .join(_current_provider(tables["dim_provider"], "provider_name"), "provider_id")
        .select(
            "provider_id", "provider_name", "year_number", "ytd_paid", "crossed_one_million_on",
            F.col("crossed_one_million_on").isNotNull().alias("crossed_one_million"),
        )
        .orderBy("year_number", F.desc("ytd_paid"))
    )
