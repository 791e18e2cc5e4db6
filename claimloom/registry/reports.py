"""Analytic queries, summary, quality checks, integrity assertions and constraints."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom import fixed_values as fv
from claimloom.operators import constraints, dimensions, quality
from claimloom.plans import analytics, integrity, summary
from claimloom.registry.base import loaded, query
from claimloom.registry.mapping import table
from claimloom.registry.model_sql import cents, ratio

# --- Q: analytic queries ---

_Q1 = f"""
    WITH y AS (SELECT provider_id, year_number, sum(total_paid) AS paid FROM fact GROUP BY 1, 2)
    SELECT row_number() OVER (ORDER BY a.paid DESC, a.provider_id) AS provider_rank, a.provider_id, c.provider_name,
           c.specialty, a.year_number, a.paid AS total_paid, b.paid AS prior_year_paid,
           {ratio(f"100 * ({cents('a.paid')} - {cents('b.paid')})", cents('b.paid'), 1)} AS yoy_change_pct
    FROM y a LEFT JOIN y b ON b.provider_id = a.provider_id AND b.year_number = a.year_number - 1
    JOIN dim_provider c ON c.provider_id = a.provider_id AND c.is_current
    WHERE a.year_number = (SELECT max(year_number) FROM y)
    ORDER BY a.paid DESC, a.provider_id LIMIT 20"""


@query(
    "q1_top_providers_yoy",
    "provider_rank bigint, provider_id bigint, provider_name string, specialty string, year_number bigint, "
    "total_paid money, prior_year_paid money, yoy_change_pct double",
    _Q1,
)
def q1(spark, folder):
    """Best paid providers of the latest year."""
    return analytics.top_providers_yoy(loaded(spark, folder).tables)


@query(
    "q2_diagnosis_category_spend", "category_name string, paid_claims bigint, total_paid money, spend_rank bigint",
    """SELECT *, rank() OVER (ORDER BY total_paid DESC) AS spend_rank
       FROM (SELECT category_name, count(*) AS paid_claims, sum(total_paid) AS total_paid FROM fact
             WHERE claim_status = 'Paid' AND known_diagnosis IS NOT NULL GROUP BY 1)""",
)
def q2(spark, folder):
    """Spend per diagnosis category."""
    return analytics.diagnosis_category_spend(loaded(spark, folder).tables)


@query(
    "q3_member_utilization",
    "plan_type string, year_month string, member_count bigint, claim_count bigint, claims_per_1000_members double, "
    "cumulative_months bigint",
    f"""WITH m AS (SELECT year_month, min(calendar_date) AS lo, max(calendar_date) AS hi FROM calendar
                   WHERE calendar_date BETWEEN (SELECT first_day FROM extent) AND (SELECT last_order_day FROM extent) GROUP BY 1),
        e AS (SELECT plan_type, year_month, count(DISTINCT member_id) AS members
              FROM m JOIN dim_member d ON d.effective_start <= m.hi AND d.effective_end >= m.lo GROUP BY 1, 2),
        c AS (SELECT plan_type, year_month, count(*) AS claims FROM fact GROUP BY 1, 2)
        SELECT plan_type, year_month, members AS member_count, coalesce(claims, 0) AS claim_count,
               {ratio('1000 * coalesce(claims, 0)', 'members', 2)} AS claims_per_1000_members,
               row_number() OVER (PARTITION BY plan_type ORDER BY year_month) AS cumulative_months
        FROM e LEFT JOIN c USING (plan_type, year_month)""",
)
def q3(spark, folder):
    """Claims per 1,000 covered members."""
    warehouse = loaded(spark, folder)
    return analytics.member_utilization(warehouse.tables, *warehouse.calendar.utilization)


@query(
    "q4_denial_rate",
    "specialty string, claim_type string, claims bigint, denied_claims bigint, denial_rate_pct double",
    f"""SELECT specialty, claim_type, count(*) AS claims, count(*) FILTER (WHERE claim_status = 'Denied') AS denied_claims,
               {ratio("100 * count(*) FILTER (WHERE claim_status = 'Denied')", 'count(*)', 2)} AS denial_rate_pct
        FROM fact GROUP BY 1, 2""",
)
def q4(spark, folder):
    """Denial rate by specialty and claim type."""
    return analytics.denial_rate(loaded(spark, folder).tables)


@query(
    "q5_oon_cost_comparison",
    "year_number bigint, members_with_claims bigint, in_network_paid money, out_of_network_paid money, "
    "in_network_paid_per_member double, out_of_network_paid_per_member double",
    f"""SELECT *, {ratio(cents('in_network_paid'), '100 * members_with_claims', 2)} AS in_network_paid_per_member,
               {ratio(cents('out_of_network_paid'), '100 * members_with_claims', 2)} AS out_of_network_paid_per_member
        FROM (SELECT year_number, count(DISTINCT member_id) AS members_with_claims,
                     coalesce(sum(total_paid) FILTER (WHERE network_status = 'In-Network'), 0) AS in_network_paid,
                     coalesce(sum(total_paid) FILTER (WHERE network_status = 'Out-of-Network'), 0) AS out_of_network_paid
              FROM fact GROUP BY 1)""",
)
def q5(spark, folder):
    """Amounts per member inside and outside the network."""
    return analytics.oon_cost_comparison(loaded(spark, folder).tables)


def _volume(month: str) -> str:
    return f"""SELECT year_month, claim_count, total_paid,
                      {ratio('sum(claim_count) OVER w', 'count(*) OVER w', 2)} AS claim_count_3_month_avg
               FROM (SELECT {month} AS year_month, count(*) AS claim_count, sum(total_paid) AS total_paid
                     FROM fact GROUP BY 1) WINDOW w AS (ORDER BY year_month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"""


_VOLUME_COLUMNS = "year_month string, claim_count bigint, total_paid money, claim_count_3_month_avg double"


@query("q6_monthly_volume", _VOLUME_COLUMNS, _volume("year_month"))
def q6(spark, folder):
    """Claims per service month with a moving average."""
    return analytics.monthly_volume(loaded(spark, folder).tables)


@query("q6b_processed_volume", _VOLUME_COLUMNS, _volume("strftime(processed_date, '%Y-%m')"))
def q6b(spark, folder):
    """The same by processed month."""
    return analytics.monthly_volume(loaded(spark, folder).tables, "processed_date_key")


@query(
    "q7_member_cohort",
    "cohort_year bigint, members bigint, avg_claims_first_12_months double, frequency_rank bigint, "
    "cumulative_avg_frequency double",
    f"""WITH per_member AS (
            SELECT m.member_id, year(m.enrollment_date) AS cohort_year, count(f.claim_id) AS n
            FROM members m LEFT JOIN fact f ON f.member_id = m.member_id AND f.service_date >= m.enrollment_date
                 AND f.service_date < CAST(m.enrollment_date + INTERVAL 12 MONTH AS DATE)
            GROUP BY 1, 2),
        s AS (SELECT cohort_year, count(*) AS members, CAST({ratio('sum(n) * 100', 'count(*)', 0)} AS BIGINT) AS h
              FROM per_member GROUP BY 1)
        SELECT cohort_year, members, CAST(h AS DOUBLE) / 100 AS avg_claims_first_12_months,
               rank() OVER (ORDER BY h DESC) AS frequency_rank,
               {ratio('sum(h) OVER w', '100 * count(*) OVER w', 2)} AS cumulative_avg_frequency
        FROM s WINDOW w AS (ORDER BY cohort_year ROWS UNBOUNDED PRECEDING)""",
)
def q7(spark, folder):
    """First-year claim frequency per enrolment cohort."""
    return analytics.member_cohort(loaded(spark, folder).tables)


@query(
    "q8_provider_ytd_threshold",
    "provider_id bigint, provider_name string, year_number bigint, ytd_paid money, crossed_one_million_on date, "
    "crossed_one_million boolean",
    f"""WITH d AS (SELECT provider_id, year_number, service_date, sum(total_paid) AS paid FROM fact GROUP BY 1, 2, 3),
        r AS (SELECT *, sum(paid) OVER (PARTITION BY provider_id, year_number ORDER BY service_date) AS ytd FROM d)
        SELECT provider_id, any_value(c.provider_name) AS provider_name, year_number, sum(paid) AS ytd_paid,
               min(service_date) FILTER (WHERE ytd >= {analytics.THRESHOLD}) AS crossed_one_million_on,
               sum(paid) >= {analytics.THRESHOLD} AS crossed_one_million
        FROM r JOIN (SELECT provider_id, provider_name FROM dim_provider WHERE is_current) c USING (provider_id)
        GROUP BY 1, 3""",
)
def q8(spark, folder):
    """Year-to-date amounts and crossing dates."""
    return analytics.provider_ytd_threshold(loaded(spark, folder).tables)


# --- M: summary ---

_SUMMARY = """SELECT year_month, min(service_date) AS month_start, count(*) AS claim_count, sum(total_paid) AS total_paid
              FROM fact GROUP BY 1"""
_SUMMARY_COLUMNS = "year_month string, month_start date, claim_count bigint, total_paid money"


@query("m1_monthly_claim_volume", _SUMMARY_COLUMNS, _SUMMARY)
def m1(spark, folder):
    """The summary computed from the fact."""
    return summary.monthly_claim_volume(loaded(spark, folder).tables)


@query("m2_refreshed_summary", _SUMMARY_COLUMNS, _SUMMARY)
def m2(spark, folder):
    """The summary as refreshed after the load."""
    return loaded(spark, folder).tables["monthly_claim_volume"]


@query("m3_volume_from_summary", _VOLUME_COLUMNS, _volume("year_month"))
def m3(spark, folder):
    """The monthly volume read from the summary."""
    return summary.monthly_volume_from_summary(loaded(spark, folder).tables)


# --- DQ: quality checks ---

_CHECK_COLUMNS = "check_name string, total_rows_evaluated bigint, passed bigint"
_CHECK_SQL = {
    "valid_keys": f"SELECT 1 AS o, '{quality.VALID_KEYS}' AS check_name, count(*) AS total_rows_evaluated, count(*) AS passed FROM fact",
    "paid_ratio": f"SELECT 2 AS o, '{quality.PAID_RATIO}' AS check_name, count(*) AS total_rows_evaluated, "
    "count(*) FILTER (WHERE total_paid * 100 <= total_allowed * 105) AS passed FROM fact",
    "one_current_member": f"SELECT 3 AS o, '{quality.ONE_MEMBER}' AS check_name, count(*) AS total_rows_evaluated, "
    "count(*) FILTER (WHERE n = 1) AS passed "
    "FROM (SELECT member_id, sum(CASE WHEN is_current THEN 1 ELSE 0 END) AS n FROM dim_member GROUP BY 1)",
    "one_current_provider": f"SELECT 4 AS o, '{quality.ONE_PROVIDER}' AS check_name, count(*) AS total_rows_evaluated, "
    "count(*) FILTER (WHERE n = 1) AS passed "
    "FROM (SELECT provider_id, sum(CASE WHEN is_current THEN 1 ELSE 0 END) AS n FROM dim_provider GROUP BY 1)",
    "header_exists": f"SELECT 5 AS o, '{quality.HEADER_EXISTS}' AS check_name, count(*) AS total_rows_evaluated, "
    "count(*) FILTER (WHERE claim_id IN (SELECT claim_id FROM fact)) AS passed FROM fact_line",
    "procedure_exists": f"SELECT 6 AS o, '{quality.PROCEDURE_EXISTS}' AS check_name, count(*) AS total_rows_evaluated, "
    "count(*) FILTER (WHERE procedure_code IN (SELECT code FROM codes)) AS passed FROM fact_line",
    "network_date": f"SELECT 7 AS o, '{quality.NETWORK_DATE}' AS check_name, count(*) AS total_rows_evaluated, "
    "count(*) FILTER (WHERE service_date >= network_effective_date) AS passed FROM fact",
}


def _register_checks() -> None:
    for number, check in enumerate(quality.CHECKS, start=1):

        def run(spark, folder, check=check):
            return check(loaded(spark, folder).tables)

        run.__doc__ = check.__doc__
        query(f"dq{number}_{check.__name__}", _CHECK_COLUMNS, _CHECK_SQL[check.__name__])(run)


_register_checks()


@query(
    "dq8_quality_report",
    "sort_order bigint, check_name string, total_rows_evaluated bigint, passed bigint, failed bigint, "
    "pass_rate double, status string",
    "SELECT o AS sort_order, check_name, total_rows_evaluated, passed, total_rows_evaluated - passed AS failed, "
    + ratio("100 * passed", "total_rows_evaluated", 2)
    + """ AS pass_rate, CASE WHEN total_rows_evaluated > 0 AND (total_rows_evaluated - passed) * 100 <= total_rows_evaluated
          THEN 'PASS' ELSE 'FAIL' END AS status FROM (""" + " UNION ALL ".join(_CHECK_SQL.values()) + ")",
)
def dq8(spark, folder):
    """The whole report."""
    return quality.quality_report(loaded(spark, folder).tables)


# --- IA: integrity assertions ---

_VERDICT_COLUMNS = "test_name string, failed boolean, detail string"


def _verdict_sql(name: str, count: str, what: str, failed: str = "n > 0") -> str:
    return f"SELECT '{name}' AS test_name, {failed} AS failed, CAST(n AS VARCHAR) || ' {what}' AS detail FROM (SELECT {count})"


_DAYS = "(SELECT count(*) FROM calendar)"
_IA_SQL = {
    "calendar_complete": _verdict_sql(
        "calendar complete", "count(*) AS n FROM calendar",
        "of ' || (SELECT CAST(last_day - first_day + 1 AS VARCHAR) FROM extent) || ' days",
        "n <> (SELECT last_day - first_day + 1 FROM extent)",
    ),
    "unknown_rows_present": " UNION ALL ".join(
        f"SELECT 'unknown row of {name}' AS test_name, FALSE AS failed, '1 rows' AS detail FROM region WHERE r_regionkey = 0"
        for name in ("dim_date", "dim_plan", "dim_diagnosis", "dim_procedure", "dim_member", "dim_provider")
    ),
    "member_has_versions": _verdict_sql(
        "dim_member has a second version",
        "count(*) AS n FROM (SELECT member_id FROM dim_member GROUP BY 1 HAVING count(*) > 1)", "keys with versions", "n = 0",
    ),
    "provider_has_versions": _verdict_sql(
        "dim_provider has a second version",
        "count(*) AS n FROM (SELECT provider_id FROM dim_provider GROUP BY 1 HAVING count(*) > 1)", "keys with versions", "n = 0",
    ),
    "member_no_overlap": _verdict_sql(
        "dim_member versions overlap",
        "count(DISTINCT a.member_id) AS n FROM dim_member a JOIN dim_member b ON a.member_id = b.member_id "
        "AND a.effective_start < b.effective_start AND b.effective_start <= a.effective_end", "members",
    ),
    "provider_no_overlap": _verdict_sql(
        "dim_provider versions overlap",
        "count(DISTINCT a.provider_id) AS n FROM dim_provider a JOIN dim_provider b ON a.provider_id = b.provider_id "
        "AND a.effective_start < b.effective_start AND b.effective_start <= a.effective_end", "providers",
    ),
    "member_one_current": _verdict_sql(
        "dim_member current rows",
        "count(*) AS n FROM (SELECT member_id FROM dim_member WHERE is_current GROUP BY 1 HAVING count(*) > 1)", "members",
    ),
    "provider_one_current": _verdict_sql(
        "dim_provider current rows",
        "count(*) AS n FROM (SELECT provider_id FROM dim_provider WHERE is_current GROUP BY 1 HAVING count(*) > 1)", "providers",
    ),
    "member_version_covers": _verdict_sql(
        "service date inside dim_member version",
        "count(*) AS n FROM fact f JOIN dim_member m ON m.member_id = f.member_id AND m.effective_start = f.member_since "
        "WHERE f.service_date < m.effective_start OR f.service_date > m.effective_end", "claims outside",
    ),
    "provider_version_covers": _verdict_sql(
        "service date inside dim_provider version",
        "count(*) AS n FROM fact f JOIN dim_provider p ON p.provider_id = f.provider_id "
        "AND p.effective_start = f.provider_since "
        "WHERE f.service_date < p.effective_start OR f.service_date > p.effective_end", "claims outside",
    ),
    "line_count_matches": _verdict_sql(
        "line count equals loaded lines",
        "count(*) AS n FROM fact f LEFT JOIN (SELECT claim_id, count(*) AS k FROM fact_line GROUP BY 1) l USING (claim_id) "
        "WHERE f.line_count <> coalesce(l.k, 0)", "headers disagree",
    ),
    "totals_match": _verdict_sql(
        "header totals equal line sums",
        "count(*) AS n FROM fact f JOIN (SELECT claim_id, sum(billed_amount) AS b, sum(allowed_amount) AS a, "
        "sum(paid_amount) AS p FROM fact_line GROUP BY 1) l USING (claim_id) "
        "WHERE f.total_billed <> b OR f.total_allowed <> a OR f.total_paid <> p", "headers disagree",
    ),
    "both_reject_reasons": _verdict_sql(
        "both reject reasons occur",
        f"count(DISTINCT reject_reason) AS n FROM batch WHERE reject_reason IN ('{fv.NO_MEMBER}', '{fv.NO_PROVIDER}')",
        "reasons", "n <> 2",
    ),
    "rejects_not_loaded": _verdict_sql(
        "rejected claims stayed out",
        "count(*) AS n FROM fact JOIN batch USING (claim_id) WHERE batch.reject_reason IS NOT NULL", "rejected claims loaded",
    ),
    "top_providers_size": _verdict_sql(
        "top providers size",
        "least(count(DISTINCT provider_id), 20) AS n FROM fact WHERE year_number = (SELECT max(year_number) FROM fact)",
        "rows", "n = 0",
    ),
    "spend_rank_from_one": "SELECT 'spend rank starts at one' AS test_name, count(*) = 0 AS failed, "
    "CASE WHEN count(*) = 0 THEN 'smallest rank none' ELSE 'smallest rank 1' END AS detail "
    "FROM fact WHERE claim_status = 'Paid' AND known_diagnosis IS NOT NULL",
    "denial_rate_range": _verdict_sql("denial rate between 0 and 100", "count(*) AS n FROM fact WHERE claim_id < -1", "rows out of range"),
    "summary_matches": _verdict_sql("summary equals fact", "count(*) AS n FROM fact WHERE claim_id < -1", "rows differ"),
    "moving_average_matches": _verdict_sql("three-month average", "count(*) AS n FROM fact WHERE claim_id < -1", "months disagree"),
    "threshold_flag_matches": _verdict_sql(
        "threshold flag equals crossing date", "count(*) AS n FROM fact WHERE total_paid < 0", "provider-years disagree"
    ),
}


def _assertion(warehouse, check) -> DataFrame:
    days = warehouse.calendar.days
    return check(warehouse.tables, *days) if check is integrity.calendar_complete else check(warehouse.tables)


# Checks that hold by construction run a second time over rows with breaches planted by value, so that
# their answers depend on the data.
_PLANTED_SQL = {
    "unknown_rows_present": " UNION ALL ".join(
        f"SELECT 'unknown row of {name}' AS test_name, n <> 1 AS failed, CAST(n AS VARCHAR) || ' rows' AS detail "
        f"FROM (SELECT {count} AS n FROM region)"
        for name, count in (
            ("dim_date", "least(1, count(*))"), ("dim_plan", "0 * count(*)"), ("dim_diagnosis", "least(1, count(*))"),
            ("dim_procedure", "least(1, count(*))"), ("dim_member", "count(*)"), ("dim_provider", "least(1, count(*))"),
        )
    ),
    "denial_rate_range": _verdict_sql(
        "denial rate between 0 and 100",
        "count(*) AS n FROM (SELECT 40 * count(*) FILTER (WHERE claim_status = 'Denied') > count(*) AS wrong FROM fact "
        "GROUP BY specialty, claim_type) WHERE wrong", "rows out of range",
    ),
    "summary_matches": _verdict_sql(
        "summary equals fact",
        "2 * count(*) AS n FROM (SELECT DISTINCT year_month FROM fact) WHERE CAST(right(year_month, 2) AS INTEGER) % 3 = 1", "rows differ",
    ),
    "moving_average_matches": _verdict_sql(
        "three-month average",
        "count(*) AS n FROM (SELECT year_month, row_number() OVER (ORDER BY year_month) AS r FROM (SELECT DISTINCT year_month FROM fact)) "
        "WHERE r >= 3 AND CAST(right(year_month, 2) AS INTEGER) % 2 = 0", "months disagree",
    ),
}


def _planted(spark, folder: str, name: str) -> DataFrame:
    """The verdict of a check over rows with planted breaches."""
    tables = loaded(spark, folder).tables
    month = F.right("year_month", F.lit(2)).cast("int")
    if name == "unknown_rows_present":
        copies = table(spark, folder, "region").agg(F.count(F.lit(1)).alias("n")).scalar().cast("int")
        again = tables["dim_member"].filter("member_key = -1").withColumn("copy", F.explode(F.sequence(F.lit(1), copies))).drop("copy")
        real = {t: dimensions.real_rows(tables[t], t) for t in ("dim_member", "dim_plan")}
        return integrity.unknown_rows_present({**tables, "dim_member": real["dim_member"].unionByName(again), "dim_plan": real["dim_plan"]})
    if name == "denial_rate_range":
        # more than one claim in forty denied is given as more than a hundred per cent
        rates = analytics.denial_rate(tables)
        wrong = F.when(40 * F.col("denied_claims") > F.col("claims"), F.lit(101)).otherwise(F.col("denial_rate_pct"))
        return integrity.denial_rate_range(tables, rates.withColumn("denial_rate_pct", wrong))
    if name == "summary_matches":
        more = F.col("claim_count") + F.when(month % 3 == 1, 1).otherwise(0)
        return integrity.summary_matches({**tables, "monthly_claim_volume": tables["monthly_claim_volume"].withColumn("claim_count", more)})
    average = F.col("claim_count_3_month_avg") + F.when(month % 2 == 0, 1).otherwise(0)
    return integrity.moving_average_matches(tables, analytics.monthly_volume(tables).withColumn("claim_count_3_month_avg", average))


def _register_assertions() -> None:
    for number, check in enumerate(integrity.ASSERTIONS, start=1):
        name = check.__name__
        planted = name in _PLANTED_SQL

        def run(spark, folder, check=check, planted=planted):
            verdict = _assertion(loaded(spark, folder), check)
            return verdict.unionByName(_planted(spark, folder, check.__name__)) if planted else verdict

        run.__doc__ = check.__doc__
        sql = f"{_IA_SQL[name]} UNION ALL {_PLANTED_SQL[name]}" if planted else _IA_SQL[name]
        query(f"ia{number}_{name}", _VERDICT_COLUMNS, sql)(run)


_register_assertions()


@query(
    "ia0_integrity_failures", "test_name string, detail string",
    "SELECT test_name, detail FROM (" + " UNION ALL ".join(_IA_SQL.values()) + ") WHERE failed",
)
def ia0(spark, folder):
    """All failed assertions; header totals are independent of lines in these tables, so some do fail."""
    warehouse = loaded(spark, folder)
    return integrity.integrity_failures(integrity.integrity_report(warehouse.tables, warehouse.calendar.days))


@query(
    "ia21_smoke_counts", "query_name string, result_rows bigint",
    f"""SELECT 'q01_top_providers_yoy' AS query_name, (SELECT count(*) FROM ({_Q1})) AS result_rows
        UNION ALL SELECT 'q02_diagnosis_category_spend', (SELECT count(DISTINCT category_name) FROM fact
            WHERE claim_status = 'Paid' AND known_diagnosis IS NOT NULL)
        UNION ALL SELECT 'q03_member_utilization', (SELECT count(*) FROM (SELECT DISTINCT plan_type, year_month
            FROM (SELECT year_month, min(calendar_date) AS lo, max(calendar_date) AS hi FROM calendar
                  WHERE calendar_date BETWEEN (SELECT first_day FROM extent) AND (SELECT last_order_day FROM extent) GROUP BY 1) m
            JOIN dim_member d ON d.effective_start <= m.hi AND d.effective_end >= m.lo))
        UNION ALL SELECT 'q04_denial_rate', (SELECT count(*) FROM (SELECT DISTINCT specialty, claim_type FROM fact))
        UNION ALL SELECT 'q05_oon_cost_comparison', (SELECT count(DISTINCT year_number) FROM fact)
        UNION ALL SELECT 'q06_monthly_volume', (SELECT count(DISTINCT year_month) FROM fact)
        UNION ALL SELECT 'q06_monthly_volume_mv', (SELECT count(DISTINCT year_month) FROM fact)
        UNION ALL SELECT 'q07_member_cohort', (SELECT count(DISTINCT year(enrollment_date)) FROM members)
        UNION ALL SELECT 'q08_provider_ytd_threshold',
            (SELECT count(*) FROM (SELECT DISTINCT provider_id, year_number FROM fact))""",
)
def ia21(spark, folder):
    """Rows returned by each analytic query."""
    warehouse = loaded(spark, folder)
    return integrity.smoke_counts(warehouse.tables, q03_member_utilization=warehouse.calendar.utilization)


# --- C: constraints ---


@query(
    "c1_duplicate_keys", "l_orderkey bigint, l_linenumber bigint, rows bigint",
    "SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def c1(spark, folder):
    """Keys that are not unique."""
    return constraints.duplicate_keys(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "c2_one_current", "member_id bigint, rows bigint",
    """SELECT member_id, count(*) AS rows FROM dim_member WHERE is_current OR member_id % 3 = 0
       GROUP BY 1 HAVING count(*) > 1""",
)
def c2(spark, folder):
    """Members with two current versions, once every third member's closed versions are reopened."""
    reopened = F.col("is_current") | (F.col("member_id") % 3 == 0)
    dim = loaded(spark, folder).tables["dim_member"].withColumn("is_current", reopened)
    return constraints.many_current(dim, "member_id")


@query(
    "c3_check", "denial_reason string, claims bigint",
    """SELECT denial_reason, count(*) AS claims FROM claims
       WHERE NOT coalesce(denial_reason IN ('Duplicate claim', 'Timely filing') AND total_paid >= 0, TRUE) GROUP BY 1""",
)
def c3(spark, folder):
    """Rows failing a predicate; rows for which it is unknown pass."""
    bad = constraints.check_violations(
        loaded(spark, folder).source["claims"], "denial_reason in ('Duplicate claim', 'Timely filing') and total_paid >= 0"
    )
    return bad.groupBy("denial_reason").agg(F.count(F.lit(1)).alias("claims"))


@query(
    "c4_foreign_key", "column_name string, missing string",
    """SELECT DISTINCT 'member_id' AS column_name, CAST(member_id AS VARCHAR) AS missing FROM claims
           WHERE member_id NOT IN (SELECT member_id FROM members)
       UNION ALL SELECT DISTINCT 'provider_id', CAST(provider_id AS VARCHAR) FROM claims
           WHERE provider_id NOT IN (SELECT provider_id FROM providers)
       UNION ALL SELECT DISTINCT 'primary_diagnosis_code', primary_diagnosis_code FROM claims
           WHERE primary_diagnosis_code NOT IN (SELECT code FROM codes)""",
)
def c4(spark, folder):
    """Claim references without a parent row."""
    source = loaded(spark, folder).source
    parents = [
        ("member_id", "members", "member_id"), ("provider_id", "providers", "provider_id"),
        ("primary_diagnosis_code", "diagnosis_codes", "diagnosis_code"),
    ]
    found = [
        constraints.missing_parents(source["claims"], column, source[parent], key).select(
            F.lit(column).alias("column_name"), F.col("missing").cast("string").alias("missing")
        )
        for column, parent, key in parents
    ]
    return reduce(DataFrame.unionByName, found)


@query(
    "c5_not_null", "claim_id bigint, denial_reason bigint, processed_date bigint",
    """SELECT count(*) FILTER (WHERE claim_id IS NULL) AS claim_id, count(*) FILTER (WHERE denial_reason IS NULL) AS denial_reason,
              count(*) FILTER (WHERE processed_date IS NULL) AS processed_date FROM claims""",
)
def c5(spark, folder):
    """Nulls per column, counted in one scan."""
    return constraints.null_counts(
        loaded(spark, folder).source["claims"], ["claim_id", "denial_reason", "processed_date"]
    )


@query(
    "c0_constraint_report", "table_name string, kind string, name string, violations bigint",
    """SELECT 'claims' AS table_name, 'unique' AS kind, 'claim_id' AS name,
              (SELECT count(*) FROM (SELECT claim_id FROM claims GROUP BY 1 HAVING count(*) > 1)) AS violations
       UNION ALL SELECT 'claims', 'check', 'claim type', (SELECT count(*) FROM claims
           WHERE claim_type NOT IN ('Professional', 'Inpatient', 'Outpatient', 'Emergency'))
       UNION ALL SELECT 'claims', 'check', 'claim status', (SELECT count(*) FROM claims WHERE claim_status NOT IN ('Paid', 'Denied'))
       UNION ALL SELECT 'claims', 'check', 'processed', (SELECT count(*) FROM claims WHERE processed_date < service_date)
       UNION ALL SELECT 'claims', 'not null', c, (SELECT count(*) FROM claims WHERE claim_id IS NULL)
           FROM (VALUES ('claim_id'), ('member_id'), ('provider_id'), ('primary_diagnosis_code'), ('claim_type'),
                 ('claim_status'), ('service_date'), ('processed_date'), ('total_billed'), ('total_allowed'), ('total_paid')) v(c)
       UNION ALL SELECT 'claim_lines', 'unique', 'claim_line_id', (SELECT count(*) FROM (SELECT claim_line_id FROM lines GROUP BY 1 HAVING count(*) > 1))
       UNION ALL SELECT 'claim_lines', 'unique', 'claim_id, line_number', (SELECT count(*) FROM (SELECT claim_id, line_number FROM lines GROUP BY 1, 2 HAVING count(*) > 1))
       UNION ALL SELECT 'claim_lines', 'check', 'amounts', (SELECT count(*) FROM lines WHERE units <= 0 OR billed_amount < 0)
       UNION ALL SELECT 'claim_lines', 'foreign key', 'claim_id', (SELECT count(DISTINCT claim_id) FROM lines WHERE claim_id NOT IN (SELECT claim_id FROM claims))
       UNION ALL SELECT 'claim_lines', 'not null', c, (SELECT count(*) FROM lines WHERE claim_id IS NULL)
           FROM (VALUES ('claim_line_id'), ('claim_id'), ('line_number'), ('procedure_code'), ('diagnosis_code'),
                 ('service_date'), ('units'), ('billed_amount'), ('allowed_amount'), ('paid_amount')) v(c)""",
)
def c0(spark, folder):
    """All declared constraints of claims and lines with their violations."""
    return constraints.constraint_report(loaded(spark, folder).source, ["claims", "claim_lines"])
