"""Building blocks: sources, predicates, joins, aggregates, windows, set operations, functions."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from claimloom import fixed_values as fv
from claimloom import functions as fx
from claimloom.operators.constraints import duplicate_keys
from claimloom.operators.dimensions import key_of
from claimloom.operators.facts import retained_dead_letters
from claimloom.operators.ledger import member_history_disposition
from claimloom.operators.scd2 import member_history, overlapping_versions, scd2_lookup
from claimloom.plans import analytics
from claimloom.plans.load import DIMENSIONS
from claimloom.registry.base import loaded, query
from claimloom.registry.mapping import table
from claimloom.registry.model_sql import cents, ratio
from claimloom.session import cut_lineage
from claimloom.sources import spanned, values_relation


# --- S: sources and sinks ---


@query(
    "s1_read_source",
    "table_name string, rows bigint",
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS rows FROM {model}"
        for name, model in (
            ("plan_types", "plan_types"), ("diagnosis_codes", "codes"), ("procedure_codes", "codes"),
            ("members", "members"), ("member_plan_history", "member_history"), ("providers", "providers"),
            ("provider_network_history", "provider_history"), ("claims", "claims"), ("claim_lines", "lines"),
        )
    ),
)
def s1(spark, folder):
    """All nine source tables read with their fixed schema."""
    source = loaded(spark, folder).source
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, df in source.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), counts)


@query(
    "s2_calendar",
    "calendar_date date, orders bigint",
    """SELECT CAST(d AS DATE) AS calendar_date, count(o_orderkey) AS orders
       FROM (SELECT min(CAST(o_orderdate AS DATE)) lo, max(CAST(o_orderdate AS DATE)) hi FROM orders) b,
            generate_series(lo, hi, INTERVAL 1 DAY) AS t(d)
       LEFT JOIN orders ON CAST(o_orderdate AS DATE) = CAST(d AS DATE)
       GROUP BY 1""",
)
def s2(spark, folder):
    """One row per day of the order dates' range, days without orders included."""
    days = table(spark, folder, "orders").groupBy(F.col("o_orderdate").cast("date").alias("calendar_date")).agg(
        F.count(F.lit(1)).alias("orders")
    )
    extent = days.agg(F.min("calendar_date").alias("low"), F.max("calendar_date").alias("high"))
    return spanned(extent, "low", "high", "calendar_date").join(days, "calendar_date", "left").select(
        "calendar_date", F.coalesce("orders", F.lit(0)).alias("orders")
    )


@query(
    "s3_series",
    "n bigint, orders bigint",
    """SELECT n, count(k) AS orders
       FROM (SELECT max(c) AS hi FROM (SELECT count(*) c FROM lineitem GROUP BY l_orderkey)) b,
            generate_series(1, hi) AS t(n)
       LEFT JOIN (SELECT l_orderkey, count(*) AS k FROM lineitem GROUP BY l_orderkey) ON k = n
       GROUP BY n""",
)
def s3(spark, folder):
    """Integers up to the longest order, each with the number of orders of that many lines."""
    sizes = (
        table(spark, folder, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("n").agg(F.count(F.lit(1)).alias("orders"))
    )
    extent = sizes.agg(F.lit(1).cast("bigint").alias("one"), F.max("n").alias("longest"))
    return spanned(extent, "one", "longest", "n").join(sizes, "n", "left").select("n", F.coalesce("orders", F.lit(0)).alias("orders"))


@query(
    "s4_values_relation",
    "city string, state string, customers bigint, balance money",
    "SELECT city, state, count(*) AS customers, sum(CAST(c_acctbal AS DECIMAL(12,2))) AS balance FROM customer JOIN (VALUES "
    + ", ".join(str(row) for row in fv.LOCATIONS)
    + ") AS v(place, city, state) ON c_custkey % 10 = place GROUP BY city, state",
)
def s4(spark, folder):
    """A literal relation joined on a remainder."""
    places = values_relation(spark, fv.LOCATIONS, "place bigint, city string, state string")
    return (
        table(spark, folder, "customer").join(places, F.col("c_custkey") % 10 == F.col("place"))
        .groupBy("city", "state")
        .agg(F.count(F.lit(1)).alias("customers"), F.sum(F.col("c_acctbal").cast("decimal(12,2)")).alias("balance"))
    )


@query(
    "s6_load_profile",
    "profile_id bigint, scale_factor double, member_count bigint, provider_count bigint, claim_count bigint, "
    "claim_line_count bigint",
    """SELECT 1 AS profile_id, CAST(round((SELECT count(*) FROM orders) / 2000000, 4) AS DECIMAL(8,4)) AS scale_factor, (SELECT count(*) FROM customer) AS member_count,
              (SELECT count(*) FROM supplier) AS provider_count, (SELECT count(*) FROM orders) AS claim_count,
              (SELECT count(*) FROM lineitem) AS claim_line_count""",
)
def s6(spark, folder):
    """The one-row record of the source volumes, as the load wrote it."""
    return loaded(spark, folder).tables["load_profile"]


@query(
    "s7_append",
    "claims bigint, first_key bigint, last_key bigint, keys bigint",
    "SELECT count(*) AS claims, 1 AS first_key, count(*) AS last_key, count(*) AS keys FROM fact",
)
def s7(spark, folder):
    """Rows appended to the fact are complete and numbered without gaps."""
    return loaded(spark, folder).tables["fact_claim"].agg(
        F.count(F.lit(1)).alias("claims"), F.min("claim_key").alias("first_key"),
        F.max("claim_key").alias("last_key"), F.count_distinct("claim_key").alias("keys"),
    )


@query(
    "s8_reset",
    "table_name string, unknown_rows bigint, real_rows bigint",
    """SELECT 'dim_date' AS table_name, 1 AS unknown_rows, (SELECT count(*) FROM calendar) AS real_rows
       UNION ALL SELECT 'dim_plan', 1, (SELECT count(*) FROM plan_types)
       UNION ALL SELECT 'dim_diagnosis', 1, (SELECT count(*) FROM codes)
       UNION ALL SELECT 'dim_procedure', 1, (SELECT count(*) FROM codes)
       UNION ALL SELECT 'dim_member', 1, (SELECT count(*) FROM dim_member)
       UNION ALL SELECT 'dim_provider', 1, (SELECT count(*) FROM dim_provider)""",
)
def s8(spark, folder):
    """After reset and load every dimension has one placeholder row beside its real ones."""
    tables = loaded(spark, folder).tables
    counts = [
        tables[name].agg(
            F.count_if(F.col(key_of(name)) == -1).alias("unknown_rows"),
            F.count_if(F.col(key_of(name)) != -1).alias("real_rows"),
        ).select(F.lit(name).alias("table_name"), "*")
        for name in DIMENSIONS
    ]
    return reduce(lambda a, b: a.unionByName(b), counts)


@query(
    "s9_materialized_report",
    "claim_status string, claims bigint, total_paid money",
    "SELECT claim_status, count(*) AS claims, sum(total_paid) AS total_paid FROM fact GROUP BY claim_status",
)
def s9(spark, folder):
    """A small report kept for several readers."""
    report = loaded(spark, folder).tables["fact_claim"].groupBy("claim_status").agg(
        F.count(F.lit(1)).alias("claims"), F.sum("total_paid").alias("total_paid")
    )
    return cut_lineage(report)


# --- P: projections and predicates ---


@query(
    "p1_projection", "claim_id bigint, service_day date, paid money",
    "SELECT claim_id, service_date AS service_day, total_paid AS paid FROM claims",
)
def p1(spark, folder):
    """Columns renamed; the scan reads only these three."""
    return loaded(spark, folder).source["claims"].select(
        "claim_id", F.col("service_date").alias("service_day"), F.col("total_paid").alias("paid")
    )


@query(
    "p2_searched_case", "band string, orders bigint",
    """SELECT CASE WHEN o_totalprice < 50000 THEN 'low' WHEN o_totalprice < 200000 THEN 'middle' ELSE 'high' END AS band,
              count(*) AS orders FROM orders GROUP BY 1""",
)
def p2(spark, folder):
    """The first matching branch wins."""
    price = F.col("o_totalprice")
    band = F.when(price < 50000, "low").when(price < 200000, "middle").otherwise("high")
    return table(spark, folder, "orders").groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("orders"))


@query(
    "p3_simple_case", "status string, orders bigint",
    """SELECT CASE o_orderstatus WHEN 'F' THEN 'final' WHEN 'O' THEN 'open' ELSE 'pending' END AS status,
              count(*) AS orders FROM orders GROUP BY 1""",
)
def p3(spark, folder):
    """A value mapped case by case."""
    code = F.col("o_orderstatus")
    status = F.when(code == "F", "final").when(code == "O", "open").otherwise("pending")
    return table(spark, folder, "orders").groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("orders"))


@query(
    "p4_coalesce_unknown", "known boolean, claims bigint",
    "SELECT known_diagnosis IS NOT NULL AS known, count(*) AS claims FROM fact GROUP BY 1",
)
def p4(spark, folder):
    """Claims whose diagnosis fell back to the placeholder key, and the others."""
    fact = loaded(spark, folder).tables["fact_claim"]
    return fact.groupBy((F.col("primary_diagnosis_key") != -1).alias("known")).agg(F.count(F.lit(1)).alias("claims"))


@query(
    "p5_safe_divide", "o_orderkey bigint, share double",
    "SELECT o_orderkey, " + ratio("o_orderkey % 7", "o_orderkey % 3", 3) + " AS share FROM orders",
)
def p5(spark, folder):
    """Null instead of an error where the divisor is zero."""
    key = F.col("o_orderkey")
    share = fx.safe_divide((key % 7).cast("decimal(12,0)"), (key % 3).cast("decimal(12,0)"))
    return table(spark, folder, "orders").select("o_orderkey", F.round(share, 3).alias("share"))


@query(
    "p6_between", "inside boolean, claims bigint",
    """SELECT service_date BETWEEN DATE '1996-01-01' AND DATE '1997-12-31' AS inside, count(*) AS claims
       FROM claims GROUP BY 1""",
)
def p6(spark, folder):
    """Both ends belong to the range."""
    inside = F.col("service_date").between(F.lit(date(1996, 1, 1)), F.lit(date(1997, 12, 31)))
    return loaded(spark, folder).source["claims"].groupBy(inside.alias("inside")).agg(F.count(F.lit(1)).alias("claims"))


@query(
    "p7_is_distinct_from", "differs boolean, claims bigint",
    "SELECT denial_reason IS DISTINCT FROM 'Duplicate claim' AS differs, count(*) AS claims FROM claims GROUP BY 1",
)
def p7(spark, folder):
    """A null differs from a value and equals a null."""
    differs = fx.differs([F.col("denial_reason")], [F.lit("Duplicate claim")])
    return loaded(spark, folder).source["claims"].groupBy(differs.alias("differs")).agg(F.count(F.lit(1)).alias("claims"))


@query(
    "p8_half_open_range", "claims bigint",
    """SELECT count(*) AS claims FROM claims JOIN members USING (member_id)
       WHERE service_date >= enrollment_date AND service_date < CAST(enrollment_date + INTERVAL 12 MONTH AS DATE)""",
)
def p8(spark, folder):
    """Claims in the twelve months from enrolment, the anniversary left out."""
    source = loaded(spark, folder).source
    start, day = F.col("enrollment_date"), F.col("service_date")
    joined = source["claims"].select("member_id", "service_date").join(
        source["members"].select("member_id", "enrollment_date"), "member_id"
    )
    return joined.filter((day >= start) & (day < F.add_months(start, 12))).agg(F.count(F.lit(1)).alias("claims"))


@query(
    "p9_is_not_null_flag", "claim_id bigint, denied boolean",
    "SELECT claim_id, denial_reason IS NOT NULL AS denied FROM claims",
)
def p9(spark, folder):
    """Presence as a boolean column."""
    return loaded(spark, folder).source["claims"].select("claim_id", F.col("denial_reason").isNotNull().alias("denied"))


@query(
    "p10_in_list", "reject_reason string, letters bigint",
    f"""SELECT reject_reason, count(*) AS letters FROM letters
        WHERE pipeline_name = '{fv.CLAIM_PIPELINE}' AND reject_reason IN ('{fv.NO_MEMBER}', '{fv.NO_PROVIDER}')
        GROUP BY reject_reason""",
)
def p10(spark, folder):
    """Membership in a fixed list."""
    letters = loaded(spark, folder).tables["etl_dead_letter"]
    wanted = F.col("reject_reason").isin(fv.NO_MEMBER, fv.NO_PROVIDER) & (F.col("pipeline_name") == fv.CLAIM_PIPELINE)
    return letters.filter(wanted).groupBy("reject_reason").agg(F.count(F.lit(1)).alias("letters"))


@query(
    "p11_greatest_least", "o_orderkey bigint, most bigint, least bigint",
    """SELECT o_orderkey, greatest(o_orderkey % 7, o_custkey % 5, NULLIF(o_orderkey % 3, 0)) AS most,
              least(o_orderkey % 7, o_custkey % 5, NULLIF(o_orderkey % 3, 0)) AS least FROM orders""",
)
def p11(spark, folder):
    """Extremes of a row's values; nulls are skipped."""
    key = F.col("o_orderkey")
    values = [key % 7, F.col("o_custkey") % 5, F.nullif(key % 3, F.lit(0))]
    return table(spark, folder, "orders").select(
        "o_orderkey", F.greatest(*values).alias("most"), F.least(*values).alias("least")
    )


@query(
    "p12_scalar_subquery_filter", "claim_id bigint, year_number bigint",
    "SELECT claim_id, year_number FROM fact WHERE year_number = (SELECT max(year_number) FROM fact)",
)
def p12(spark, folder):
    """Claims of the latest service year."""
    tables = loaded(spark, folder).tables
    claims = analytics._with_day(
        tables["fact_claim"].select("claim_id", "service_date_key"), tables["dim_date"], "year_number"
    )
    return claims.filter(F.col("year_number") == claims.agg(F.max("year_number").alias("y")).scalar())


@query(
    "p13_scalar_subquery_column", "suppliers bigint, idle_suppliers bigint",
    """SELECT count(*) AS suppliers,
              (SELECT count(*) FROM supplier s WHERE NOT EXISTS
                  (SELECT 1 FROM lineitem WHERE l_suppkey = s.s_suppkey AND l_quantity >= 50)) AS idle_suppliers
       FROM supplier""",
)
def p13(spark, folder):
    """A reverse-orphan count beside a plain count, without a join between them."""
    supplier = table(spark, folder, "supplier")
    busy = table(spark, folder, "lineitem").filter("l_quantity >= 50").select(F.col("l_suppkey").alias("s_suppkey"))
    idle = supplier.join(busy.distinct(), "s_suppkey", "left_anti").agg(F.count(F.lit(1)).alias("n"))
    return supplier.agg(F.count(F.lit(1)).alias("suppliers")).select("suppliers", idle.scalar().alias("idle_suppliers"))


# --- J: joins ---


@query(
    "j1_star_join", "year_month string, claims bigint",
    "SELECT year_month, count(*) AS claims FROM fact GROUP BY year_month",
)
def j1(spark, folder):
    """Fact to calendar on the surrogate key."""
    tables = loaded(spark, folder).tables
    return analytics._with_day(tables["fact_claim"], tables["dim_date"], "year_month").groupBy("year_month").agg(
        F.count(F.lit(1)).alias("claims")
    )


@query(
    "j2_point_in_time_join", "claim_id bigint, member_since date, plan_id bigint",
    "SELECT claim_id, member_since, plan_id FROM batch",
)
def j2(spark, folder):
    """Every claim with the member version in force on its service date, if any."""
    data = loaded(spark, folder)
    return scd2_lookup(
        data.source["claims"].select("claim_id", "member_id", "service_date"), data.tables["dim_member"],
        "dim_member", "member_id", "service_date", {"effective_start": "member_since", "plan_id": "plan_id"},
    )


@query(
    "j3_role_playing_join", "claim_id bigint, service_month string, processed_month string",
    """SELECT claim_id, year_month AS service_month, strftime(processed_date, '%Y-%m') AS processed_month FROM fact""",
)
def j3(spark, folder):
    """The calendar joined in two roles."""
    tables = loaded(spark, folder).tables
    claims = tables["fact_claim"].select("claim_id", "service_date_key", "processed_date_key")
    served = analytics._with_day(claims, tables["dim_date"], F.col("year_month").alias("service_month"))
    return analytics._with_day(
        served, tables["dim_date"], F.col("year_month").alias("processed_month"), key="processed_date_key"
    )


@query(
    "j4_left_join_default_key", "procedure_known boolean, diagnosis_known boolean, lines bigint",
    """SELECT p.code IS NOT NULL AS procedure_known, d.code IS NOT NULL AS diagnosis_known, count(*) AS lines
       FROM fact_line l LEFT JOIN codes p ON p.code = l.procedure_code LEFT JOIN codes d ON d.code = l.diagnosis_code
       GROUP BY 1, 2""",
)
def j4(spark, folder):
    """Lines with unknown codes stay, under the placeholder key."""
    lines = loaded(spark, folder).tables["fact_claim_line"]
    return lines.groupBy(
        (F.col("procedure_key") != -1).alias("procedure_known"), (F.col("diagnosis_key") != -1).alias("diagnosis_known")
    ).agg(F.count(F.lit(1)).alias("lines"))


@query(
    "j5_join_preaggregated_child", "o_orderkey bigint, line_count bigint",
    """SELECT o_orderkey, coalesce(n, 0) AS line_count FROM orders
       LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey""",
)
def j5(spark, folder):
    """Orders with their number of lines; lines are counted before the join."""
    counts = table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return table(spark, folder, "orders").select("o_orderkey").join(counts, "o_orderkey", "left").select(
        "o_orderkey", F.coalesce("n", F.lit(0)).alias("line_count")
    )


@query(
    "j6_current_version_rejoin", "provider_id bigint, network_status string, claims bigint",
    """SELECT f.provider_id, c.network_status, count(*) AS claims
       FROM fact f JOIN dim_provider c ON c.provider_id = f.provider_id AND c.is_current GROUP BY 1, 2""",
)
def j6(spark, folder):
    """Claims of all versions under the current version's attributes."""
    tables = loaded(spark, folder).tables
    per_version = tables["fact_claim"].groupBy("provider_key").agg(F.count(F.lit(1)).alias("n"))
    return (
        per_version.join(analytics._provider_ids(tables["dim_provider"]), "provider_key")
        .groupBy("provider_id").agg(F.sum("n").alias("claims"))
        .join(analytics._current_provider(tables["dim_provider"], "network_status"), "provider_id")
    )


_MONTHS_SQL = f"""SELECT strftime(calendar_date, '%Y-%m') AS year_month, min(calendar_date) AS lo, max(calendar_date) AS hi
    FROM calendar WHERE calendar_date BETWEEN (SELECT first_day FROM extent) AND (SELECT last_order_day FROM extent) GROUP BY 1"""


@query(
    "j7_interval_overlap", "plan_type string, year_month string, member_count bigint",
    f"""SELECT plan_type, year_month, count(DISTINCT member_id) AS member_count
        FROM ({_MONTHS_SQL}) m JOIN dim_member d ON d.effective_start <= m.hi AND d.effective_end >= m.lo
        GROUP BY 1, 2""",
)
def j7(spark, folder):
    """Covered members per plan type and month, without joining months to versions."""
    warehouse = loaded(spark, folder)
    return analytics.enrolled_members(warehouse.tables, *warehouse.calendar.utilization)


@query(
    "j8_overlapping_ranges", "l_suppkey bigint",
    """WITH spans AS (SELECT l_suppkey, l_orderkey, min(CAST(l_shipdate AS DATE)) AS lo, max(CAST(l_shipdate AS DATE)) AS hi
                      FROM lineitem GROUP BY l_suppkey, l_orderkey)
       SELECT DISTINCT l_suppkey FROM (SELECT l_suppkey, lo, max(hi) OVER (PARTITION BY l_suppkey ORDER BY lo, l_orderkey
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS open_until FROM spans) WHERE lo <= open_until""",
)
def j8(spark, folder):
    """Suppliers with two orders whose shipping spans overlap, found in one sorted pass."""
    day = F.col("l_shipdate").cast("date")
    spans = (
        table(spark, folder, "lineitem").groupBy("l_suppkey", "l_orderkey")
        .agg(F.min(day).alias("effective_start"), F.max(day).alias("effective_end"))
    )
    return overlapping_versions(spans, "l_suppkey")


@query(
    "j9_anti_join", "o_orderkey bigint",
    "SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)",
)
def j9(spark, folder):
    """Orders without lines."""
    ordered = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    return table(spark, folder, "orders").select("o_orderkey").join(ordered, "o_orderkey", "left_anti")


@query(
    "j10_latest_per_key", "user_id bigint, event_type string",
    """SELECT user_id, event_type FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1""",
)
def j10(spark, folder):
    """The newest event type per user; a partial aggregate keeps one candidate per user and task."""
    return table(spark, folder, "events").groupBy("user_id").agg(F.max_by("event_type", "event_id").alias("event_type"))


@query(
    "j11_lateral_existence", "disposition string, rows bigint",
    """SELECT CASE WHEN EXISTS (SELECT 1 FROM dim_member d WHERE d.member_id = h.member_id
                                AND d.effective_start = h.effective_start) THEN 'loaded'
                   WHEN EXISTS (SELECT 1 FROM dim_member d WHERE d.member_id = h.member_id
                                AND h.effective_start BETWEEN d.effective_start AND d.effective_end
                                AND d.plan_id = h.plan_id) THEN 'collapsed'
                   ELSE 'unaccounted' END AS disposition, count(*) AS rows
       FROM member_history h GROUP BY 1""",
)
def j11(spark, folder):
    """History rows by whether a version starts on their day, or an equal one covers it."""
    data = loaded(spark, folder)
    outcome = member_history_disposition(data.source["member_plan_history"], data.tables["dim_member"])
    return outcome.groupBy("disposition").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "j12_chained_columns", "o_orderkey bigint, billed money, allowed money, paid money",
    "SELECT claim_id AS o_orderkey, total_billed AS billed, total_allowed AS allowed, total_paid AS paid FROM claims",
)
def j12(spark, folder):
    """Each amount computed from the one before it."""
    billed = F.col("o_totalprice").cast("decimal(12,2)")
    chain = table(spark, folder, "orders").withColumn("billed", billed)
    chain = chain.withColumn("allowed", F.round(F.col("billed") * F.lit(fv.ALLOWED_SHARE).cast("decimal(3,2)"), 2))
    paid = F.round(F.col("allowed") * F.lit(fv.PAID_SHARE).cast("decimal(3,2)"), 2)
    return chain.select("o_orderkey", "billed", "allowed", F.when(F.col("o_orderstatus") == "P", 0).otherwise(paid).alias("paid"))


@query(
    "j13_fan_out", "o_orderkey bigint, n bigint",
    "SELECT o_orderkey, n FROM orders JOIN (VALUES (1), (2), (3), (4)) AS v(n) "
    "ON n <= CASE WHEN o_orderkey % 4 = 0 THEN 3 ELSE 4 END",
)
def j13(spark, folder):
    """Three or four rows per order."""
    count = F.when(F.col("o_orderkey") % 4 == 0, 3).otherwise(4)
    return table(spark, folder, "orders").select("o_orderkey", F.explode(F.sequence(F.lit(1), count)).alias("n"))


@query(
    "j14_update_from", "member_id bigint, plan_id bigint, state string, zip_code string",
    "SELECT member_id, plan_id, state, zip_code FROM dim_member WHERE is_current",
)
def j14(spark, folder):
    """Member rows overwritten with their open history row."""
    source = loaded(spark, folder).source
    names = ["plan_id", "state", "zip_code"]
    opened = source["member_plan_history"].filter("effective_end is null").select("member_id", F.struct(*names).alias("new"))
    return source["members"].join(opened, "member_id", "left").select(
        "member_id", *[F.when(F.col("new").isNotNull(), F.col(f"new.{n}")).otherwise(F.col(n)).alias(n) for n in names]
    )


@query(
    "j15_delete_using", "pipeline_name string, letters bigint",
    f"SELECT pipeline_name, count(*) AS letters FROM letters WHERE pipeline_name <> '{fv.CLAIM_PIPELINE}' GROUP BY 1",
)
def j15(spark, folder):
    """Dead letters left when every source claim is tried again."""
    data = loaded(spark, folder)
    kept = retained_dead_letters(data.tables["etl_dead_letter"], data.source["claims"])
    return kept.groupBy("pipeline_name").agg(F.count(F.lit(1)).alias("letters"))


@query(
    "j16_left_join_distinct", "customers bigint, with_orders bigint",
    """SELECT count(*) AS customers, count(o_custkey) AS with_orders
       FROM customer LEFT JOIN (SELECT DISTINCT o_custkey FROM orders) ON o_custkey = c_custkey""",
)
def j16(spark, folder):
    """Customers, and those with an order."""
    buyers = table(spark, folder, "orders").select(F.col("o_custkey").alias("c_custkey")).distinct().withColumn("found", F.lit(True))
    joined = table(spark, folder, "customer").select("c_custkey").join(buyers, "c_custkey", "left")
    return joined.agg(F.count(F.lit(1)).alias("customers"), F.count("found").alias("with_orders"))


# --- A: aggregates ---


@query(
    "a1_group_by", "l_returnflag string, l_linestatus string, lines bigint, total money, least money, most money, mean double",
    "SELECT l_returnflag, l_linestatus, count(*) AS lines, sum(v) AS total, min(v) AS least, max(v) AS most, "
    + ratio(cents("sum(v)"), "count(*)", 0)
    + " / 100 AS mean FROM (SELECT *, CAST(l_extendedprice AS DECIMAL(12,2)) AS v FROM lineitem) GROUP BY 1, 2",
)
def a1(spark, folder):
    """The plain aggregates; the mean is exact and rounded once."""
    value = F.col("l_extendedprice").cast("decimal(12,2)")
    return table(spark, folder, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("lines"), F.sum(value).alias("total"), F.min(value).alias("least"),
        F.max(value).alias("most"), F.round(F.sum(value) / F.count(value), 2).alias("mean"),
    )


@query(
    "a2_conditional_sum", "o_custkey bigint, pending money, other money",
    """SELECT o_custkey, sum(CASE WHEN o_orderstatus = 'P' THEN v ELSE 0 END) AS pending,
              sum(CASE WHEN o_orderstatus = 'P' THEN 0 ELSE v END) AS other
       FROM (SELECT *, CAST(o_totalprice AS DECIMAL(12,2)) AS v FROM orders) GROUP BY o_custkey""",
)
def a2(spark, folder):
    """One pass, two conditional sums."""
    value, pending = F.col("o_totalprice").cast("decimal(12,2)"), F.col("o_orderstatus") == "P"
    zero = F.lit(0).cast("decimal(12,2)")
    return table(spark, folder, "orders").groupBy("o_custkey").agg(
        F.sum(F.when(pending, value).otherwise(zero)).alias("pending"),
        F.sum(F.when(pending, zero).otherwise(value)).alias("other"),
    )


@query(
    "a3_filtered_aggregate", "user_id bigint, errors bigint, first_error bigint",
    """SELECT user_id, count(*) FILTER (WHERE event_type = 'error') AS errors,
              min(event_id) FILTER (WHERE event_type = 'error') AS first_error FROM events GROUP BY user_id""",
)
def a3(spark, folder):
    """Aggregates over the matching rows only; null where none match."""
    error = F.col("event_type") == "error"
    return table(spark, folder, "events").groupBy("user_id").agg(
        F.count_if(error).alias("errors"), F.min(F.when(error, F.col("event_id"))).alias("first_error")
    )


@query(
    "a4_count_distinct", "o_orderpriority string, customers bigint",
    "SELECT o_orderpriority, count(DISTINCT o_custkey) AS customers FROM orders GROUP BY 1",
)
def a4(spark, folder):
    """Distinct customers per priority."""
    return table(spark, folder, "orders").groupBy("o_orderpriority").agg(F.count_distinct("o_custkey").alias("customers"))


@query(
    "a5_group_by_dedupe", "l_suppkey bigint, l_partkey bigint",
    "SELECT l_suppkey, l_partkey FROM lineitem GROUP BY 1, 2",
)
def a5(spark, folder):
    """Grouping without an aggregate."""
    return table(spark, folder, "lineitem").select("l_suppkey", "l_partkey").distinct()


@query(
    "a6_two_level_aggregate", "year_number bigint, customers bigint, most_orders bigint",
    """SELECT year_number, count(*) AS customers, max(n) AS most_orders
       FROM (SELECT year(o_orderdate) AS year_number, o_custkey, count(*) AS n FROM orders GROUP BY 1, 2) GROUP BY 1""",
)
def a6(spark, folder):
    """Customer-years first, years second."""
    per_customer = table(spark, folder, "orders").groupBy(F.year("o_orderdate").alias("year_number"), "o_custkey").agg(
        F.count(F.lit(1)).alias("n")
    )
    return per_customer.groupBy("year_number").agg(F.count(F.lit(1)).alias("customers"), F.max("n").alias("most_orders"))


@query(
    "a7_having", "l_orderkey bigint, l_linenumber bigint, rows bigint",
    "SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def a7(spark, folder):
    """Groups filtered by their aggregate."""
    return table(spark, folder, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(
        F.count(F.lit(1)).alias("rows")
    ).filter("rows > 1")


@query(
    "a8_ordered_string_agg", "r_name string, nations string",
    """SELECT r_name, string_agg(n_name, ', ' ORDER BY n_name) AS nations
       FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name""",
)
def a8(spark, folder):
    """Names joined in order. The catalog of nations bounds each text."""
    joined = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return joined.groupBy("r_name").agg(F.expr("string_agg(n_name, ', ') within group (order by n_name)").alias("nations"))


@query(
    "a9_distinct", "member_id bigint", "SELECT DISTINCT member_id FROM dim_member",
)
def a9(spark, folder):
    """Members on the dimension."""
    return loaded(spark, folder).tables["dim_member"].filter("member_key <> -1").select("member_id").distinct()


@query(
    "a10_empty_default", "largest bigint, of_none bigint",
    """SELECT coalesce(max(l_linenumber), 1) AS largest,
              coalesce(max(l_linenumber) FILTER (WHERE l_quantity < 0), 1) AS of_none FROM lineitem""",
)
def a10(spark, folder):
    """A global aggregate with a default for empty input."""
    lines = table(spark, folder, "lineitem")
    none = F.max(F.when(F.col("l_quantity") < 0, F.col("l_linenumber")))
    return lines.agg(
        F.coalesce(F.max("l_linenumber"), F.lit(1)).alias("largest"), F.coalesce(none, F.lit(1)).alias("of_none")
    )


# --- W: windows ---


@query(
    "w1_version_rank", "history_id bigint, version_rank bigint",
    """SELECT history_id, row_number() OVER (PARTITION BY member_id ORDER BY effective_start, history_id) AS version_rank
       FROM member_history""",
)
def w1(spark, folder):
    """Rank of each history row within its member."""
    source = loaded(spark, folder).source
    return member_history(source["member_plan_history"], source["members"])


@query(
    "w2_row_number_top", "position bigint, o_orderkey bigint, price money",
    """SELECT row_number() OVER (ORDER BY price DESC, o_orderkey) AS position, o_orderkey, price
       FROM (SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(12,2)) AS price FROM orders)
       ORDER BY price DESC, o_orderkey LIMIT 20""",
)
def w2(spark, folder):
    """Twenty dearest orders, numbered after the cut."""
    priced = table(spark, folder, "orders").select("o_orderkey", F.col("o_totalprice").cast("decimal(12,2)").alias("price"))
    best = priced.orderBy(F.desc("price"), "o_orderkey").limit(20)
    return best.withColumn("position", F.row_number().over(Window.orderBy(F.desc("price"), "o_orderkey")))


@query(
    "w3_rank_over_aggregate", "p_type string, revenue money, place bigint",
    """SELECT p_type, revenue, rank() OVER (ORDER BY revenue DESC) AS place
       FROM (SELECT p_type, sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS revenue
             FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY p_type)""",
)
def w3(spark, folder):
    """Part types ranked by revenue; lines are summed per part before the join."""
    per_part = table(spark, folder, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(
        F.sum(F.col("l_extendedprice").cast("decimal(12,2)")).alias("revenue")
    )
    per_type = per_part.join(table(spark, folder, "part").select("p_partkey", "p_type"), "p_partkey").groupBy("p_type").agg(
        F.sum("revenue").alias("revenue")
    )
    return per_type.withColumn("place", F.rank().over(Window.orderBy(F.desc("revenue"))))


@query(
    "w4_rank_over_average", "c_mktsegment string, mean double, place bigint",
    "SELECT c_mktsegment, mean, rank() OVER (ORDER BY mean DESC) AS place FROM (SELECT c_mktsegment, "
    + ratio("sum(n)", "count(*)", 2)
    + """ AS mean FROM (SELECT c_mktsegment, c_custkey, count(o_orderkey) AS n
         FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2) GROUP BY 1)""",
)
def w4(spark, folder):
    """Segments ranked by orders per customer, customers without orders included."""
    orders = table(spark, folder, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"))
    per_segment = table(spark, folder, "customer").join(orders, "c_custkey", "left").groupBy("c_mktsegment").agg(
        F.round(F.sum(F.coalesce("n", F.lit(0))).cast("decimal(20,0)") / F.count(F.lit(1)), 2).alias("mean")
    )
    return per_segment.withColumn("place", F.rank().over(Window.orderBy(F.desc("mean"))))


@query(
    "w5_lag_with_gap_guard", "o_custkey bigint, year_number bigint, orders bigint, prior_orders bigint",
    """WITH y AS (SELECT o_custkey, year(o_orderdate) AS year_number, count(*) AS orders FROM orders GROUP BY 1, 2)
       SELECT a.o_custkey, a.year_number, a.orders, b.orders AS prior_orders
       FROM y a LEFT JOIN y b ON b.o_custkey = a.o_custkey AND b.year_number = a.year_number - 1""",
)
def w5(spark, folder):
    """The year before, only if it is the year directly before."""
    years = table(spark, folder, "orders").groupBy("o_custkey", F.year("o_orderdate").alias("year_number")).agg(
        F.count(F.lit(1)).alias("orders")
    )
    by_year = Window.partitionBy("o_custkey").orderBy("year_number")
    follows = F.lag("year_number").over(by_year) == F.col("year_number") - 1
    return years.withColumn("prior_orders", F.when(follows, F.lag("orders").over(by_year)))


_DAILY = "SELECT l_suppkey, CAST(l_shipdate AS DATE) AS day, sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS amount FROM lineitem GROUP BY 1, 2"


@query(
    "w6_running_sum", "l_suppkey bigint, day date, year_to_date money",
    f"""SELECT l_suppkey, day, sum(amount) OVER (PARTITION BY l_suppkey, year(day) ORDER BY day
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS year_to_date FROM ({_DAILY})""",
)
def w6(spark, folder):
    """Year-to-date amount per supplier; a supplier-year has one row per day before the window."""
    daily = table(spark, folder, "lineitem").groupBy("l_suppkey", F.col("l_shipdate").cast("date").alias("day")).agg(
        F.sum(F.col("l_extendedprice").cast("decimal(12,2)")).alias("amount")
    )
    so_far = Window.partitionBy("l_suppkey", F.year("day")).orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    return daily.withColumn("year_to_date", F.sum("amount").over(so_far))


@query(
    "w7_running_count", "claim_type string, year_month string, months_so_far bigint",
    """SELECT claim_type, year_month, count(*) OVER (PARTITION BY claim_type ORDER BY year_month
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS months_so_far
       FROM (SELECT DISTINCT claim_type, year_month FROM fact)""",
)
def w7(spark, folder):
    """Months seen so far per claim type."""
    tables = loaded(spark, folder).tables
    keys = tables["fact_claim"].select("claim_type", "service_date_key").distinct()
    months = analytics._with_day(keys, tables["dim_date"], "year_month").select("claim_type", "year_month").distinct()
    so_far = Window.partitionBy("claim_type").orderBy("year_month").rowsBetween(Window.unboundedPreceding, 0)
    return months.withColumn("months_so_far", F.count(F.lit(1)).over(so_far))


@query(
    "w8_running_mean", "year_number bigint, mean double, running_mean double",
    "SELECT year_number, CAST(mean AS DOUBLE) / 100 AS mean, "
    + ratio("sum(mean) OVER w", "100 * count(*) OVER w", 2)
    + " AS running_mean FROM (SELECT year_number, CAST("
    + ratio("sum(total_paid) * 100", "count(*)", 0)
    + " AS BIGINT) AS mean FROM fact GROUP BY 1) WINDOW w AS (ORDER BY year_number ROWS UNBOUNDED PRECEDING)",
)
def w8(spark, folder):
    """Mean of the yearly means so far, each mean rounded before."""
    tables = loaded(spark, folder).tables
    yearly = analytics._with_day(tables["fact_claim"], tables["dim_date"], "year_number").groupBy("year_number").agg(
        F.round(F.sum("total_paid") / F.count(F.lit(1)), 2).cast("decimal(18,2)").alias("mean")
    )
    so_far = Window.orderBy("year_number").rowsBetween(Window.unboundedPreceding, 0)
    return yearly.withColumn("running_mean", fx.average_over(F.col("mean"), so_far, 2))


@query(
    "w9_moving_mean", "year_month string, orders bigint, mean double",
    "SELECT year_month, orders, " + ratio("sum(orders) OVER w", "count(*) OVER w", 2)
    + """ AS mean FROM (SELECT strftime(o_orderdate, '%Y-%m') AS year_month, count(*) AS orders FROM orders GROUP BY 1)
        WINDOW w AS (ORDER BY year_month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
)
def w9(spark, folder):
    """Three-row mean, shorter at the start."""
    months = table(spark, folder, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("year_month")).agg(
        F.count(F.lit(1)).alias("orders")
    )
    three = Window.orderBy("year_month").rowsBetween(-2, 0)
    return months.withColumn("mean", fx.average_over(F.col("orders"), three, 2))


# --- O: ordering and set operations ---


@query(
    "o1_order_by_nulls", "position bigint, denial_reason string, claims bigint",
    """SELECT row_number() OVER (ORDER BY denial_reason DESC NULLS FIRST) AS position, denial_reason, claims
       FROM (SELECT denial_reason, count(*) AS claims FROM claims GROUP BY 1)""",
)
def o1(spark, folder):
    """Descending order with nulls first, as the warehouse's users expect it."""
    reasons = loaded(spark, folder).source["claims"].groupBy("denial_reason").agg(F.count(F.lit(1)).alias("claims"))
    order = F.desc_nulls_first("denial_reason")
    return reasons.withColumn("position", F.row_number().over(Window.orderBy(order))).orderBy(order)


@query(
    "o2_top_k", "l_suppkey bigint, revenue money",
    """SELECT l_suppkey, sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS revenue FROM lineitem
       GROUP BY 1 ORDER BY revenue DESC, l_suppkey LIMIT 20""",
)
def o2(spark, folder):
    """Twenty best suppliers in a total order."""
    return table(spark, folder, "lineitem").groupBy("l_suppkey").agg(
        F.sum(F.col("l_extendedprice").cast("decimal(12,2)")).alias("revenue")
    ).orderBy(F.desc("revenue"), "l_suppkey").limit(20)


@query(
    "o3_limit_one_evidence", "found bigint",
    "SELECT count(*) AS found FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1 LIMIT 1)",
)
def o3(spark, folder):
    """One offending key is evidence enough."""
    bad = duplicate_keys(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"]).limit(1)
    return bad.agg(F.count(F.lit(1)).alias("found"))


@query(
    "o4_union_all", "origin string, nation bigint",
    """SELECT 'customer' AS origin, c_nationkey AS nation FROM customer
       UNION ALL SELECT 'supplier', s_nationkey FROM supplier""",
)
def o4(spark, folder):
    """Two tables stacked, duplicates kept."""
    customers = table(spark, folder, "customer").select(F.lit("customer").alias("origin"), F.col("c_nationkey").alias("nation"))
    suppliers = table(spark, folder, "supplier").select(F.lit("supplier").alias("origin"), F.col("s_nationkey").alias("nation"))
    return customers.unionByName(suppliers)


@query(
    "o5_except", "nation bigint, segment string",
    """SELECT c_nationkey AS nation, c_mktsegment AS segment FROM customer
       EXCEPT SELECT c_nationkey, c_mktsegment FROM customer JOIN orders ON o_custkey = c_custkey
       WHERE o_totalprice > 495000""",
)
def o5(spark, folder):
    """Distinct rows of one relation that the other lacks."""
    customers = table(spark, folder, "customer").select("c_custkey", F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"))
    dear = table(spark, folder, "orders").filter("o_totalprice > 495000").select(F.col("o_custkey").alias("c_custkey"))
    return customers.select("nation", "segment").subtract(customers.join(dear, "c_custkey").select("nation", "segment"))


# --- F: functions ---


@query(
    "f1_round_half_away", "l_orderkey bigint, l_linenumber bigint, l_partkey bigint, l_suppkey bigint, tenth double",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
               {ratio(cents("CAST(l_extendedprice - 20000 AS DECIMAL(12,2))"), "100", 1)} AS tenth FROM lineitem""",
)
def f1(spark, folder):
    """Halves round away from zero on both sides of it."""
    shifted = (F.col("l_extendedprice") - 20000).cast("decimal(12,2)")
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round(shifted, 1).alias("tenth")
    )


@query(
    "f2_extract",
    "o_orderkey bigint, year_number bigint, quarter_number bigint, month_number bigint, day_of_month bigint, "
    "day_of_week bigint, week_of_year bigint, is_weekend boolean",
    """SELECT o_orderkey, year(d) AS year_number, quarter(d) AS quarter_number, month(d) AS month_number,
              day(d) AS day_of_month, isodow(d) AS day_of_week, weekofyear(d) AS week_of_year,
              isodow(d) >= 6 AS is_weekend
       FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""",
)
def f2(spark, folder):
    """Parts of a date; weeks and weekdays follow ISO."""
    parts = fx.calendar_attributes(F.col("o_orderdate").cast("date"))
    return table(spark, folder, "orders").select("o_orderkey", *[v.alias(k) for k, v in parts.items()])


@query(
    "f3_format_date", "o_orderkey bigint, month_name string, day_name string, year_month string",
    """SELECT o_orderkey, monthname(o_orderdate) AS month_name, dayname(o_orderdate) AS day_name,
              strftime(o_orderdate, '%Y-%m') AS year_month FROM orders""",
)
def f3(spark, folder):
    """Month and day names and the month label."""
    parts = fx.calendar_attributes(F.col("o_orderdate").cast("date"))
    return table(spark, folder, "orders").select("o_orderkey", *[v.alias(k) for k, v in parts.items()])


@query(
    "f4_date_arithmetic", "o_orderkey bigint, later date, earlier date, days bigint",
    """SELECT o_orderkey, d + CAST(o_orderkey % 300 AS INTEGER) AS later, d - 1 AS earlier,
              date_diff('day', DATE '1995-01-01', d) AS days
       FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""",
)
def f4(spark, folder):
    """Dates moved by days, and days between dates."""
    day = F.col("o_orderdate").cast("date")
    return table(spark, folder, "orders").select(
        "o_orderkey", fx.day_shift(day, F.col("o_orderkey") % 300).alias("later"), fx.day_shift(day, -1).alias("earlier"),
        fx.days_between(day, F.lit(date(1995, 1, 1))).alias("days"),
    )


@query(
    "f5_string_functions", "c_custkey bigint, middle string, padded string, head string, joined string",
    """SELECT c_custkey, substr(c_name, 10, 5) AS middle, lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS padded,
              left(c_mktsegment, 3) AS head, c_name || '/' || c_mktsegment AS joined FROM customer""",
)
def f5(spark, folder):
    """Substring, padding, prefix and concatenation."""
    name = F.col("c_name")
    return table(spark, folder, "customer").select(
        "c_custkey", F.substring(name, 10, 5).alias("middle"),
        F.lpad(F.col("c_custkey").cast("string"), 10, "0").alias("padded"),
        F.left("c_mktsegment", F.lit(3)).alias("head"), F.concat(name, F.lit("/"), "c_mktsegment").alias("joined"),
    )


@query(
    "f6_integer_arithmetic", "o_orderkey bigint, remainder bigint, quotient bigint, root bigint, typed bigint",
    """SELECT o_orderkey, o_orderkey % 18 AS remainder, CAST(trunc((o_orderkey - 7500) / 18.0) AS BIGINT) AS quotient,
              floor(pow(o_orderkey, 0.5)) AS root, CAST(o_orderdate AS DATE) - DATE '1970-01-01' AS typed FROM orders""",
)
def f6(spark, folder):
    """Remainder, truncating division, power and floor, casts."""
    key = F.col("o_orderkey")
    return table(spark, folder, "orders").select(
        "o_orderkey", (key % 18).alias("remainder"), F.expr("(o_orderkey - 7500) div 18").alias("quotient"),
        F.floor(F.pow(key, F.lit(0.5))).alias("root"),
        F.unix_date(F.col("o_orderdate").cast("date")).alias("typed"),
    )


@query(
    "f7_array_index", "c_custkey bigint, first_name string",
    "SELECT c_custkey, list_extract([" + ", ".join(f"'{n}'" for n in fv.FIRST_NAMES)
    + "], CAST(1 + c_custkey % 12 AS INTEGER)) AS first_name FROM customer",
)
def f7(spark, folder):
    """Element of a literal list, counted from one."""
    return table(spark, folder, "customer").select(
        "c_custkey", fx.pick(fv.FIRST_NAMES, 1 + F.col("c_custkey") % 12).alias("first_name")
    )


@query(
    "f8_seeded_draw", "o_orderkey bigint, draw double",
    """SELECT o_orderkey, CAST(CAST('0x' || substr(md5('0.42:' || CAST(o_orderkey AS VARCHAR)), 1, 12) AS BIGINT) AS DOUBLE)
              / 281474976710656 AS draw FROM orders""",
)
def f8(spark, folder):
    """A repeatable draw per row."""
    return table(spark, folder, "orders").select("o_orderkey", fx.hash_uniform("0.42", F.col("o_orderkey")).alias("draw"))


@query(
    "f9_run_timestamp", "rows bigint, stamps bigint",
    "SELECT count(*) AS rows, 1 AS stamps FROM fact",
)
def f9(spark, folder):
    """All rows of a run carry one time."""
    return loaded(spark, folder).tables["fact_claim"].agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("loaded_at").alias("stamps")
    )


# --- U: routines ---

_CODE = (
    "substr('ABCDEFGHIJKLMNOPQR', CAST(1 + (p_partkey % 18) AS INTEGER), 1) || "
    "lpad(CAST((p_partkey // 18) % 100 AS VARCHAR), 2, '0') || '.' || "
    "lpad(CAST(p_partkey // 18 AS VARCHAR), CAST(greatest(3, length(CAST(p_partkey // 18 AS VARCHAR))) AS INTEGER), '0')"
)


@query("u1_make_diagnosis_code", "p_partkey bigint, code string", f"SELECT p_partkey, {_CODE} AS code FROM part")
def u1(spark, folder):
    """Synthetic diagnosis code of a number."""
    return table(spark, folder, "part").select("p_partkey", fx.make_diagnosis_code(F.col("p_partkey") + 1).alias("code"))


@query(
    "u2_diagnosis_chapter", "chapter string, parts bigint",
    "SELECT coalesce(name, '" + fv.CHAPTERS["R"] + f"') AS chapter, count(*) AS parts FROM (SELECT left({_CODE}, 1) AS l FROM part) "
    "LEFT JOIN (VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in fv.CHAPTERS.items()) + ") AS c(letter, name) ON letter = l GROUP BY 1",
)
def u2(spark, folder):
    """Chapter names of the codes."""
    letter = F.left(fx.make_diagnosis_code(F.col("p_partkey") + 1), F.lit(1))
    return table(spark, folder, "part").groupBy(fx.diagnosis_chapter(letter).alias("chapter")).agg(
        F.count(F.lit(1)).alias("parts")
    )
