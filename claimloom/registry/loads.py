"""Keys, dimension loads, fact loads, dead letters, marks and the ledger."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom import fixed_values as fv
from claimloom import schemas
from claimloom.operators import dimensions, facts, ledger, scd2
from claimloom.operators.constraints import not_one_current
from claimloom.operators.keys import assign_keys
from claimloom.plans.load import DIMENSIONS
from claimloom.registry.base import loaded, query
from claimloom.registry.mapping import calendar, event_history, table
from claimloom.session import cut_lineage

_RUN = datetime(2026, 1, 1)


def _one_count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


# --- K, D: keys and dimensions ---


@query(
    "k1_assign_keys", "rows bigint, first_key bigint, last_key bigint, keys bigint, orders bigint",
    """SELECT count(*) AS rows, 101 AS first_key, 100 + count(*) AS last_key, count(*) AS keys,
              count(DISTINCT o_orderkey) AS orders FROM orders""",
)
def k1(spark, folder):
    """Numbers start after the last one and have no gaps or repeats."""
    keyed = assign_keys(table(spark, folder, "orders").select("o_orderkey"), "key", ["o_orderkey"], 100)
    return keyed.agg(
        F.count(F.lit(1)).alias("rows"), F.min("key").alias("first_key"), F.max("key").alias("last_key"),
        F.count_distinct("key").alias("keys"), F.count_distinct("o_orderkey").alias("orders"),
    )


@query(
    "d1_seed_unknown", "table_name string, before bigint, unknown_rows bigint, after_second bigint",
    """SELECT 'dim_plan' AS table_name, (SELECT count(*) FROM plan_types) AS before, 1 AS unknown_rows,
              (SELECT count(*) + 1 FROM plan_types) AS after_second
       UNION ALL SELECT 'dim_diagnosis', (SELECT count(*) FROM codes), 1, (SELECT count(*) + 1 FROM codes)
       UNION ALL SELECT 'dim_procedure', (SELECT count(*) FROM codes), 1, (SELECT count(*) + 1 FROM codes)
       UNION ALL SELECT 'dim_date', (SELECT count(*) FROM calendar), 1, (SELECT count(*) + 1 FROM calendar)
       UNION ALL SELECT 'dim_member', (SELECT count(*) FROM dim_member), 1, (SELECT count(*) + 1 FROM dim_member)
       UNION ALL SELECT 'dim_provider', (SELECT count(*) FROM dim_provider), 1, (SELECT count(*) + 1 FROM dim_provider)""",
)
def d1(spark, folder):
    """The placeholder row is added where it is missing, and only there."""
    tables = loaded(spark, folder).tables
    parts = []
    for name in DIMENSIONS:
        key = F.col(dimensions.key_of(name))
        bare = dimensions.real_rows(tables[name], name)
        seeded = dimensions.seed_unknown(bare, name)
        again = dimensions.seed_unknown(seeded, name)
        parts.append(
            again.agg(F.count_if(key == -1).alias("unknown_rows"), F.count(F.lit(1)).alias("after_second")).select(
                F.lit(name).alias("table_name"), _one_count(bare, "n").scalar().alias("before"), "*"
            )
        )
    return reduce(DataFrame.unionByName, parts)


@query(
    "d2_load_dim_date",
    "calendar_date date, year_number bigint, quarter_number bigint, month_number bigint, month_name string, "
    "day_of_month bigint, day_of_week bigint, day_name string, week_of_year bigint, is_weekend boolean, "
    "year_month string, orders bigint",
    """SELECT calendar_date, year_number, quarter(calendar_date) AS quarter_number, month(calendar_date) AS month_number,
              monthname(calendar_date) AS month_name, day(calendar_date) AS day_of_month,
              isodow(calendar_date) AS day_of_week, dayname(calendar_date) AS day_name,
              weekofyear(calendar_date) AS week_of_year, isodow(calendar_date) >= 6 AS is_weekend, year_month,
              coalesce(n, 0) AS orders
       FROM calendar LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 1)
            ON d = calendar_date""",
)
def d2(spark, folder):
    """The calendar loaded in two overlapping runs, with the orders of each day."""
    start, end = calendar(spark, folder).days
    half = dimensions.load_dim_date(schemas.empty(spark, "dim_date"), start, start + (end - start) / 2)
    whole = dimensions.real_rows(dimensions.load_dim_date(half, start, end), "dim_date")
    orders = table(spark, folder, "orders").groupBy(F.col("o_orderdate").cast("date").alias("calendar_date")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return whole.join(orders, "calendar_date", "left").withColumn("orders", F.coalesce("n", F.lit(0)))


def _upserted(spark, folder: str, name: str, source: str, natural: str, attribute: str, kept: str) -> DataFrame:
    """Load two thirds of a catalog with an old attribute, then all rows but every fifth."""
    rows = loaded(spark, folder).source[source]
    first = rows.filter(f"{kept} % 3 <> 0").withColumn(attribute, F.lit("old"))
    second = rows.filter(f"{kept} % 5 <> 0")
    once = cut_lineage(dimensions.upsert_type1(schemas.empty(spark, name), first, name, natural))
    twice = dimensions.upsert_type1(once, second, name, natural)
    key = dimensions.key_of(name)
    moved = once.select(F.col(natural).alias("_n"), F.col(key).alias("_key"))
    joined = dimensions.real_rows(twice, name).join(moved, F.col(natural) == F.col("_n"), "left")
    return joined.withColumn("key_kept", F.col("_key").isNull() | (F.col("_key") == F.col(key)))


def _upsert_sql(source: str, natural: str, attribute: str, kept: str) -> str:
    return f"""SELECT {natural}, CASE WHEN {kept} % 5 <> 0 THEN {attribute} ELSE 'old' END AS {attribute}, TRUE AS key_kept
               FROM {source} WHERE {kept} % 3 <> 0 OR {kept} % 5 <> 0"""


@query(
    "d3_upsert_plan", "plan_id bigint, plan_name string, key_kept boolean",
    _upsert_sql("plan_types", "plan_id", "plan_name", "plan_id"),
)
def d3_plan(spark, folder):
    """Known plans are overwritten in place, new ones added, vanished ones kept."""
    return _upserted(spark, folder, "dim_plan", "plan_types", "plan_id", "plan_name", "plan_id")


@query(
    "d3_upsert_diagnosis", "diagnosis_code string, category_name string, key_kept boolean",
    _upsert_sql("(SELECT code AS diagnosis_code, category_name FROM codes)", "diagnosis_code", "category_name",
                "CAST(diagnosis_code AS BIGINT)"),
)
def d3_diagnosis(spark, folder):
    """The same for the diagnosis catalog."""
    return _upserted(
        spark, folder, "dim_diagnosis", "diagnosis_codes", "diagnosis_code", "category_name",
        "try_cast(diagnosis_code as bigint)",
    )


@query(
    "d3_upsert_procedure", "procedure_code string, description string, key_kept boolean",
    _upsert_sql("(SELECT code AS procedure_code, description FROM codes)", "procedure_code", "description",
                "CAST(procedure_code AS BIGINT)"),
)
def d3_procedure(spark, folder):
    """The same for the procedure catalog."""
    return _upserted(
        spark, folder, "dim_procedure", "procedure_codes", "procedure_code", "description",
        "try_cast(procedure_code as bigint)",
    )


@query(
    "d4_member_history", "history_id bigint, member_id bigint, first_name string, enrollment_date date, version_rank bigint",
    """SELECT history_id, member_id, first_name, enrollment_date,
              row_number() OVER (PARTITION BY member_id ORDER BY effective_start, history_id) AS version_rank
       FROM member_history JOIN (SELECT member_id, first_name, enrollment_date FROM members) USING (member_id)""",
)
def d4_member(spark, folder):
    """Member history with stable attributes and rank."""
    source = loaded(spark, folder).source
    return scd2.member_history(source["member_plan_history"], source["members"])


@query(
    "d4_provider_history", "history_id bigint, provider_id bigint, provider_name string, city string, version_rank bigint",
    """SELECT history_id, provider_id, provider_name, city,
              row_number() OVER (PARTITION BY provider_id ORDER BY effective_start, history_id) AS version_rank
       FROM provider_history JOIN (SELECT provider_id, provider_name, city FROM providers) USING (provider_id)""",
)
def d4_provider(spark, folder):
    """Provider history with stable attributes and rank."""
    source = loaded(spark, folder).source
    return scd2.provider_history(source["provider_network_history"], source["providers"])


@query(
    "d5_scd2_member",
    "member_id bigint, plan_id bigint, state string, zip_code string, first_name string, enrollment_date date, "
    "effective_start date, effective_end date, is_current boolean",
    "SELECT * FROM dim_member",
)
def d5_member(spark, folder):
    """Member versions of the whole history."""
    source = loaded(spark, folder).source
    plans = dimensions.load_dim_plan(schemas.empty(spark, "dim_plan"), source["plan_types"])
    dim = scd2.load_dim_member(
        schemas.empty(spark, "dim_member"), source["member_plan_history"], source["members"], plans
    )
    return dimensions.real_rows(dim, "dim_member")


@query(
    "d5_scd2_provider",
    "provider_id bigint, network_status string, specialty string, network_effective_date date, provider_name string, "
    "effective_start date, effective_end date, is_current boolean",
    "SELECT * FROM dim_provider",
)
def d5_provider(spark, folder):
    """Provider versions, applied in two runs: the second closes versions the first left open."""
    source = loaded(spark, folder).source
    history, providers = source["provider_network_history"], source["providers"]
    early = history.filter("effective_start < date'1997-03-01'")
    once = cut_lineage(scd2.load_dim_provider(schemas.empty(spark, "dim_provider"), early, providers))
    return dimensions.real_rows(scd2.load_dim_provider(once, history, providers), "dim_provider")


# reads each user's events in order and carries the open version from row to row
_EVENT_FOLD = """
    WITH RECURSIVE ordered AS (
        SELECT user_id, event_type, CAST(ts AS DATE) AS day,
               row_number() OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE), ts, event_id) AS n FROM events),
    walk AS (
        SELECT user_id, n, day AS open_day, event_type AS open_type, TRUE AS opened FROM ordered WHERE n = 1
        UNION ALL
        SELECT o.user_id, o.n,
               CASE WHEN o.day > w.open_day AND o.event_type <> w.open_type THEN o.day ELSE w.open_day END,
               CASE WHEN o.day > w.open_day AND o.event_type <> w.open_type THEN o.event_type ELSE w.open_type END,
               o.day > w.open_day AND o.event_type <> w.open_type
        FROM walk w JOIN ordered o ON o.user_id = w.user_id AND o.n = w.n + 1)
    SELECT user_id, open_type AS event_type, open_day AS effective_start,
           coalesce(lead(open_day) OVER (PARTITION BY user_id ORDER BY open_day) - 1, DATE '9999-12-31') AS effective_end,
           lead(open_day) OVER (PARTITION BY user_id ORDER BY open_day) IS NULL AS is_current
    FROM walk WHERE opened"""


@query(
    "d5_scd2_events",
    "user_id bigint, event_type string, effective_start date, effective_end date, is_current boolean",
    _EVENT_FOLD,
)
def d5_events(spark, folder):
    """Versions of an event type per user, where many rows of a user share a start day."""
    return scd2.fold_history(event_history(spark, folder), "user_id", ["event_type"])


@query(
    "d5_scd2_events_incremental",
    "user_id bigint, event_type string, effective_start date, effective_end date, is_current boolean",
    _EVENT_FOLD,
)
def d5_events_incremental(spark, folder):
    """The same versions from two runs, the second starting from the versions left open."""
    history = event_history(spark, folder)
    first = scd2.fold_history(history.filter("effective_start < date'2024-01-15'"), "user_id", ["event_type"])
    second = scd2.fold_history(history, "user_id", ["event_type"], opened=first.filter("is_current"))
    return first.filter("not is_current").unionByName(second)


_CURRENT_SQL = "SELECT {key} FROM dim_{name} GROUP BY 1 HAVING count(*) FILTER (WHERE {current}) <> 1"
_PLANTED_CURRENT = "({key} % 3 = 0 OR is_current) AND {key} % 7 <> 0"


@query(
    "d6_one_current", "table_name string, planted boolean, keys bigint",
    " UNION ALL ".join(
        f"SELECT 'dim_{name}' AS table_name, {planted} AS planted, count(*) AS keys FROM ("
        + _CURRENT_SQL.format(key=key, name=name, current=current.format(key=key)) + ")"
        for name, key in (("member", "member_id"), ("provider", "provider_id"))
        for planted, current in (("FALSE", "is_current"), ("TRUE", _PLANTED_CURRENT))
    ),
)
def d6(spark, folder):
    """Keys without exactly one current version, as loaded and with flags planted wrong by key."""
    parts = []
    for table, key in (("dim_member", "member_id"), ("dim_provider", "provider_id")):
        dim = dimensions.real_rows(loaded(spark, folder).tables[table], table)
        for planted, rows in ((False, dim), (True, dim.withColumn("is_current", F.expr(_PLANTED_CURRENT.format(key=key))))):
            parts.append(_one_count(not_one_current(rows, key), "keys").select(
                F.lit(table).alias("table_name"), F.lit(planted).alias("planted"), "keys"
            ))
    return reduce(DataFrame.unionByName, parts)


@query(
    "d7_version_overlap", "provider_id bigint",
    """SELECT DISTINCT a.provider_id FROM provider_history a JOIN provider_history b
       ON a.provider_id = b.provider_id AND a.history_id < b.history_id
       AND a.effective_start <= coalesce(b.effective_end, DATE '9999-12-31')
       AND b.effective_start <= coalesce(a.effective_end + 30, DATE '9999-12-31')""",
)
def d7(spark, folder):
    """Providers whose source ranges overlap once each closed range is made 30 days longer."""
    history = loaded(spark, folder).source["provider_network_history"]
    end = F.coalesce(F.date_add("effective_end", 30), F.lit(fv.OPEN_END).cast("date"))
    return scd2.overlapping_versions(history.withColumn("effective_end", end), "provider_id")


# --- L: fact loads ---


def _batch(spark, folder: str) -> DataFrame:
    """All claims resolved against the loaded dimensions, as if none were on the fact yet."""
    data = loaded(spark, folder)
    return facts.resolve_claims(
        data.source["claims"], data.source["claim_lines"], data.tables, schemas.empty(spark, "fact_claim")
    )


@query(
    "l1_resolve_claims",
    "claim_id bigint, member_since date, provider_since date, plan_id bigint, diagnosis_code string, "
    "service_date date, processed_date date, line_count bigint, reject_reason string",
    f"""SELECT claim_id, member_since, provider_since, plan_id, coalesce(known_diagnosis, 'N/A') AS diagnosis_code,
               CASE WHEN service_date BETWEEN (SELECT first_day FROM extent) AND (SELECT last_day FROM extent) THEN service_date END
                   AS service_date, processed_date, line_count, reject_reason FROM batch""",
)
def l1(spark, folder):
    """Every claim with its version and code keys turned back into natural ones."""
    tables = loaded(spark, folder).tables
    natural = _batch(spark, folder)
    for name, columns in (
        ("dim_member", ["effective_start as member_since"]), ("dim_provider", ["effective_start as provider_since"]),
        ("dim_plan", ["plan_id"]), ("dim_diagnosis", ["diagnosis_code"]),
    ):
        key = dimensions.key_of(name)
        natural = natural.join(tables[name].selectExpr(key, *columns), key, "left")
    days = tables["dim_date"].selectExpr("date_key as service_date_key", "calendar_date as service_date")
    return natural.join(days, "service_date_key", "left")


@query(
    "l2_split_rejects", "accepted bigint, rejected bigint, accepted_paid money",
    """SELECT count(*) FILTER (WHERE reject_reason IS NULL) AS accepted,
              count(*) FILTER (WHERE reject_reason IS NOT NULL) AS rejected,
              sum(total_paid) FILTER (WHERE reject_reason IS NULL) AS accepted_paid FROM batch""",
)
def l2(spark, folder):
    """Claims that can load and claims that cannot."""
    accepted, rejected = facts.split_rejects(_batch(spark, folder))
    return accepted.agg(F.count(F.lit(1)).alias("accepted"), F.sum("total_paid").alias("accepted_paid")).select(
        "accepted", _one_count(rejected, "n").scalar().alias("rejected"), "accepted_paid"
    )


@query(
    "l3_replace_dead_letters", "pipeline_name string, source_key string, reject_reason string",
    f"""SELECT pipeline_name, source_key, reject_reason FROM letters WHERE pipeline_name = '{fv.CLAIM_PIPELINE}'
        UNION ALL SELECT '{fv.LINE_PIPELINE}', CAST(o_orderkey AS VARCHAR), 'earlier' FROM orders WHERE o_orderkey % 500 < 3
        UNION ALL SELECT '{fv.CLAIM_PIPELINE}', CAST(o_orderkey + 1000000000000 AS VARCHAR), 'earlier'
        FROM orders WHERE o_orderkey % 500 < 3""",
)
def l3(spark, folder):
    """Earlier letters of retried claims give way; other pipelines' and vanished claims' stay."""
    batch = _batch(spark, folder)
    old = table(spark, folder, "orders").filter("o_orderkey % 500 < 3").selectExpr(
        "explode(array(struct('fact_claim' as pipeline_name, o_orderkey as k), "
        "struct('fact_claim_line' as pipeline_name, o_orderkey as k), "
        "struct('fact_claim' as pipeline_name, o_orderkey + 1000000000000 as k))) as v"
    ).selectExpr("v.pipeline_name", "cast(v.k as string) as source_key", "'earlier' as reject_reason")
    kept = facts.retained_dead_letters(old, batch)
    current = facts.claim_dead_letters(batch, _RUN).select(*kept.columns)
    return kept.unionByName(current)


@query(
    "l4_insert_fact_claim",
    "claim_id bigint, claim_status string, total_allowed money, total_paid money, member_responsibility money, line_count bigint",
    """SELECT claim_id, claim_status, total_allowed, total_paid, line_count,
              CASE WHEN claim_status = 'Denied' THEN 0 WHEN total_allowed < total_paid THEN 0
                   ELSE total_allowed - total_paid END AS member_responsibility FROM fact""",
)
def l4(spark, folder):
    """Accepted claims with the member's share."""
    return facts.claim_facts(_batch(spark, folder), _RUN)


@query(
    "l5_advance_watermark", "pipeline_name string, high_water_mark date, rows_loaded bigint",
    f"""SELECT '{fv.CLAIM_PIPELINE}' AS pipeline_name, max(processed_date) AS high_water_mark,
               count(*) FILTER (WHERE reject_reason IS NULL) AS rows_loaded FROM batch""",
)
def l5(spark, folder):
    """The mark after two batches; the second is older and may not pull it back."""
    batch = _batch(spark, folder).select("processed_date", "reject_reason")
    split = F.lit("1999-01-01").cast("date")
    recent = facts.advance_watermark(schemas.empty(spark, "etl_watermark"), batch.filter(F.col("processed_date") >= split), _RUN)
    return facts.advance_watermark(recent, batch.filter(F.col("processed_date") < split), _RUN)


def _header_letters(spark, folder: str) -> DataFrame:
    return loaded(spark, folder).tables["etl_dead_letter"].filter(F.col("pipeline_name") == fv.CLAIM_PIPELINE)


@query(
    "l6_insert_fact_claim_line",
    "claim_id bigint, line_number bigint, source_procedure_code string, procedure_code string, diagnosis_code string, "
    "member_since date, provider_since date, service_date date, paid_amount money",
    """SELECT l.claim_id, l.line_number, l.procedure_code AS source_procedure_code, coalesce(p.code, 'N/A') AS procedure_code,
              coalesce(d.code, 'N/A') AS diagnosis_code, l.member_since, l.provider_since, l.service_date, l.paid_amount
       FROM fact_line l LEFT JOIN codes p ON p.code = l.procedure_code LEFT JOIN codes d ON d.code = l.diagnosis_code""",
)
def l6(spark, folder):
    """Lines placed under their header's versions, all lines tried afresh."""
    data = loaded(spark, folder)
    tables = data.tables
    batch = facts.resolve_lines(
        data.source["claim_lines"], tables, tables["fact_claim"], schemas.empty(spark, "fact_claim_line"),
        _header_letters(spark, folder),
    )
    natural = facts.line_facts(batch, _RUN)
    for name, columns in (
        ("dim_member", ["effective_start as member_since"]), ("dim_provider", ["effective_start as provider_since"]),
        ("dim_procedure", ["procedure_code"]), ("dim_diagnosis", ["diagnosis_code"]),
    ):
        key = dimensions.key_of(name)
        natural = natural.join(tables[name].selectExpr(key, *columns), key)
    days = tables["dim_date"].selectExpr("date_key as service_date_key", "calendar_date as service_date")
    return natural.join(days, "service_date_key")


@query(
    "l7_line_dead_letters", "claim_line_id bigint, reject_reason string",
    f"""SELECT claim_line_id, CASE
               WHEN f.claim_id IS NULL AND b.reject_reason IS NOT NULL AND b.claim_id % 2 = 0
                    THEN '{fv.HEADER_REJECTED}' || b.reject_reason
               WHEN f.claim_id IS NULL THEN '{fv.NO_HEADER}'
               WHEN c.calendar_date IS NULL THEN '{fv.NO_SERVICE_DATE}' ELSE '{fv.NOT_PLACED}' END AS reject_reason
        FROM lines l LEFT JOIN fact f ON f.claim_id = l.claim_id AND f.claim_id % 100 <> 7
        LEFT JOIN batch b ON b.claim_id = l.claim_id LEFT JOIN calendar c ON c.calendar_date = l.service_date
        WHERE NOT EXISTS (SELECT 1 FROM fact_line p WHERE p.claim_line_id = l.claim_line_id AND l.claim_id % 100 <> 7
                          AND l.line_number % 50 <> 2)""",
)
def l7(spark, folder):
    """Reasons of unplaced lines, in a warehouse that lost headers, header letters and lines."""
    data = loaded(spark, folder)
    tables = data.tables
    headers = tables["fact_claim"].filter("claim_id % 100 <> 7")
    placed = tables["fact_claim_line"].filter("claim_id % 100 <> 7 and line_number % 50 <> 2")
    letters = _header_letters(spark, folder).filter("cast(source_key as bigint) % 2 = 0")
    found = facts.line_dead_letters(data.source["claim_lines"], tables["dim_date"], headers, placed, letters, _RUN)
    return found.withColumn("claim_line_id", F.col("source_key").cast("bigint"))


@query(
    "l8_line_watermark", "pipeline_name string, high_water_mark date, rows_loaded bigint",
    f"""SELECT '{fv.CLAIM_PIPELINE}' AS pipeline_name, max(processed_date) AS high_water_mark,
               count(*) FILTER (WHERE reject_reason IS NULL) AS rows_loaded FROM batch
        UNION ALL SELECT '{fv.LINE_PIPELINE}', (SELECT max(processed_date) FROM batch), (SELECT count(*) FROM fact_line)""",
)
def l8(spark, folder):
    """The marks of the load: lines copy the claim mark."""
    return loaded(spark, folder).tables["etl_watermark"]


@query(
    "l9_run_etl", "table_name string, rows bigint",
    """SELECT 'dim_date' AS table_name, (SELECT count(*) + 1 FROM calendar) AS rows
       UNION ALL SELECT 'dim_plan', (SELECT count(*) + 1 FROM plan_types)
       UNION ALL SELECT 'dim_diagnosis', (SELECT count(*) + 1 FROM codes)
       UNION ALL SELECT 'dim_procedure', (SELECT count(*) + 1 FROM codes)
       UNION ALL SELECT 'dim_member', (SELECT count(*) + 1 FROM dim_member)
       UNION ALL SELECT 'dim_provider', (SELECT count(*) + 1 FROM dim_provider)
       UNION ALL SELECT 'fact_claim', (SELECT count(*) FROM fact)
       UNION ALL SELECT 'fact_claim_line', (SELECT count(*) FROM fact_line)
       UNION ALL SELECT 'etl_dead_letter', (SELECT count(*) FROM letters)
       UNION ALL SELECT 'etl_watermark', 2""",
)
def l9(spark, folder):
    """Rows of every table the load publishes."""
    tables = loaded(spark, folder).tables
    names = [*DIMENSIONS, "fact_claim", "fact_claim_line", "etl_dead_letter", "etl_watermark"]
    return reduce(
        DataFrame.unionByName,
        [_one_count(tables[n], "rows").select(F.lit(n).alias("table_name"), "rows") for n in names],
    )


@query(
    "u3_dead_letter_log", "pipeline_name string, source_key string, reject_reason string",
    "SELECT pipeline_name, source_key, reject_reason FROM letters",
)
def u3(spark, folder):
    """The whole dead-letter log after the load routines ran in order."""
    return loaded(spark, folder).tables["etl_dead_letter"]


# --- B: ledger ---


@query(
    "b1_claim_disposition", "claim_id bigint, disposition string, reject_reason string",
    """SELECT claim_id, CASE WHEN reject_reason IS NULL THEN 'loaded' WHEN claim_id % 2 = 1 THEN 'unaccounted'
                             ELSE 'rejected' END AS disposition,
              CASE WHEN claim_id % 2 = 0 THEN reject_reason END AS reject_reason FROM batch
       WHERE claim_id % 300 <> 9
       UNION ALL SELECT claim_id, CASE WHEN reject_reason IS NULL THEN 'conflict' WHEN claim_id % 2 = 1 THEN 'rejected'
                                       ELSE 'rejected' END, coalesce(reject_reason, 'planted')
       FROM batch WHERE claim_id % 300 = 9""",
)
def b1(spark, folder):
    """Outcome of every claim after letters were lost for odd claims and added for some loaded ones."""
    data = loaded(spark, folder)
    claims = data.source["claims"]
    letters = data.tables["etl_dead_letter"]
    kept = letters.filter("cast(source_key as bigint) % 2 = 0 or cast(source_key as bigint) % 300 = 9")
    added = data.tables["fact_claim"].filter("claim_id % 300 = 9").selectExpr(
        "claim_id as dead_letter_id", "'fact_claim' as pipeline_name", "'source.claims' as source_table",
        "cast(claim_id as string) as source_key", "'planted' as reject_reason", "loaded_at as rejected_at",
    )
    return ledger.claim_disposition(claims, data.tables["fact_claim"], kept.unionByName(added))


@query(
    "b2_claim_line_disposition", "claim_line_id bigint, disposition string, reject_reason string",
    f"""SELECT l.claim_line_id, CASE WHEN l.reject_reason IS NULL AND l.claim_id % 200 = 9 THEN 'conflict'
                    WHEN l.reject_reason IS NULL THEN 'loaded'
                    WHEN l.claim_line_id % 3 <> 0 THEN 'rejected'
                    WHEN b.reject_reason IS NOT NULL OR l.claim_id % 200 = 9 THEN 'held_with_header' ELSE 'unaccounted' END AS disposition,
               coalesce(CASE WHEN l.claim_line_id % 3 <> 0 THEN l.reject_reason END, b.reject_reason,
                        CASE WHEN l.claim_id % 200 = 9 THEN 'planted' END) AS reject_reason
        FROM line_batch l JOIN batch b USING (claim_id)""",
)
def b2(spark, folder):
    """Outcome of every line after line letters were lost and header letters added to loaded claims."""
    data = loaded(spark, folder)
    letters = data.tables["etl_dead_letter"]
    kept = letters.filter(
        (F.col("pipeline_name") == fv.CLAIM_PIPELINE) | (F.col("source_key").cast("bigint") % 3 != 0)
    )
    added = data.tables["fact_claim"].filter("claim_id % 200 = 9").selectExpr(
        "claim_id as dead_letter_id", "'fact_claim' as pipeline_name", "'source.claims' as source_table",
        "cast(claim_id as string) as source_key", "'planted' as reject_reason", "loaded_at as rejected_at",
    )
    return ledger.claim_line_disposition(
        data.source["claim_lines"], data.tables["fact_claim_line"], kept.unionByName(added)
    )


def _history_sql(history: str, dim: str, key: str, tracked: list[str], lost: str) -> str:
    equal = " AND ".join(f"d.{c} IS NOT DISTINCT FROM h.{c}" for c in tracked)
    versions = f"(SELECT * FROM {dim} WHERE NOT ({lost}))"
    return f"""SELECT history_id, CASE
            WHEN EXISTS (SELECT 1 FROM {versions} d WHERE d.{key} = h.{key} AND d.effective_start = h.effective_start)
                THEN 'loaded'
            WHEN EXISTS (SELECT 1 FROM {versions} d WHERE d.{key} = h.{key}
                         AND h.effective_start BETWEEN d.effective_start AND d.effective_end AND {equal})
                THEN 'collapsed' ELSE 'unaccounted' END AS disposition FROM ({history}) h"""


@query(
    "b3_member_history_disposition", "history_id bigint, disposition string",
    _history_sql(
        "SELECT * FROM member_history UNION ALL SELECT history_id + 1000000000000, member_id, plan_id, state, zip_code, "
        "effective_start + 10, effective_end FROM member_history",
        "dim_member", "member_id", ["plan_id", "state", "zip_code"], "member_id % 10 = 4 AND NOT is_current",
    ),
)
def b3(spark, folder):
    """Member history and a copy of it ten days later, with some closed versions lost."""
    data = loaded(spark, folder)
    history = data.source["member_plan_history"]
    later = history.withColumn("history_id", F.col("history_id") + 1_000_000_000_000).withColumn(
        "effective_start", F.date_add("effective_start", 10)
    )
    dim = data.tables["dim_member"].filter("not (member_id % 10 = 4 and not is_current)")
    return ledger.member_history_disposition(history.unionByName(later), dim)


@query(
    "b4_provider_history_disposition", "history_id bigint, disposition string",
    _history_sql(
        "SELECT * FROM provider_history UNION ALL SELECT history_id + 1000000000000, provider_id, network_status, "
        "specialty, effective_start + 10, effective_end, network_effective_date FROM provider_history",
        "dim_provider", "provider_id", ["network_status", "specialty"], "provider_id % 10 = 4 AND NOT is_current",
    ),
)
def b4(spark, folder):
    """The same for providers."""
    data = loaded(spark, folder)
    history = data.source["provider_network_history"]
    later = history.withColumn("history_id", F.col("history_id") + 1_000_000_000_000).withColumn(
        "effective_start", F.date_add("effective_start", 10)
    )
    dim = data.tables["dim_provider"].filter("not (provider_id % 10 = 4 and not is_current)")
    return ledger.provider_history_disposition(history.unionByName(later), dim)


_BALANCE_COLUMNS = (
    "entity string, source_rows bigint, loaded bigint, rejected bigint, held_with_header bigint, collapsed bigint, "
    "conflict bigint, unaccounted bigint, warehouse_only bigint"
)


def _balance_sql(claims: str = "batch", lines: str = "line_batch") -> str:
    whole = [
        ("plan_types", "plan_types"), ("diagnosis_codes", "codes"), ("procedure_codes", "codes"),
        ("members", "members"), ("member_plan_history", "member_history"), ("providers", "providers"),
        ("provider_network_history", "provider_history"),
    ]
    parts = [
        f"SELECT '{name}' AS entity, count(*) AS source_rows, count(*) AS loaded, 0 AS rejected, 0 AS held_with_header, "
        f"0 AS collapsed, 0 AS conflict, 0 AS unaccounted, 0 AS warehouse_only FROM {model}"
        for name, model in whole
    ]
    for name, model in (("claims", claims), ("claim_lines", lines)):
        parts.append(
            f"SELECT '{name}', count(*), count(*) FILTER (WHERE reject_reason IS NULL), "
            f"count(*) FILTER (WHERE reject_reason IS NOT NULL), 0, 0, 0, 0, 0 FROM {model}"
        )
    return " UNION ALL ".join(parts)


@query("b5_source_balance", _BALANCE_COLUMNS, _balance_sql())
def b5(spark, folder):
    """The ledger of the load."""
    data = loaded(spark, folder)
    return ledger.source_balance(data.source, data.tables)


@query(
    "b6_balance_failures", "entity string, source_rows bigint, loaded bigint, unaccounted bigint, warehouse_only bigint",
    """SELECT 'members' AS entity, count(*) FILTER (WHERE member_id % 10 <> 3) AS source_rows,
              count(*) FILTER (WHERE member_id % 10 <> 3) AS loaded, 0 AS unaccounted,
              count(*) FILTER (WHERE member_id % 10 = 3) AS warehouse_only FROM members
       UNION ALL
       SELECT 'claims', count(*), count(*) FILTER (WHERE reject_reason IS NULL AND claim_id % 10 <> 7),
              count(*) FILTER (WHERE reject_reason IS NULL AND claim_id % 10 = 7), 0 FROM batch""",
)
def b6(spark, folder):
    """Entities that fail the ledger once source members and fact claims are taken away."""
    data = loaded(spark, folder)
    source = {**data.source, "members": data.source["members"].filter("member_id % 10 <> 3")}
    tables = {**data.tables, "fact_claim": data.tables["fact_claim"].filter("claim_id % 10 <> 7")}
    return ledger.balance_failures(ledger.source_balance(source, tables))


