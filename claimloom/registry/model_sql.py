"""The mapped tables and the loaded warehouse as plain SQL, for checking results.

Written from the definitions, not from the Spark plans: versions come from comparing neighbours
(member and provider starts are unique), lookups from plain range joins, ratios from integer
arithmetic. No surrogate keys appear.
"""

from __future__ import annotations

import re

from claimloom import fixed_values as fv
from claimloom.registry.mapping import LINE_ORDER, OFF_CALENDAR


def ratio(numerator: str, denominator: str, places: int) -> str:
    """Quotient of two whole numbers, rounded half away from zero, as a double."""
    top, bottom, unit = f"CAST({numerator} AS HUGEINT)", f"NULLIF(CAST({denominator} AS HUGEINT), 0)", 10**places
    return (
        f"CAST(sign({top}) * ((abs({top}) * {2 * unit} + abs({bottom})) // (2 * abs({bottom}))) AS DOUBLE) / {unit}"
    )


def cents(amount: str) -> str:
    return f"CAST({amount} * 100 AS HUGEINT)"


def _listed(values: list[str], position: str) -> str:
    return f"list_extract([{', '.join(repr(v) for v in values)}], CAST({position} AS INTEGER))"


def _day(base: str, offset: str) -> str:
    return f"(DATE '{base}' + CAST({offset} AS INTEGER))"


def _versions(history: str, key: str, tracked: list[str], carried: list[str]) -> str:
    changed = " OR ".join(f"{c} IS DISTINCT FROM lag({c}) OVER by_start" for c in tracked)
    columns = ", ".join([key, *tracked, *carried])
    return f"""
        SELECT *, coalesce(lead(effective_start) OVER w - 1, DATE '9999-12-31') AS effective_end,
               lead(effective_start) OVER w IS NULL AS is_current
        FROM (
            SELECT {columns}, effective_start,
                   row_number() OVER by_start = 1 OR {changed} AS opens
            FROM {history}
            WINDOW by_start AS (PARTITION BY {key} ORDER BY effective_start, history_id)
        ) WHERE opens
        WINDOW w AS (PARTITION BY {key} ORDER BY effective_start)"""


MODEL: dict[str, str] = {
    "plan_types": """
        SELECT n AS plan_id, upper(left(seg, 3)) AS plan_code, seg AS plan_name, seg AS plan_type,
               CAST(n * 500 AS DECIMAL(10,2)) AS deductible, CAST(n * 1000 AS DECIMAL(10,2)) AS oop_max,
               CAST(n + 10 AS DECIMAL(5,2)) AS coinsurance_pct
        FROM (SELECT seg, row_number() OVER (ORDER BY seg) AS n
              FROM (SELECT DISTINCT c_mktsegment AS seg FROM customer))""",
    "codes": """
        SELECT CAST(p_partkey AS VARCHAR) AS code, p_name AS description, left(p_type, 3) AS category_code,
               p_type AS category_name FROM part""",
    "member_base": f"""
        SELECT c_custkey AS member_id, c_name AS first_name, c_mktsegment AS last_name,
               {_day('1955-01-01', 'c_custkey % 14000')} AS date_of_birth,
               {_listed(['F', 'M', 'X'], '1 + c_custkey % 3')} AS gender,
               lpad(CAST(c_nationkey AS VARCHAR), CAST(greatest(2, len(CAST(c_nationkey AS VARCHAR))) AS INTEGER), '0') AS state,
               lpad(CAST(10000 + c_custkey % 80000 AS VARCHAR), 5, '0') AS zip_code,
               {_day('1994-01-01', 'c_custkey % 1600')} AS enrollment_date,
               plan_id AS first_plan, plan_id % (SELECT count(*) FROM plan_types) + 1 AS second_plan,
               c_custkey % 2 = 0 AS moves, {_day('1996-01-01', 'c_custkey % 300')} AS moved_on
        FROM customer JOIN plan_types ON plan_name = c_mktsegment""",
    "members": """
        SELECT member_id, first_name, last_name, date_of_birth, gender,
               CASE WHEN moves THEN second_plan ELSE first_plan END AS plan_id, state, zip_code, enrollment_date
        FROM member_base""",
    "member_history": """
        SELECT member_id * 2 AS history_id, member_id, first_plan AS plan_id, state, zip_code,
               DATE '1994-01-01' AS effective_start, CASE WHEN moves THEN moved_on - 1 END AS effective_end
        FROM member_base
        UNION ALL
        SELECT member_id * 2 + 1, member_id, second_plan, state, zip_code, moved_on, NULL
        FROM member_base WHERE moves""",
    "provider_base": f"""
        SELECT s_suppkey AS provider_id, lpad(CAST(s_suppkey AS VARCHAR), CAST(greatest(10, len(CAST(s_suppkey AS VARCHAR))) AS INTEGER), '0') AS npi, s_name AS provider_name,
               {_listed(['Physician', 'Hospital', 'Facility'], '1 + s_suppkey % 3')} AS provider_type,
               {_listed(fv.SPECIALTIES, '1 + s_suppkey % 12')} AS specialty, n_name AS city,
               lpad(CAST(s_nationkey AS VARCHAR), CAST(greatest(2, len(CAST(s_nationkey AS VARCHAR))) AS INTEGER), '0') AS state,
               CASE WHEN s_suppkey % 5 = 0 THEN 'Out-of-Network' ELSE 'In-Network' END AS first_status,
               CASE WHEN s_suppkey % 5 = 0 THEN 'In-Network' ELSE 'Out-of-Network' END AS second_status,
               CASE WHEN s_suppkey % 50 = 7 THEN DATE '1998-01-01' ELSE DATE '1994-01-01' END
                   AS network_effective_date,
               s_suppkey % 2 = 0 AS changes, {_day('1997-01-01', 's_suppkey % 180')} AS changed_on
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "providers": """
        SELECT provider_id, npi, provider_name, provider_type, specialty,
               CASE WHEN changes THEN second_status ELSE first_status END AS network_status, city, state,
               network_effective_date FROM provider_base""",
    "provider_history": """
        SELECT provider_id * 2 AS history_id, provider_id, first_status AS network_status, specialty,
               DATE '1994-01-01' AS effective_start, CASE WHEN changes THEN changed_on - 1 END AS effective_end,
               network_effective_date
        FROM provider_base
        UNION ALL
        SELECT provider_id * 2 + 1, provider_id, second_status, specialty, changed_on, NULL, network_effective_date
        FROM provider_base WHERE changes""",
    "claims": f"""
        SELECT o_orderkey AS claim_id,
               CASE WHEN o_orderkey % 1000 = 0 THEN -99 ELSE o_custkey END AS member_id,
               CASE WHEN o_orderkey % 1000 = 1 THEN -99
                    ELSE o_orderkey % (SELECT count(*) FROM supplier) END AS provider_id,
               CAST(o_orderkey % ((SELECT count(*) FROM part) + 5) AS VARCHAR) AS primary_diagnosis_code,
               o_orderpriority AS claim_type,
               CASE WHEN o_orderstatus = 'P' THEN 'Denied' ELSE 'Paid' END AS claim_status,
               CASE WHEN o_orderstatus = 'P' THEN {_listed(fv.DENIAL_REASONS, '1 + o_orderkey % 5')} END
                   AS denial_reason,
               CAST(o_orderdate AS DATE) + CASE WHEN o_orderkey % 1000 = 2 THEN {OFF_CALENDAR} ELSE 0 END AS service_date,
               CAST(o_orderdate AS DATE) + CAST(o_orderkey % 10 AS INTEGER)
                   + CASE WHEN o_orderkey % 1000 IN (2, 3) THEN {OFF_CALENDAR} ELSE 0 END AS processed_date,
               billed AS total_billed, allowed AS total_allowed,
               CASE WHEN o_orderstatus = 'P' THEN CAST(0 AS DECIMAL(12,2))
                    ELSE CAST(round(allowed * CAST(0.85 AS DECIMAL(3,2)), 2) AS DECIMAL(12,2)) END AS total_paid
        FROM (SELECT *, CAST(round(billed * CAST(0.72 AS DECIMAL(3,2)), 2) AS DECIMAL(12,2)) AS allowed
              FROM (SELECT *, CAST(o_totalprice AS DECIMAL(12,2)) AS billed FROM orders))""",
    "lines": f"""
        SELECT l_orderkey * (SELECT max(c) + 1 FROM (SELECT count(*) AS c FROM lineitem GROUP BY l_orderkey)) + n AS claim_line_id, l_orderkey AS claim_id, n AS line_number,
               CASE WHEN l_orderkey % 400 = 2 AND n = 1 THEN 'ZZZZZ' ELSE CAST(l_partkey AS VARCHAR) END
                   AS procedure_code,
               CAST((l_orderkey + n) % ((SELECT count(*) FROM part) + 5) AS VARCHAR) AS diagnosis_code,
               CAST(l_shipdate AS DATE) + CASE WHEN l_orderkey % 400 = 3 AND n = 1 THEN {OFF_CALENDAR} ELSE 0 END AS service_date, CAST(l_quantity AS DECIMAL(6,2)) AS units,
               billed AS billed_amount, allowed AS allowed_amount,
               CAST(round(allowed * CAST(0.85 AS DECIMAL(3,2)), 2) AS DECIMAL(12,2)) AS paid_amount
        FROM (SELECT *, CAST(round(billed * CAST(0.72 AS DECIMAL(3,2)), 2) AS DECIMAL(12,2)) AS allowed
              FROM (SELECT *, CAST(l_extendedprice AS DECIMAL(12,2)) AS billed,
                           row_number() OVER (PARTITION BY l_orderkey ORDER BY {', '.join(LINE_ORDER)}) AS n
                    FROM lineitem))""",
    "extent": """
        SELECT least(a, d) AS first_day, greatest(c, e) AS last_day, b AS last_order_day
        FROM (SELECT min(CAST(o_orderdate AS DATE)) AS a, max(CAST(o_orderdate AS DATE)) AS b,
                     max(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 10 AS INTEGER)) AS c FROM orders),
             (SELECT min(CAST(l_shipdate AS DATE)) AS d, max(CAST(l_shipdate AS DATE)) AS e FROM lineitem)""",
    "calendar": """
        SELECT CAST(d AS DATE) AS calendar_date, year(d) AS year_number, strftime(d, '%Y-%m') AS year_month
        FROM (SELECT unnest(generate_series(first_day, last_day, INTERVAL 1 DAY)) AS d FROM extent)""",
    "dim_member": "SELECT v.*, first_name, last_name, date_of_birth, gender, enrollment_date, plan_type "
    "FROM (" + _versions("member_history", "member_id", ["plan_id", "state", "zip_code"], []) + ") AS v "
    "JOIN members USING (member_id) JOIN plan_types ON plan_types.plan_id = v.plan_id",
    "dim_provider": "SELECT v.*, npi, provider_name, provider_type, city, state "
    "FROM (" + _versions("provider_history", "provider_id", ["network_status", "specialty"], ["network_effective_date"])
    + ") AS v JOIN (SELECT provider_id, npi, provider_name, provider_type, city, state FROM providers) "
    "USING (provider_id)",
    "batch": f"""
        SELECT c.*, m.effective_start AS member_since, m.plan_id, m.plan_type, m.enrollment_date,
               p.effective_start AS provider_since, p.network_status, p.specialty, p.network_effective_date,
               x.code AS known_diagnosis, x.category_name,
               s.year_number, s.year_month, coalesce(k.n, 0) AS line_count,
               CASE WHEN m.member_id IS NULL THEN '{fv.NO_MEMBER}'
                    WHEN p.provider_id IS NULL THEN '{fv.NO_PROVIDER}'
                    WHEN s.calendar_date IS NULL THEN '{fv.NO_SERVICE_DATE}'
                    WHEN r.calendar_date IS NULL THEN '{fv.NO_PROCESSED_DATE}' END AS reject_reason
        FROM claims c
        LEFT JOIN dim_member m ON m.member_id = c.member_id
             AND c.service_date >= m.effective_start AND c.service_date <= m.effective_end
        LEFT JOIN dim_provider p ON p.provider_id = c.provider_id
             AND c.service_date >= p.effective_start AND c.service_date <= p.effective_end
        LEFT JOIN calendar s ON s.calendar_date = c.service_date
        LEFT JOIN calendar r ON r.calendar_date = c.processed_date
        LEFT JOIN codes x ON x.code = c.primary_diagnosis_code
        LEFT JOIN (SELECT claim_id, count(*) AS n FROM lines GROUP BY claim_id) k ON k.claim_id = c.claim_id""",
    "fact": "SELECT * FROM batch WHERE reject_reason IS NULL",
    "line_batch": f"""
        SELECT l.*, f.member_id, f.provider_id, f.member_since, f.provider_since,
               CASE WHEN f.claim_id IS NULL AND b.reject_reason IS NOT NULL
                         THEN '{fv.HEADER_REJECTED}' || b.reject_reason
                    WHEN f.claim_id IS NULL THEN '{fv.NO_HEADER}'
                    WHEN d.calendar_date IS NULL THEN '{fv.NO_SERVICE_DATE}' END AS reject_reason
        FROM lines l
        LEFT JOIN fact f ON f.claim_id = l.claim_id
        LEFT JOIN batch b ON b.claim_id = l.claim_id
        LEFT JOIN calendar d ON d.calendar_date = l.service_date""",
    "fact_line": "SELECT * FROM line_batch WHERE reject_reason IS NULL",
    "letters": f"""
        SELECT '{fv.CLAIM_PIPELINE}' AS pipeline_name, CAST(claim_id AS VARCHAR) AS source_key, reject_reason
        FROM batch WHERE reject_reason IS NOT NULL
        UNION ALL
        SELECT '{fv.LINE_PIPELINE}', CAST(claim_line_id AS VARCHAR), reject_reason
        FROM line_batch WHERE reject_reason IS NOT NULL""",
}

_WORD = re.compile(r"[a-z_]+")


def with_model(sql: str) -> str:
    """A WITH clause of the model tables the statement needs, ending in it as ``answer``."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in _WORD.findall(text):
            if name in MODEL and name not in needed:
                needed.add(name)
                visit(MODEL[name])

    visit(sql)
    parts = [f"{name} AS ({MODEL[name]})" for name in MODEL if name in needed]
    return "WITH " + ",\n".join([*parts, f"answer AS ({sql})"])
