"""Edge cases of the analytic queries on hand-made warehouse tables."""

from __future__ import annotations

from datetime import date, timedelta
from decimal import Decimal

import pytest
from conftest import day

from claimloom.plans import analytics

D = Decimal


@pytest.fixture(scope="module")
def calendar(spark):
    from claimloom import schemas
    from claimloom.operators.dimensions import load_dim_date

    return load_dim_date(schemas.empty(spark, "dim_date"), "2020-01-01", "2025-12-31").cache()


@pytest.fixture(scope="module")
def date_key(calendar):
    return {str(r.calendar_date): r.date_key for r in calendar.select("calendar_date", "date_key").collect()}


def provider(key, provider_id, name="P", current=True, specialty="S", network="In-Network"):
    return {"provider_key": key, "provider_id": provider_id, "provider_name": name, "specialty": specialty,
            "network_status": network, "is_current": current}


def member(key, member_id, start, end="9999-12-31", plan_key=1, enrolled=None):
    return {"member_key": key, "member_id": member_id, "plan_key": plan_key, "enrollment_date": day(enrolled or start),
            "effective_start": day(start), "effective_end": day(end), "is_current": end == "9999-12-31"}


UNKNOWN_MEMBER = {**member(-1, -1, "1900-01-01"), "plan_key": -1}


@pytest.fixture
def tables(make, calendar, date_key):
    def build(facts=(), providers=(), members=(), plans=((1, "HMO"), (2, "PPO"))):
        rows = [
            {"claim_id": i, "member_key": f.get("member", 1), "provider_key": f.get("provider", 1),
             "plan_key": f.get("plan", 1), "primary_diagnosis_key": f.get("dx", 1), "service_date_key": date_key[f["on"]],
             "processed_date_key": date_key[f["on"]], "claim_type": f.get("type", "T"), "claim_status": f.get("status", "Paid"),
             "total_paid": D(f.get("paid", "1.00"))}
            for i, f in enumerate(facts)
        ]
        return {
            "fact_claim": make("fact_claim", rows), "dim_date": calendar, "dim_provider": make("dim_provider", list(providers)),
            "dim_member": make("dim_member", [UNKNOWN_MEMBER, *members]),
            "dim_plan": make("dim_plan", [{"plan_key": k, "plan_type": t} for k, t in plans]),
            "dim_diagnosis": make("dim_diagnosis", [
                {"diagnosis_key": -1, "category_name": "Not Applicable"}, {"diagnosis_key": 1, "category_name": "one"},
                {"diagnosis_key": 2, "category_name": "two"}, {"diagnosis_key": 3, "category_name": "three"}]),
        }

    return build


def test_top_providers(tables):
    t = tables(
        facts=[
            {"provider": 1, "on": "2024-02-01", "paid": "100.00"}, {"provider": 2, "on": "2025-02-01", "paid": "150.00"},
            {"provider": 3, "on": "2023-02-01", "paid": "90.00"}, {"provider": 3, "on": "2025-02-01", "paid": "80.00"},
            {"provider": 4, "on": "2024-05-01", "paid": "0.00"}, {"provider": 4, "on": "2025-05-01", "paid": "80.00"},
            {"provider": 5, "on": "2024-05-01", "paid": "500.00"},
        ],
        # keys 1 and 2 are versions of provider 10; provider 12 skips a year; 13 was paid nothing before
        providers=[provider(1, 10, "old", False), provider(2, 10, "new"), provider(3, 12), provider(4, 13), provider(5, 14)],
    )
    rows = analytics.top_providers_yoy(t).collect()
    assert [(r.provider_rank, r.provider_id, r.provider_name, r.total_paid, r.prior_year_paid, r.yoy_change_pct) for r in rows] == [
        (1, 10, "new", D("150.00"), D("100.00"), D("50.0")), (2, 12, "P", D("80.00"), None, None),
        (3, 13, "P", D("80.00"), D("0.00"), None),
    ]
    assert len(analytics.top_providers_yoy(t, top=2).collect()) == 2


def test_diagnosis_spend_ranks_ties_alike(tables):
    t = tables(facts=[
        {"on": "2024-01-01", "dx": 1, "paid": "5.00"}, {"on": "2024-01-01", "dx": 2, "paid": "5.00"},
        {"on": "2024-01-01", "dx": 3, "paid": "1.00"}, {"on": "2024-01-01", "dx": -1, "paid": "99.00"},
        {"on": "2024-01-01", "dx": 3, "paid": "0.00", "status": "Denied"},
    ])
    rows = analytics.diagnosis_category_spend(t).collect()
    assert [(r.category_name, r.paid_claims, r.spend_rank) for r in rows] == [("one", 1, 1), ("two", 1, 1), ("three", 1, 3)]


def test_utilization_counts_a_mover_in_both_types(tables):
    t = tables(
        facts=[{"on": "2024-03-05", "plan": 1}],
        members=[
            member(1, 1, "2024-01-10", "2024-02-14", 1), member(2, 1, "2024-02-15", plan_key=2),
            # two versions on one plan type share February: counted once
            member(3, 2, "2024-01-01", "2024-02-09", 1), member(4, 2, "2024-02-10", plan_key=1),
            member(5, 3, "2024-05-01", plan_key=1),
        ],
    )
    rows = analytics.member_utilization(t, "2024-01-01", "2024-04-15").collect()
    assert [(r.plan_type, r.year_month, r.member_count, r.claim_count, r.claims_per_1000_members, r.cumulative_months) for r in rows] == [
        ("HMO", "2024-01", 2, 0, D("0.00"), 1), ("HMO", "2024-02", 2, 0, D("0.00"), 2),
        ("HMO", "2024-03", 1, 1, D("1000.00"), 3), ("HMO", "2024-04", 1, 0, D("0.00"), 4),
        ("PPO", "2024-02", 1, 0, D("0.00"), 1), ("PPO", "2024-03", 1, 0, D("0.00"), 2), ("PPO", "2024-04", 1, 0, D("0.00"), 3),
    ]


def test_denial_rate_rounds_half_up(tables):
    facts = [{"on": "2024-01-01", "status": "Denied"}] + [{"on": "2024-01-01"}] * 7
    row = analytics.denial_rate(tables(facts=facts, providers=[provider(1, 1)])).first()
    assert (row.claims, row.denied_claims, row.denial_rate_pct) == (8, 1, D("12.50"))


def test_network_cost_shares_one_denominator(tables):
    t = tables(
        facts=[
            {"on": "2024-01-01", "member": 1, "provider": 1, "paid": "10.00"}, {"on": "2024-06-01", "member": 2, "provider": 2, "paid": "5.00"},
            {"on": "2024-07-01", "member": 3, "provider": 1, "paid": "0.00", "status": "Denied"},
        ],
        providers=[provider(1, 1), provider(2, 2, network="Out-of-Network")],
        members=[member(1, 1, "2024-01-01", "2024-03-01"), member(2, 1, "2024-03-02"), member(3, 2, "2024-01-01")],
    )
    row = analytics.oon_cost_comparison(t).first()
    assert tuple(row) == (2024, 2, D("10.00"), D("5.00"), D("5.00"), D("2.50"))


def test_moving_average_skips_missing_months(tables):
    t = tables(facts=[{"on": d} for d in ("2024-01-03", "2024-01-09", "2024-02-02", "2024-04-02", "2024-05-02", "2024-05-03")])
    rows = analytics.monthly_volume(t).collect()
    assert [(r.year_month, r.claim_count_3_month_avg) for r in rows] == [
        ("2024-01", D("2.00")), ("2024-02", D("1.50")), ("2024-04", D("1.33")), ("2024-05", D("1.33")),
    ]
    assert {r.year_month: str(r.month_start) for r in analytics.monthly_totals(t).collect()}["2024-01"] == "2024-01-03"


def test_cohort_of_a_leap_day(tables):
    t = tables(
        facts=[{"on": "2020-02-29"}, {"on": "2021-02-27"}, {"on": "2021-02-28"}, {"on": "2021-06-01", "member": 2}],
        members=[member(1, 1, "2020-02-29"), member(2, 2, "2020-06-01"), member(3, 3, "2022-01-01")],
    )
    rows = analytics.member_cohort(t).collect()
    assert [tuple(r) for r in rows] == [
        (2020, 2, D("1.00"), 1, D("1.00")), (2022, 1, D("0.00"), 2, D("0.50")),
    ]


def test_threshold_is_reached_by_equality(tables):
    t = tables(
        facts=[
            {"on": "2024-01-01", "paid": "600000.00"}, {"on": "2024-02-01", "paid": "400000.00"}, {"on": "2024-03-01", "paid": "0.00"},
            {"on": "2025-01-01", "paid": "999999.99"}, {"provider": 2, "on": "2024-01-01", "paid": "2000000.00"},
        ],
        providers=[provider(1, 1), provider(2, 2)],
    )
    got = {(r.provider_id, r.year_number): (r.ytd_paid, r.crossed_one_million_on, r.crossed_one_million) for r in analytics.provider_ytd_threshold(t).collect()}
    assert got == {
        (1, 2024): (D("1000000.00"), date(2024, 2, 1), True), (1, 2025): (D("999999.99"), None, False),
        (2, 2024): (D("2000000.00"), date(2024, 1, 1), True),
    }


def test_utilization_equals_months_joined_to_versions(spark, tables):
    """Random, partly overlapping versions against the plain interval join."""
    import random

    rng = random.Random(3)
    members = []
    for key in range(1, 250):
        start = date(2019, 6, 1) + timedelta(days=rng.randint(0, 1500))
        end = "9999-12-31" if rng.random() < 0.3 else str(start + timedelta(days=rng.randint(0, 400)))
        members.append(member(key, rng.randint(1, 40), str(start), end, rng.choice([1, 2])))
    t = tables(members=members)
    got = {(r.plan_type, r.year_month): r.member_count for r in analytics.enrolled_members(t, "2020-02-10", "2023-03-20").collect()}
    expected: dict = {}
    first = date(2020, 2, 10)
    while first <= date(2023, 3, 20):
        following = (first.replace(day=1) + timedelta(days=32)).replace(day=1)
        last = min(following - timedelta(days=1), date(2023, 3, 20))
        for plan, name in ((1, "HMO"), (2, "PPO")):
            found = {m["member_id"] for m in members if m["plan_key"] == plan and m["effective_start"] <= last and m["effective_end"] >= first}
            if found:
                expected[(name, first.strftime("%Y-%m"))] = len(found)
        first = following
    assert got == expected
