"""The load end to end on hand-made sources: every outcome a row can have."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest
from conftest import claim, day, line, member, member_version, provider, provider_version
from pyspark.sql import functions as F

from claimloom import schemas
from claimloom.operators import facts, ledger
from claimloom.operators.constraints import ConstraintError, constraint_report
from claimloom.plans.load import reset_warehouse, run_etl
from claimloom.plans.summary import monthly_volume_from_summary, refresh_monthly_claim_volume

NOW = datetime(2026, 1, 1)


def letters(tables, pipeline="fact_claim"):
    rows = tables["etl_dead_letter"].filter(F.col("pipeline_name") == pipeline).collect()
    return {int(r.source_key): r.reject_reason for r in rows}


def mark(tables, pipeline="fact_claim"):
    row = tables["etl_watermark"].filter(F.col("pipeline_name") == pipeline).first()
    return (str(row.high_water_mark), row.rows_loaded)


def balance(source, tables):
    return {r.entity: r.asDict() for r in ledger.source_balance(source, tables).collect()}


def test_reject_reasons_retry_and_watermark(source_of, store):
    claims = [
        claim(1), claim(2, member_id=9), claim(3, provider_id=9), claim(4, service="2019-06-01"),
        claim(5, service="2030-12-30", processed="2031-01-02"), claim(6, code="???"),
        claim(7, status="Denied", paid="0.00"), claim(8, paid="90.00"),
    ]
    lines = [line(1, 1), line(1, 2, code="ZZZZZ"), line(2, 1), line(6, 1, service="2031-05-01"), line(8, 1, dx="???")]
    history = [member_version(1, 1, start="2018-01-01")]
    source = source_of(claims=claims, claim_lines=lines, member_plan_history=history)
    reset_warehouse(store)
    run_etl(store, source, now=NOW)
    tables = store.read_all()
    assert letters(tables) == {
        2: "member not found for service date", 3: "provider not found for service date",
        4: "service date not in dim_date", 5: "processed date not in dim_date",
    }
    assert letters(tables, "fact_claim_line") == {
        21: "header rejected: member not found for service date", 61: "service date not in dim_date",
    }
    fact = {r.claim_id: r for r in tables["fact_claim"].collect()}
    assert sorted(fact) == [1, 6, 7, 8] and sorted(r.claim_key for r in fact.values()) == [1, 2, 3, 4]
    assert fact[6].primary_diagnosis_key == -1 and fact[1].line_count == 2
    owed = {i: fact[i].member_responsibility for i in (1, 7, 8)}
    assert owed == {1: Decimal("12.75"), 7: Decimal("0.00"), 8: Decimal("0.00")}
    placed = {(r.claim_id, r.line_number): r for r in tables["fact_claim_line"].collect()}
    assert placed[(1, 2)].procedure_key == -1 and placed[(1, 2)].source_procedure_code == "ZZZZZ"
    assert placed[(8, 1)].diagnosis_key == -1 and placed[(1, 1)].claim_key == fact[1].claim_key
    assert mark(tables) == ("2031-01-02", 4) and mark(tables, "fact_claim_line") == ("2031-01-02", 3)
    report = balance(source, tables)
    assert (report["claims"]["loaded"], report["claims"]["rejected"]) == (4, 4)
    assert (report["claim_lines"]["loaded"], report["claim_lines"]["rejected"]) == (3, 2)
    ledger.assert_balance(ledger.source_balance(source, tables))
    broken = constraint_report(
        {n: tables[n] for n in ("dim_date", "dim_plan", "dim_diagnosis", "dim_procedure", "dim_member", "dim_provider", "fact_claim", "fact_claim_line")}
    ).filter("violations > 0").collect()
    assert broken == []

    # the missing member arrives, and a claim dated before the mark
    source = source_of(
        claims=[*claims, claim(10, service="2020-02-02")], claim_lines=lines,
        members=[member(1), member(9)], member_plan_history=[*history, member_version(2, 9)],
    )
    run_etl(store, source, now=NOW)
    tables = store.read_all()
    assert set(letters(tables)) == {3, 4, 5} and set(letters(tables, "fact_claim_line")) == {61}
    keys = {r.claim_id: r.claim_key for r in tables["fact_claim"].collect()}
    assert sorted(keys) == [1, 2, 6, 7, 8, 10] and sorted(keys.values()) == [1, 2, 3, 4, 5, 6]
    assert all(keys[i] == fact[i].claim_key for i in fact)
    assert mark(tables) == ("2031-01-02", 6) and mark(tables, "fact_claim_line") == ("2031-01-02", 4)
    ids = [r.dead_letter_id for r in tables["etl_dead_letter"].collect()]
    assert len(set(ids)) == len(ids) and -1 not in ids
    ledger.assert_balance(ledger.source_balance(source, tables))

    # a third run finds nothing new
    before = {n: tables[n].count() for n in schemas.WAREHOUSE}
    run_etl(store, source, now=NOW)
    tables = store.read_all()
    assert {n: tables[n].count() for n in schemas.WAREHOUSE} == before
    assert mark(tables) == ("2031-01-02", 6)

    # the summary follows the fact only when it is refreshed
    assert tables["monthly_claim_volume"].count() == 0
    refresh_monthly_claim_volume(store)
    fresh = monthly_volume_from_summary(store.read_all()).collect()
    assert [(r.year_month, r.claim_count, r.claim_count_3_month_avg) for r in fresh] == [
        ("2020-02", 1, Decimal("1.00")), ("2024-01", 5, Decimal("3.00")),
    ]

    reset_warehouse(store)
    tables = store.read_all()
    assert tables["dim_member"].count() == 1 and tables["fact_claim"].count() == 0
    assert tables["etl_dead_letter"].count() == 0 and tables["etl_watermark"].count() == 0


def test_only_letters_of_retried_claims_go(make):
    log = make("etl_dead_letter", [
        {"dead_letter_id": i, "pipeline_name": p, "source_key": k, "reject_reason": "r"}
        for i, (p, k) in enumerate([("fact_claim", "1"), ("fact_claim", "2"), ("fact_claim_line", "1")])
    ])
    kept = facts.retained_dead_letters(log, make("claim_load_batch", [{"claim_id": 1}])).collect()
    assert sorted((r.pipeline_name, r.source_key) for r in kept) == [("fact_claim", "2"), ("fact_claim_line", "1")]


def test_failed_check_publishes_nothing(source_of, store, monkeypatch):
    reset_warehouse(store)
    published = store.manifest()

    def fail(*_):
        raise ConstraintError("planted")

    monkeypatch.setattr("claimloom.plans.load.check_versions", fail)
    with pytest.raises(ConstraintError):
        run_etl(store, source_of(claims=[claim(1), claim(2)]), now=NOW)
    assert store.manifest() == published and store.read("fact_claim").count() == 0


def test_empty_batch_leaves_the_mark(spark, make):
    marks = make("etl_watermark", [{"pipeline_name": "fact_claim", "high_water_mark": day("2024-01-01"), "rows_loaded": 5, "updated_at": NOW}])
    batch = schemas.empty(spark, "claim_load_batch")
    assert facts.advance_watermark(marks, batch, NOW).collect() == marks.collect()


def test_older_batch_does_not_pull_the_mark_back(make):
    marks = make("etl_watermark", [{"pipeline_name": "fact_claim", "high_water_mark": day("2024-01-01"), "rows_loaded": 5, "updated_at": NOW}])
    batch = make("claim_load_batch", [
        {"claim_id": 1, "processed_date": day("2023-01-01")}, {"claim_id": 2, "processed_date": day("2023-05-01"), "reject_reason": "x"},
    ])
    row = facts.advance_watermark(marks, batch, NOW).first()
    assert (str(row.high_water_mark), row.rows_loaded) == ("2024-01-01", 6)


def test_all_line_reasons(make):
    dim_date = make("dim_date", [{"date_key": -1}, {"date_key": 1, "calendar_date": day("2024-01-10")}])
    heads = make("fact_claim", [{"claim_id": i, "claim_key": i} for i in (1, 4)])
    placed = make("fact_claim_line", [{"claim_id": 1, "line_number": 1}])
    log = make("etl_dead_letter", [
        {"dead_letter_id": 1, "pipeline_name": "fact_claim", "source_key": "2", "reject_reason": "old"},
        {"dead_letter_id": 2, "pipeline_name": "fact_claim", "source_key": "2", "reject_reason": "x" * 250},
    ])
    rows = make("claim_lines", [line(1, 1), line(1, 2), line(2, 1), line(3, 1), line(4, 1, service="2024-01-11")])
    got = facts.line_dead_letters(rows, dim_date, heads, placed, log, NOW)
    assert {r.source_key: r.reject_reason for r in got.collect()} == {
        "12": "line not loaded", "21": ("header rejected: " + "x" * 250)[:200], "31": "header not loaded",
        "41": "service date not in dim_date",
    }


def test_dispositions(make):
    log = make("etl_dead_letter", [
        {"dead_letter_id": 1, "pipeline_name": "fact_claim", "source_key": "2", "reject_reason": "r2"},
        {"dead_letter_id": 2, "pipeline_name": "fact_claim", "source_key": "3", "reject_reason": "r3"},
        {"dead_letter_id": 3, "pipeline_name": "fact_claim_line", "source_key": "31", "reject_reason": "l31"},
        {"dead_letter_id": 4, "pipeline_name": "fact_claim_line", "source_key": "11", "reject_reason": "l11"},
    ])
    heads = make("fact_claim", [{"claim_id": 1}, {"claim_id": 3}])
    got = ledger.claim_disposition(make("claims", [claim(i) for i in (1, 2, 3, 4)]), heads, log).collect()
    assert {r.claim_id: (r.disposition, r.reject_reason) for r in got} == {
        1: ("loaded", None), 2: ("rejected", "r2"), 3: ("conflict", "r3"), 4: ("unaccounted", None),
    }
    both = ledger._claim_outcomes(make("claims", [claim(1), claim(2)]), make("fact_claim", [{"claim_id": 1}, {"claim_id": 9}]), log, "full")
    assert {r.claim_id: r.disposition for r in both.collect()} == {1: "loaded", 2: "rejected", 9: "warehouse_only"}
    placed = make("fact_claim_line", [{"claim_id": 1, "line_number": n} for n in (1, 2)])
    rows = make("claim_lines", [line(1, 1), line(1, 2), line(2, 1), line(3, 1), line(4, 1)])
    got = ledger.claim_line_disposition(rows, placed, log).collect()
    assert {r.claim_line_id: (r.disposition, r.reject_reason) for r in got} == {
        11: ("conflict", "l11"), 12: ("loaded", None), 21: ("held_with_header", "r2"), 31: ("rejected", "l31"),
        41: ("unaccounted", None),
    }


def test_history_outcomes_and_warehouse_only(source_of, store):
    history = [
        member_version(1, 1), member_version(2, 1, start="2021-01-01"),
        member_version(3, 1, plan_id=2, start="2022-01-01"), member_version(4, 1, plan_id=1, start="2022-01-01"),
    ]
    source = source_of(member_plan_history=history, provider_network_history=[provider_version(1, 1), provider_version(2, 1, start="2020-01-01")])
    reset_warehouse(store)
    run_etl(store, source, now=NOW)
    tables = store.read_all()
    got = ledger.member_history_disposition(source["member_plan_history"], tables["dim_member"]).collect()
    # the loser of a shared start day counts as loaded: a version does start on that day
    assert {r.history_id: r.disposition for r in got} == {1: "loaded", 2: "collapsed", 3: "loaded", 4: "loaded"}
    report = balance(source, tables)
    assert report["provider_network_history"]["collapsed"] == 1
    ledger.assert_balance(ledger.source_balance(source, tables))

    # a row from before the first version never loads; the fold test shows that the load passes it over
    late = source_of(member_plan_history=[*history, member_version(5, 1, plan_id=2, start="2019-01-01")])
    gone = source_of(members=[member(2)], member_plan_history=[member_version(9, 2)], providers=[provider(1)])
    assert balance(late, tables)["member_plan_history"]["unaccounted"] == 1
    report = balance(gone, tables)
    assert (report["members"]["unaccounted"], report["members"]["warehouse_only"]) == (1, 1)
    with pytest.raises(ConstraintError, match="members"):
        ledger.assert_balance(ledger.source_balance(gone, tables))


@pytest.mark.parametrize("broken", [
    {"claims": [claim(1), claim(1)], "claim_lines": [line(1, 1)]},
    {"claims": [claim(1)], "claim_lines": [line(1, 1), line(1, 1)]},
    {"member_plan_history": [member_version(1, 1), member_version(2, 1, plan_id=77, start="2022-01-01")]},
    {"provider_network_history": [provider_version(1, 1), provider_version(2, 99)]},
])
def test_broken_source_publishes_nothing(source_of, store, broken):
    reset_warehouse(store)
    run_etl(store, source_of(claims=[claim(5)], claim_lines=[line(5, 1)]), now=NOW)
    before = store.read("fact_claim").count()
    with pytest.raises(ConstraintError):
        run_etl(store, source_of(**broken), now=NOW)
    assert before == 1 and [r.claim_id for r in store.read("fact_claim").collect()] == [5]
