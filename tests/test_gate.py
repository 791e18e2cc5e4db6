"""What a load demands of its source, single procedures, and one manifest for a rebuild."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest
from conftest import DIAGNOSES, PLANS, PROCEDURES, claim, day, line, member, member_version, provider, provider_version

from claimloom import schemas
from claimloom.operators import facts, ledger, quality
from claimloom.operators.constraints import ConstraintError
from claimloom.operators.gate import BREACHES, SOURCE_RULES, Gate
from claimloom.plans.load import LOAD, RESET, SUMMARY, Counts, publish, reset_warehouse, run_etl
from claimloom.plans.rebuild import rebuild

NOW = datetime(2026, 1, 1)

CLEAN = {
    "plan_types": PLANS[0], "diagnosis_codes": DIAGNOSES[0], "procedure_codes": PROCEDURES[0], "members": member(2),
    "member_plan_history": member_version(2, 2), "providers": provider(2), "provider_network_history": provider_version(2, 2),
    "claims": claim(1), "claim_lines": line(1, 1),
}
BROKEN = [
    ("plan_types", "check", "plan type", {"plan_type": "POS"}),
    ("plan_types", "length", "plan_code", {"plan_code": "x" * 11}),
    ("diagnosis_codes", "not null", "description", {"description": None}),
    ("diagnosis_codes", "length", "category_code", {"category_code": "x" * 8}),
    ("procedure_codes", "not null", "category_name", {"category_name": None}),
    ("members", "check", "gender", {"gender": "Q"}),
    ("members", "length", "state", {"state": "TXX"}),
    ("member_plan_history", "check", "dates", {"effective_end": day("2019-12-31")}),
    ("providers", "check", "provider type", {"provider_type": "Clinic"}),
    ("providers", "not null", "specialty", {"specialty": None}),
    ("provider_network_history", "check", "network status", {"network_status": "Unknown"}),
    ("claims", "check", "claim status", {"claim_status": "Open"}),
    ("claims", "check", "processed", {"processed_date": day("2024-01-09")}),
    ("claims", "length", "claim_type", {"claim_type": "x" * 21}),
    ("claims", "not null", "total_paid", {"total_paid": None}),
    ("claim_lines", "check", "amounts", {"units": Decimal("0.00")}),
    ("claim_lines", "not null", "service_date", {"service_date": None}),
    ("claim_lines", "length", "procedure_code", {"procedure_code": "x" * 11}),
]


def test_every_table_has_its_rules(make):
    gate = Gate(SOURCE_RULES, schemas.CHECKS)
    for table, row in CLEAN.items():
        wrong = [(kind, name, change) for t, kind, name, change in BROKEN if t == table]
        rows = make(table, [row, *[{**row, **change} for _, _, change in wrong]])
        found = {(r.kind, r.name): r.violations for r in gate.row_breaches(gate.marked(rows, table), table).collect()}
        # a text that is too long breaks its list of values as well
        assert {(kind, name) for kind, name, _ in wrong} <= set(found), table
        assert gate.marked(make(table, [row]), table).first()[BREACHES] == 0


def test_keys_share_one_shuffle(make, spark):
    gate = Gate(SOURCE_RULES, schemas.CHECKS)
    lines = make("claim_lines", [line(1, 1), line(1, 1), line(1, 2), {**line(2, 1), "claim_line_id": 12}, {**line(3, 1), "claim_line_id": None}])
    plans = make("plan_types", [*PLANS, {**PLANS[0], "plan_id": 9}])
    found = gate.key_breaches({"claim_lines": lines, "plan_types": plans})
    assert {(r.table_name, r.name, r.violations) for r in found.collect()} == {
        ("claim_lines", "claim_line_id", 2), ("claim_lines", "claim_id, line_number", 1), ("plan_types", "plan_code", 1),
    }


@pytest.mark.parametrize(("table", "change"), [("members", {"gender": "Q"}), ("claims", {"claim_status": "Open"}), ("claim_lines", {"units": Decimal("0.00")})])
def test_breach_publishes_nothing(source_of, store, table, change):
    reset_warehouse(store)
    before = store.manifest()
    source = source_of(claims=[claim(1)], claim_lines=[line(1, 1)])
    row = CLEAN[table] if table != "members" else member(1)
    source[table] = source_of(**{table: [{**row, **change}]})[table]
    with pytest.raises(ConstraintError):
        run_etl(store, source, now=NOW)
    assert store.manifest() == before
    run_etl(store, source, now=NOW, rules=[("unique", None)])


def test_values_are_a_parameter(source_of, store):
    reset_warehouse(store)
    source = source_of(claims=[{**claim(1), "claim_type": "Dental"}], claim_lines=[line(1, 1)])
    with pytest.raises(ConstraintError, match="claim type"):
        run_etl(store, source, now=NOW)
    run_etl(store, source, now=NOW, checks=schemas.checks_for({"claims.claim_type": ["Dental"]}))
    assert store.read("fact_claim").count() == 1


def test_texts_are_measured_when_written(make):
    with pytest.raises(Exception, match="fact_claim.claim_type is longer than 20"):
        schemas.conform(make("fact_claim", [{"claim_id": 1, "claim_type": "x" * 21}]), "fact_claim").collect()
    rows = make("claim_lines", [line(3, 1)]).withColumn("reject_reason", facts.F.lit("y" * 300))
    letters = facts.dead_letters(rows, "fact_claim_line", "source.claim_lines", "claim_line_id", NOW, 200)
    assert schemas.conform(letters.selectExpr("1 as dead_letter_id", "*"), "etl_dead_letter").first().reject_reason == "y" * 200


def test_rerun_checks_the_batch_alone(source_of, store, monkeypatch):
    reset_warehouse(store)
    source = source_of(claims=[claim(1), claim(2)], claim_lines=[line(1, 1), line(2, 1)])
    first = run_etl(store, source, now=NOW)
    assert first.facts == {"fact_claim": Counts(2, 0), "fact_claim_line": Counts(2, 0)}
    plans = []

    def noted(self, *args, real=Gate.key_breaches):
        found = real(self, *args)
        plans.append((args[0], found.inputFiles(), found._jdf.queryExecution().executedPlan().toString()))
        return found

    monkeypatch.setattr(Gate, "key_breaches", noted)
    assert run_etl(store, source, now=NOW).facts == {"fact_claim": Counts(0, 0), "fact_claim_line": Counts(0, 0)}
    ((tables, files, plan),) = [entry for entry in plans if "claim_lines" in entry[0]]
    assert tables["claim_lines"].count() == 0
    assert all("line_load_batch" in path for path in files) and "FileScan" in plan and "ExistingRDD" not in plan

    # a loaded claim that comes again raises, though it is not in the batch
    again = source_of(claims=[claim(1), claim(2), claim(2)], claim_lines=[line(1, 1), line(2, 1)])
    with pytest.raises(ConstraintError, match="repeats a loaded key"):
        run_etl(store, again, now=NOW)


def test_single_procedures_publish_alone(source_of, store):
    reset_warehouse(store)
    source = source_of(claims=[claim(1), claim(2, member_id=7)], claim_lines=[line(1, 1), line(2, 1)])
    for name in ("dim_date", "dim_plan", "dim_diagnosis", "dim_procedure", "dim_member", "dim_provider"):
        publish(store, source, [name], now=NOW)
        assert store.read(name).count() > 1, name
    assert publish(store, source, ["fact_claim"], now=NOW).facts == {"fact_claim": Counts(1, 1)}
    assert store.read("fact_claim_line").count() == 0 and store.read("etl_dead_letter").count() == 1
    assert publish(store, source, ["fact_claim_line"], now=NOW).facts == {"fact_claim_line": Counts(1, 1)}
    publish(store, source, [SUMMARY, "load_profile"], now=NOW)
    alone = {name: sorted(store.read(name).collect(), key=str) for name in (*schemas.WAREHOUSE, *schemas.AUDIT)}
    publish(store, source, [RESET, *LOAD, SUMMARY], now=NOW)
    whole = {name: sorted(store.read(name).collect(), key=str) for name in (*schemas.WAREHOUSE, *schemas.AUDIT)}
    assert alone == whole
    with pytest.raises(ValueError, match="no such procedure"):
        publish(store, source, ["dim_claim"])


def test_failed_rebuild_leaves_the_old_version(source_of, store):
    source = source_of(claims=[claim(1)], claim_lines=[line(1, 1)])
    publish(store, source, [RESET, *LOAD, SUMMARY], now=NOW)
    before = store.manifest()
    with pytest.raises(ConstraintError):
        rebuild(store, source_of(claims=[claim(1), claim(1)], claim_lines=[line(1, 1)]), now=NOW)
    assert store.manifest() == before and store.read("fact_claim").count() == 1


def test_planted_duplicates_do_not_add_up(source_of, store):
    source = source_of(claims=[claim(1), claim(2)], claim_lines=[line(1, 1), line(2, 1)])
    publish(store, source, [RESET, *LOAD], now=NOW)
    tables = store.read_all()
    ledger.assert_balance(ledger.source_balance(source, tables))
    twice = source_of(claims=[claim(1), claim(2), claim(2)], claim_lines=[line(1, 1), line(2, 1), line(2, 1)])
    bad = {r.entity: r for r in ledger.balance_failures(ledger.source_balance(twice, tables)).collect()}
    assert {name: (r.source_rows, r.loaded) for name, r in bad.items()} == {"claims": (3, 2), "claim_lines": (3, 2)}
    fewer = source_of(claims=[claim(2)], claim_lines=[line(2, 1)])
    bad = {r.entity: r.warehouse_only for r in ledger.balance_failures(ledger.source_balance(fewer, tables)).collect()}
    assert bad == {"claims": 1, "claim_lines": 1}


def test_checks_on_claims_from_two_scans(make, source_of, store):
    source = source_of(
        claims=[claim(1), claim(2), claim(3, provider_id=2, service="2020-02-02")], claim_lines=[line(1, 1), line(2, 1), line(3, 1)],
        providers=[provider(1), provider(2)],
        provider_network_history=[provider_version(1, 1), provider_version(2, 2, network="2021-01-01")],
    )
    publish(store, source, [RESET, *LOAD], now=NOW)
    tables = store.read_all()
    got = {r.check_name: (r.total_rows_evaluated, r.passed) for r in quality._fact_checks(tables).collect()}
    assert got == {quality.VALID_KEYS: (3, 3), quality.PAID_RATIO: (3, 3), quality.NETWORK_DATE: (3, 2)}
    # the provider with an early claim is the only key value that the scan of the claims has to meet
    late = tables["dim_provider"].filter("provider_id = 2").first().provider_key
    assert [r.key for r in quality._suspects(tables).collect()] == [late]
    broken = tables["fact_claim"].withColumn("member_key", facts.F.expr("if(claim_id = 1, 999, member_key)")).withColumn(
        "provider_key", facts.F.expr("if(claim_id = 2, -1, provider_key)")
    ).withColumn("processed_date_key", facts.F.expr("if(claim_id = 3, -1, processed_date_key)"))
    got = {r.check_name: (r.total_rows_evaluated, r.passed) for r in quality._fact_checks({**tables, "fact_claim": broken}).collect()}
    assert got[quality.VALID_KEYS] == (3, 0)
    assert got[quality.NETWORK_DATE] == tuple(quality.network_date({**tables, "fact_claim": broken}).first()[2:])
