from __future__ import annotations

import sys
from datetime import date
from decimal import Decimal
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from claimloom import schemas  # noqa: E402
from claimloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "8g", "spark.log.level": "ERROR",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    yield session
    session.stop()


def day(text: str) -> date:
    return date.fromisoformat(text)


@pytest.fixture(scope="session")
def make(spark):
    """Rows of a named table; columns not given are null."""

    def build(table: str, rows: list[dict]):
        names = schemas.columns(table)
        return spark.createDataFrame([tuple(row.get(n) for n in names) for row in rows], schemas.struct(table))

    return build


def claim(claim_id, member_id=1, provider_id=1, service="2024-01-10", processed=None, status="Paid", code="A00.000", paid="72.25", allowed="85.00"):
    return {
        "claim_id": claim_id, "member_id": member_id, "provider_id": provider_id, "primary_diagnosis_code": code,
        "claim_type": "Professional", "claim_status": status, "denial_reason": None, "service_date": day(service),
        "processed_date": day(processed or service), "total_billed": Decimal("100.00"),
        "total_allowed": Decimal(allowed), "total_paid": Decimal(paid),
    }


def line(claim_id, number, service="2024-01-10", code="10001", dx="A00.000"):
    return {
        "claim_line_id": claim_id * 10 + number, "claim_id": claim_id, "line_number": number, "procedure_code": code,
        "diagnosis_code": dx, "service_date": day(service), "units": Decimal("1.00"),
        "billed_amount": Decimal("100.00"), "allowed_amount": Decimal("85.00"), "paid_amount": Decimal("72.25"),
    }


def member(member_id, plan_id=1, enrolled="2020-01-01"):
    return {
        "member_id": member_id, "first_name": f"F{member_id}", "last_name": "L", "date_of_birth": day("1980-01-01"),
        "gender": "F", "plan_id": plan_id, "state": "TX", "zip_code": "10001", "enrollment_date": day(enrolled),
    }


def member_version(history_id, member_id, plan_id=1, start="2020-01-01", state="TX", zip_code="10001"):
    return {
        "history_id": history_id, "member_id": member_id, "plan_id": plan_id, "state": state, "zip_code": zip_code,
        "effective_start": day(start), "effective_end": None,
    }


def provider(provider_id, status="In-Network", specialty="Cardiology"):
    return {
        "provider_id": provider_id, "npi": f"{provider_id:010d}", "provider_name": f"P{provider_id}",
        "provider_type": "Physician", "specialty": specialty, "network_status": status, "city": "Austin",
        "state": "TX", "network_effective_date": day("2019-01-01"),
    }


def provider_version(history_id, provider_id, status="In-Network", specialty="Cardiology", start="2019-01-01", network="2019-01-01"):
    return {
        "history_id": history_id, "provider_id": provider_id, "network_status": status, "specialty": specialty,
        "effective_start": day(start), "effective_end": None, "network_effective_date": day(network),
    }


PLANS = [
    {"plan_id": i, "plan_code": f"{t}-{i}", "plan_name": f"{t} {i}", "plan_type": t, "deductible": Decimal(500),
     "oop_max": Decimal(1000), "coinsurance_pct": Decimal(10)}
    for i, t in ((1, "HMO"), (2, "PPO"))
]
DIAGNOSES = [{"diagnosis_code": "A00.000", "description": "d", "category_code": "A00", "category_name": "Infections"}]
PROCEDURES = [{"procedure_code": "10001", "description": "p", "category_name": "Surgery"}]


@pytest.fixture(scope="session")
def source_of(make):
    """Nine source tables, each with a small default."""

    def build(**rows):
        defaults = {
            "plan_types": PLANS, "diagnosis_codes": DIAGNOSES, "procedure_codes": PROCEDURES,
            "members": [member(1)], "member_plan_history": [member_version(1, 1)],
            "providers": [provider(1)], "provider_network_history": [provider_version(1, 1)],
            "claims": [], "claim_lines": [],
        }
        return {name: make(name, rows.get(name, default)) for name, default in defaults.items()}

    return build


@pytest.fixture
def store(spark, tmp_path):
    from claimloom.sources import TableStore

    return TableStore(spark, str(tmp_path / "warehouse"))
