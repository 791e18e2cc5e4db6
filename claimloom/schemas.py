"""Explicit schemas and keys of every source, warehouse and audit table."""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

MONEY = "decimal(12,2)"

# Column lists are fixed values: the table contract users of the warehouse query against.
SOURCE = {
    "plan_types": "plan_id smallint, plan_code string, plan_name string, plan_type string, "
    "deductible decimal(10,2), oop_max decimal(10,2), coinsurance_pct decimal(5,2)",
    "diagnosis_codes": "diagnosis_code string, description string, category_code string, category_name string",
    "procedure_codes": "procedure_code string, description string, category_name string",
    "members": "member_id bigint, first_name string, last_name string, date_of_birth date, gender string, "
    "plan_id smallint, state string, zip_code string, enrollment_date date",
    "member_plan_history": "history_id bigint, member_id bigint, plan_id smallint, state string, "
    "zip_code string, effective_start date, effective_end date",
    "providers": "provider_id bigint, npi string, provider_name string, provider_type string, "
    "specialty string, network_status string, city string, state string, network_effective_date date",
    "provider_network_history": "history_id bigint, provider_id bigint, network_status string, "
    "specialty string, effective_start date, effective_end date, network_effective_date date",
    "claims": "claim_id bigint, member_id bigint, provider_id bigint, primary_diagnosis_code string, "
    "claim_type string, claim_status string, denial_reason string, service_date date, processed_date date, "
    "total_billed decimal(12,2), total_allowed decimal(12,2), total_paid decimal(12,2)",
    "claim_lines": "claim_line_id bigint, claim_id bigint, line_number int, procedure_code string, "
    "diagnosis_code string, service_date date, units decimal(6,2), billed_amount decimal(12,2), "
    "allowed_amount decimal(12,2), paid_amount decimal(12,2)",
}

WAREHOUSE = {
    "dim_date": "date_key bigint, calendar_date date, year_number smallint, quarter_number smallint, "
    "month_number smallint, month_name string, day_of_month smallint, day_of_week smallint, "
    "day_name string, week_of_year smallint, is_weekend boolean, year_month string",
    "dim_plan": "plan_key bigint, plan_id smallint, plan_code string, plan_name string, plan_type string, "
    "deductible decimal(10,2), oop_max decimal(10,2), coinsurance_pct decimal(5,2)",
    "dim_diagnosis": "diagnosis_key bigint, diagnosis_code string, description string, "
    "category_code string, category_name string",
    "dim_procedure": "procedure_key bigint, procedure_code string, description string, category_name string",
    "dim_member": "member_key bigint, member_id bigint, first_name string, last_name string, "
    "date_of_birth date, gender string, plan_key bigint, plan_id smallint, state string, zip_code string, "
    "enrollment_date date, effective_start date, effective_end date, is_current boolean",
    "dim_provider": "provider_key bigint, provider_id bigint, npi string, provider_name string, "
    "provider_type string, specialty string, network_status string, city string, state string, "
    "network_effective_date date, effective_start date, effective_end date, is_current boolean",
    "fact_claim": "claim_key bigint, claim_id bigint, member_key bigint, provider_key bigint, plan_key bigint, "
    "primary_diagnosis_key bigint, service_date_key bigint, processed_date_key bigint, claim_type string, "
    "claim_status string, denial_reason string, total_billed decimal(12,2), total_allowed decimal(12,2), "
    "total_paid decimal(12,2), member_responsibility decimal(12,2), line_count int, loaded_at timestamp",
    "fact_claim_line": "claim_line_key bigint, claim_key bigint, claim_id bigint, line_number int, "
    "member_key bigint, provider_key bigint, procedure_key bigint, diagnosis_key bigint, "
    "service_date_key bigint, source_procedure_code string, units decimal(6,2), billed_amount decimal(12,2), "
    "allowed_amount decimal(12,2), paid_amount decimal(12,2), loaded_at timestamp",
    "monthly_claim_volume": "year_month string, month_start date, claim_count bigint, total_paid decimal(22,2)",
}

AUDIT = {
    "etl_watermark": "pipeline_name string, high_water_mark date, rows_loaded bigint, updated_at timestamp",
    "etl_dead_letter": "dead_letter_id bigint, pipeline_name string, source_table string, source_key string, "
    "reject_reason string, rejected_at timestamp",
    "load_profile": "profile_id smallint, scale_factor decimal(8,4), member_count bigint, "
    "provider_count bigint, claim_count bigint, claim_line_count bigint, generated_at timestamp",
}

STAGING = {
    "claim_load_batch": "claim_id bigint, member_key bigint, provider_key bigint, plan_key bigint, "
    "service_date_key bigint, processed_date_key bigint, diagnosis_key bigint, claim_type string, "
    "claim_status string, denial_reason string, total_billed decimal(12,2), total_allowed decimal(12,2), "
    "total_paid decimal(12,2), line_count int, processed_date date, reject_reason string",
}

ALL = {**SOURCE, **WAREHOUSE, **AUDIT, **STAGING}

# The longest text of each column, in characters. Keys are numbers or bounded texts.
LENGTHS = {
    "plan_types": {"plan_code": 10, "plan_name": 40, "plan_type": 10},
    "diagnosis_codes": {"diagnosis_code": 10, "description": 160, "category_code": 7, "category_name": 80},
    "procedure_codes": {"procedure_code": 10, "description": 160, "category_name": 80},
    "members": {"first_name": 40, "last_name": 40, "gender": 1, "state": 2, "zip_code": 10},
    "member_plan_history": {"state": 2, "zip_code": 10},
    "providers": {
        "npi": 10, "provider_name": 80, "provider_type": 20, "specialty": 40, "network_status": 20, "city": 40, "state": 2,
    },
    "provider_network_history": {"network_status": 20, "specialty": 40},
    "claims": {"primary_diagnosis_code": 10, "claim_type": 20, "claim_status": 20, "denial_reason": 40},
    "claim_lines": {"procedure_code": 10, "diagnosis_code": 10},
    "dim_date": {"month_name": 20, "day_name": 20, "year_month": 7},
    "dim_plan": {"plan_code": 10, "plan_name": 40, "plan_type": 10},
    "dim_diagnosis": {"diagnosis_code": 10, "description": 160, "category_code": 7, "category_name": 80},
    "dim_procedure": {"procedure_code": 10, "description": 160, "category_name": 80},
    "dim_member": {"first_name": 40, "last_name": 40, "gender": 1, "state": 2, "zip_code": 10},
    "dim_provider": {
        "npi": 10, "provider_name": 80, "provider_type": 20, "specialty": 40, "network_status": 20, "city": 40, "state": 2,
    },
    "fact_claim": {"claim_type": 20, "claim_status": 20, "denial_reason": 40},
    "fact_claim_line": {"source_procedure_code": 10},
    "etl_watermark": {"pipeline_name": 50},
    "etl_dead_letter": {"pipeline_name": 50, "source_table": 63, "reject_reason": 200},
}

# Natural keys (checked with the unique constraint) and columns that may be null.
UNIQUE = {
    "plan_types": [["plan_id"], ["plan_code"]],
    "diagnosis_codes": [["diagnosis_code"]],
    "procedure_codes": [["procedure_code"]],
    "members": [["member_id"]],
    "member_plan_history": [["history_id"]],
    "providers": [["provider_id"], ["npi"]],
    "provider_network_history": [["history_id"]],
    "claims": [["claim_id"]],
    "claim_lines": [["claim_line_id"], ["claim_id", "line_number"]],
    "dim_date": [["date_key"], ["calendar_date"]],
    "dim_plan": [["plan_key"], ["plan_id"]],
    "dim_diagnosis": [["diagnosis_key"], ["diagnosis_code"]],
    "dim_procedure": [["procedure_key"], ["procedure_code"]],
    "dim_member": [["member_key"], ["member_id", "effective_start"]],
    "dim_provider": [["provider_key"], ["provider_id", "effective_start"]],
    "fact_claim": [["claim_key"], ["claim_id"]],
    "fact_claim_line": [["claim_line_key"], ["claim_id", "line_number"]],
    "monthly_claim_volume": [["year_month"]],
    "etl_watermark": [["pipeline_name"]],
    "etl_dead_letter": [["dead_letter_id"]],
    "load_profile": [["profile_id"]],
}

NULLABLE = {
    "member_plan_history": {"effective_end"},
    "provider_network_history": {"effective_end"},
    "claims": {"denial_reason"},
    "dim_date": {"calendar_date"},
    "dim_member": {"date_of_birth"},
    "fact_claim": {"denial_reason"},
    "etl_watermark": {"high_water_mark"},
    "load_profile": {"member_count", "provider_count", "claim_count", "claim_line_count"},
}

# Table -> [(foreign key column, referenced table, referenced column)]
REFERENCES = {
    "members": [("plan_id", "plan_types", "plan_id")],
    "member_plan_history": [("member_id", "members", "member_id"), ("plan_id", "plan_types", "plan_id")],
    "provider_network_history": [("provider_id", "providers", "provider_id")],
    "claim_lines": [("claim_id", "claims", "claim_id")],
    "dim_member": [("plan_key", "dim_plan", "plan_key")],
    "fact_claim": [
        ("member_key", "dim_member", "member_key"),
        ("provider_key", "dim_provider", "provider_key"),
        ("plan_key", "dim_plan", "plan_key"),
        ("primary_diagnosis_key", "dim_diagnosis", "diagnosis_key"),
        ("service_date_key", "dim_date", "date_key"),
        ("processed_date_key", "dim_date", "date_key"),
    ],
    "fact_claim_line": [
        ("claim_key", "fact_claim", "claim_key"),
        ("member_key", "dim_member", "member_key"),
        ("provider_key", "dim_provider", "provider_key"),
        ("procedure_key", "dim_procedure", "procedure_key"),
        ("diagnosis_key", "dim_diagnosis", "diagnosis_key"),
        ("service_date_key", "dim_date", "date_key"),
    ],
}

# Table -> {name: predicate that a row must not fail; null counts as a pass}
CHECKS = {
    "plan_types": {"plan type": "plan_type in ('HMO', 'PPO', 'EPO', 'HDHP')"},
    "members": {"gender": "gender in ('F', 'M', 'X')"},
    "member_plan_history": {"dates": "effective_end is null or effective_end >= effective_start"},
    "providers": {
        "provider type": "provider_type in ('Physician', 'Hospital', 'Facility')",
        "network status": "network_status in ('In-Network', 'Out-of-Network')",
    },
    "provider_network_history": {
        "dates": "effective_end is null or effective_end >= effective_start",
        "network status": "network_status in ('In-Network', 'Out-of-Network')",
    },
    "claims": {
        "claim type": "claim_type in ('Professional', 'Inpatient', 'Outpatient', 'Emergency')",
        "claim status": "claim_status in ('Paid', 'Denied')",
        "processed": "processed_date >= service_date",
    },
    "claim_lines": {"amounts": "billed_amount >= 0 and allowed_amount >= 0 and paid_amount >= 0 and units > 0"},
    "dim_plan": {"plan type": "plan_type in ('HMO', 'PPO', 'EPO', 'HDHP', 'N/A')"},
    "dim_member": {
        "gender": "gender in ('F', 'M', 'X', 'U')",
        "dates": "effective_end >= effective_start",
    },
    "dim_provider": {"dates": "effective_end >= effective_start"},
    "fact_claim": {
        "amounts": "total_billed >= 0 and total_allowed >= 0 and total_paid >= 0 "
        "and member_responsibility >= 0 and line_count >= 0"
    },
    "fact_claim_line": {"amounts": "billed_amount >= 0 and allowed_amount >= 0 and paid_amount >= 0 and units > 0"},
    "load_profile": {"singleton": "profile_id = 1"},
}


@cache
def struct(table: str) -> T.StructType:
    return T.StructType.fromDDL(ALL[table])


def columns(table: str) -> list[str]:
    return struct(table).fieldNames()


def empty(spark: SparkSession, table: str) -> DataFrame:
    """The table without rows, in a form the optimizer recognises: joins with it are planned away."""
    columns = [f"cast(null as {f.dataType.simpleString()}) as {f.name}" for f in struct(table)]
    return spark.range(1).filter("false").selectExpr(*columns)


def checks_for(values: dict[str, list[str]]) -> dict[str, dict[str, str]]:
    """The declared checks with other lists of values: ``{"table.column": allowed}``."""
    checks = {table: dict(named) for table, named in CHECKS.items()}
    for place, allowed in values.items():
        table, column = place.split(".")
        listed = ", ".join("'" + value.replace("'", "''") + "'" for value in allowed)
        checks[table][column.replace("_", " ")] = f"{column} in ({listed})"
    return checks


def conform(df: DataFrame, table: str, also: tuple[str, ...] = ()) -> DataFrame:
    """Project to the table's columns and types, and columns to keep as they are.

    An overflowing or malformed value is an error, and so is a text beyond its declared length.
    """
    longest = LENGTHS.get(table, {})

    def typed(name: str, kind: str) -> str:
        value = f"cast({name} as {kind})"
        if name in longest:
            told = f"concat('{table}.{name} is longer than {longest[name]}: ', {name})"
            value = f"if(length({value}) > {longest[name]}, cast(raise_error({told}) as string), {value})"
        return f"{value} as {name}"

    return df.selectExpr(*[typed(f.name, f.dataType.simpleString()) for f in struct(table)], *also)
