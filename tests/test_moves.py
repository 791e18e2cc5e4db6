"""How often rows move in a load: wide ones once, whatever is looked up for them."""

from __future__ import annotations

from conftest import claim, day, line

from claimloom import fixed_values as fv
from claimloom import schemas
from claimloom.operators import facts, keys
from claimloom.operators.gate import SOURCE_RULES, Gate
from claimloom.plans.load import reset_warehouse, run_etl
from claimloom.session import files_under


def _moved(df, capsys, *columns: str) -> list[int]:
    """How many exchanges of the plan carry each column."""
    capsys.readouterr()
    df.explain("formatted")
    inputs = [block.split("\n")[1] for block in capsys.readouterr().out.split("\n\n") if ") Exchange\n" in block]
    return [sum(f"{column}#" in line for line in inputs) for column in columns]


def test_wide_rows_move_once(make, capsys):
    """Amounts lie by their claim; versions and codes are looked up by narrow rows, and come back in the right number."""
    spark = make("claims", []).sparkSession
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        days = make("dim_date", [{"date_key": 5, "calendar_date": day("2024-01-10")}])
        codes = [{"procedure_key": -1, "procedure_code": "N/A"}, *[{"procedure_key": i, "procedure_code": str(i)} for i in (1, 2)]]
        dims = {
            "dim_date": days, "dim_procedure": make("dim_procedure", codes),
            "dim_diagnosis": make("dim_diagnosis", [{"diagnosis_key": 7, "diagnosis_code": "A00.000"}]),
        }
        span = {"effective_start": day("2024-01-01"), "effective_end": day("9999-12-31")}
        dims["dim_member"] = make("dim_member", [{"member_key": 3, "member_id": 1, "plan_key": 8, **span}])
        dims["dim_provider"] = make("dim_provider", [{"provider_key": 4, "provider_id": 1, **span}])
        # a repeated line, two lines of one code, a code that isn't in the catalog, and none
        rows = [line(1, 1, code="1"), line(1, 1, code="1"), line(1, 2, code="1"), line(1, 3, code="9"), line(2, 1, code=None), line(2, 2, code="2", dx="?")]
        lines = make("claim_lines", rows)
        headers = make("fact_claim", [{"claim_id": i, "claim_key": 10 + i, "member_key": 3, "provider_key": 4} for i in (1, 2)])
        batch = facts.resolve_lines(lines, dims, headers, schemas.empty(spark, "fact_claim_line"), schemas.empty(spark, "etl_dead_letter"))
        found = sorted(batch.select("claim_id", "line_number", "procedure_key", "diagnosis_key", "claim_key").collect())
        assert found == [(1, 1, 1, 7, 11), (1, 1, 1, 7, 11), (1, 2, 1, 7, 11), (1, 3, -1, 7, 11), (2, 1, -1, 7, 12), (2, 2, 2, -1, 12)]
        # by the calendar's day as well, which no size check keeps small here
        assert _moved(batch.drop("service_date_key"), capsys, "billed_amount") == [2]

        claims = make("claims", [claim(1), claim(1), claim(2, member_id=9), claim(3, code="?", service="2024-01-11")])
        batch = facts.resolve_claims(claims, lines, dims, schemas.empty(spark, "fact_claim"))
        found = batch.select("claim_id", "member_key", "plan_key", "provider_key", "diagnosis_key", "line_count", "reject_reason")
        assert sorted(found.collect(), key=str) == [
            (1, 3, 8, 4, 7, 4, None), (1, 3, 8, 4, 7, 4, None), (2, None, None, 4, 7, 2, fv.NO_MEMBER), (3, 3, 8, 4, -1, 0, fv.NO_SERVICE_DATE),
        ]
        assert _moved(batch, capsys, "total_allowed") == [3]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_numbering_moves_rows_once(spark):
    """Without hot keys no row moves again to be numbered by groups; the exchange of the sizes ends with the empty list of hot keys."""
    rows = spark.createDataFrame([(i % 50, day("2024-01-01"), i, "x") for i in range(500)], "k int, d date, a int, payload string")
    numbered = keys.number_within(rows, ["k"], "d", ["a"], "n")
    assert sorted((r.k, r.n, r.a) for r in numbered.collect()) == [(k, n + 1, n * 50 + k) for k in range(50) for n in range(10)]
    final = numbered._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "== Final Plan ==" in final and final.count("Exchange hashpartitioning") == 1


def test_whole_number_keys_are_not_texts(make, capsys):
    """Keys of one row count as texts only where they are, and numbers in texts don't meet numbers."""
    gate = Gate(SOURCE_RULES, schemas.CHECKS)
    lines = make("claim_lines", [line(1, 1), line(1, 1), line(11, 0), {**line(1, 10), "claim_line_id": 5}])
    codes = make("procedure_codes", [{"procedure_code": c} for c in ("1", "1", "11")])
    found = gate.key_breaches({"claim_lines": lines, "procedure_codes": codes})
    assert {(r.table_name, r.name, r.violations) for r in found.collect()} == {
        ("claim_lines", "claim_line_id", 1), ("claim_lines", "claim_id, line_number", 1), ("procedure_codes", "procedure_code", 1),
    }
    alone = gate.key_breaches({"claim_lines": lines})
    assert _moved(alone, capsys, "number0", "number1") == [1, 1]


def test_files_are_short(source_of, store):
    reset_warehouse(store)
    run_etl(store, source_of(claims=[claim(1)], claim_lines=[line(1, 1)]))
    written = [path for path in files_under(store.spark, f"{store.root}/runs/*/*/*") if path.endswith(".parquet")]
    assert written and all(path.endswith(".zstd.parquet") for path in written)
    assert store.read("fact_claim_line").count() == 1
