"""The data-quality report: seven counting checks against a one per cent tolerance."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.fixed_values import UNKNOWN_KEY
from claimloom.functions import safe_divide
from claimloom.operators.dimensions import key_of, real_rows

# --- fixed values: check names, in report order ---
VALID_KEYS = "fact_claim valid service date, processed date, member, and provider keys"
PAID_RATIO = "fact_claim total_paid within 5% of total_allowed"
ONE_MEMBER = "dim_member one current row per member"
ONE_PROVIDER = "dim_provider one current row per provider"
HEADER_EXISTS = "fact_claim_line claim_id exists on fact_claim"
PROCEDURE_EXISTS = "fact_claim_line procedure code exists on dim_procedure"
NETWORK_DATE = "fact_claim service date on or after provider network_effective_date"


def _result(order: int, name: str, evaluated: Column, passed: Column) -> list[Column]:
    return [
        F.lit(order).alias("sort_order"), F.lit(name).alias("check_name"),
        F.coalesce(evaluated, F.lit(0)).cast("bigint").alias("total_rows_evaluated"),
        F.coalesce(passed, F.lit(0)).cast("bigint").alias("passed"),
    ]


# Marks of a key value: roles in which it does not resolve to a real row, and in which it has no row at all.
_BAD = {"service_date_key": 1, "processed_date_key": 2, "member_key": 4, "provider_key": 8}
_ABSENT = {"service_date_key": 16, "provider_key": 32}
# Above them the day, from 1, before which a provider version's claims are early; the highest: always.
_DAY_SHIFT, _ALWAYS, _EPOCH = 8, (1 << 31) - 1, 1_000_000


def _suspects(tables: dict[str, DataFrame]) -> DataFrame:
    """``key, mark``: key values of the claims that something may be wrong with; mostly none.

    One scan gives the distinct key values of all four roles with the earliest service day of each; only
    they meet the dimensions, whose own keys are distinct.
    """
    fact = tables["fact_claim"].select(*_BAD)
    days = tables["dim_date"].select(F.col("date_key").alias("service_date_key"), "calendar_date")
    roles = F.array(*[F.struct(F.col(c).alias("key"), F.lit(bit).alias("role")) for c, bit in _BAD.items()])
    spread = fact.join(days, "service_date_key", "left").select("calendar_date", F.explode(roles).alias("r"))
    used = spread.select("r.key", "r.role", F.when(F.col("r.role") == _BAD["provider_key"], F.col("calendar_date")).alias("day"))
    provider = F.col("role") == _BAD["provider_key"]
    keys = used.groupBy("key").agg(
        F.bit_or("role").alias("roles"), F.min("day").alias("first_day"), F.count_if(provider & F.col("day").isNull()).alias("dayless")
    )
    real, known = {}, {}
    for table in ("dim_date", "dim_member", "dim_provider"):
        key = key_of(table)
        columns = ["network_effective_date"] if table == "dim_provider" else []
        rows = tables[table].select(F.col(key).alias("key"), *columns, (F.col(key) != UNKNOWN_KEY).alias(f"real_{table}"))
        keys = keys.join(rows, "key", "left")
        real[table], known[table] = F.coalesce(f"real_{table}", F.lit(False)), F.col(f"real_{table}").isNotNull()
    bad = [
        (_BAD[c], ~real[table]) for c, table in
        (("service_date_key", "dim_date"), ("processed_date_key", "dim_date"), ("member_key", "dim_member"), ("provider_key", "dim_provider"))
    ]
    mark = F.lit(0).cast("bigint")
    for bit, wrong in bad:
        mark = mark + F.when((F.col("roles").bitwiseAND(F.lit(bit)) != 0) & wrong, bit).otherwise(0)
    for role, bit in _ABSENT.items():
        table = "dim_date" if role == "service_date_key" else "dim_provider"
        mark = mark + F.when((F.col("roles").bitwiseAND(F.lit(_BAD[role])) != 0) & ~known[table], bit).otherwise(0)
    since = F.coalesce(F.unix_date("network_effective_date") + _EPOCH, F.lit(_ALWAYS)).cast("bigint")
    on_time = (F.col("dayless") == 0) & (F.col("first_day") >= F.col("network_effective_date"))
    early = (F.col("roles").bitwiseAND(F.lit(_BAD["provider_key"])) != 0) & known["dim_provider"] & ~F.coalesce(on_time, F.lit(False))
    mark = mark + F.when(early, F.shiftleft(since, _DAY_SHIFT)).otherwise(0)
    return keys.select("key", mark.alias("mark")).filter("mark <> 0")


def _fact_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """The three checks on single claims, as report rows, from one aggregate over one scan.

    The scan meets only the suspect keys, so nothing of the fact is shuffled while they are few.
    """
    suspects = _suspects(tables)
    found = tables["fact_claim"].select(*_BAD, "total_paid", "total_allowed")
    for column in _BAD:  # the same relation for each role, so that it is worked out once
        found = found.join(suspects.select(F.col("key").alias(column), F.col("mark").alias(f"mark_{column}")), column, "left")
    days = tables["dim_date"].select(F.col("date_key").alias("service_date_key"), "calendar_date")
    found = found.join(days, "service_date_key", "left")
    marks = {c: F.coalesce(f"mark_{c}", F.lit(0).cast("bigint")) for c in _BAD}
    good = reduce(Column.__and__, [marks[c].bitwiseAND(F.lit(bit)) == 0 for c, bit in _BAD.items()])
    evaluated = reduce(Column.__and__, [marks[c].bitwiseAND(F.lit(bit)) == 0 for c, bit in _ABSENT.items()])
    since = F.shiftright(marks["provider_key"], _DAY_SHIFT)
    on_time = (since == 0) | F.coalesce((since != _ALWAYS) & (F.unix_date("calendar_date") + _EPOCH >= since), F.lit(False))
    limit = F.col("total_allowed") * F.lit("1.05").cast("decimal(3,2)")
    sums = found.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(good).alias("good"), F.count_if(~(F.col("total_paid") > limit)).alias("paid"),
        F.count_if(evaluated).alias("evaluated"), F.count_if(evaluated & on_time).alias("on_time"),
    )
    results = [(1, VALID_KEYS, "rows", "good"), (2, PAID_RATIO, "rows", "paid"), (7, NETWORK_DATE, "evaluated", "on_time")]
    rows = F.array(*[F.struct(*_result(n, name, F.col(a), F.col(b))) for n, name, a, b in results])
    return sums.select(F.explode(rows).alias("r")).select("r.*")


def valid_keys(tables: dict[str, DataFrame]) -> DataFrame:
    """Claims whose dates, member and provider all resolve to a real dimension row."""
    return _fact_checks(tables).filter("sort_order = 1")


def paid_ratio(tables: dict[str, DataFrame]) -> DataFrame:
    """Claims not paid more than 5% above the allowed amount."""
    limit = F.col("total_allowed") * F.lit("1.05").cast("decimal(3,2)")
    return tables["fact_claim"].agg(
        *_result(2, PAID_RATIO, F.count(F.lit(1)), F.count_if(~(F.col("total_paid") > limit)))
    )


def _one_current(order: int, name: str, dim: DataFrame, table: str, key: str) -> DataFrame:
    per_key = real_rows(dim, table).groupBy(key).agg(F.count_if("is_current").alias("current_rows"))
    return per_key.agg(*_result(order, name, F.count(F.lit(1)), F.count_if(F.col("current_rows") == 1)))


def one_current_member(tables: dict[str, DataFrame]) -> DataFrame:
    return _one_current(3, ONE_MEMBER, tables["dim_member"], "dim_member", "member_id")


def one_current_provider(tables: dict[str, DataFrame]) -> DataFrame:
    return _one_current(4, ONE_PROVIDER, tables["dim_provider"], "dim_provider", "provider_id")


def header_exists(tables: dict[str, DataFrame]) -> DataFrame:
    """Lines whose claim is on the header fact; lines are counted per claim before the join."""
    per_claim = tables["fact_claim_line"].groupBy("claim_id").agg(F.count(F.lit(1)).alias("rows"))
    headers = tables["fact_claim"].select("claim_id", F.lit(True).alias("found"))
    joined = per_claim.join(headers, "claim_id", "left")
    return joined.agg(*_result(5, HEADER_EXISTS, F.sum("rows"), F.sum(F.when(F.col("found"), F.col("rows")))))


def procedure_exists(tables: dict[str, DataFrame]) -> DataFrame:
    """Lines whose received procedure code is in the catalog; lines are counted per code first."""
    per_code = tables["fact_claim_line"].groupBy("source_procedure_code").agg(F.count(F.lit(1)).alias("rows"))
    known = real_rows(tables["dim_procedure"], "dim_procedure").select(
        F.col("procedure_code").alias("source_procedure_code"), F.lit(True).alias("found")
    )
    joined = per_code.join(known, "source_procedure_code", "left")
    return joined.agg(*_result(6, PROCEDURE_EXISTS, F.sum("rows"), F.sum(F.when(F.col("found"), F.col("rows")))))


def network_date(tables: dict[str, DataFrame]) -> DataFrame:
    """Claims served on or after their provider version's network date, counted per version and day."""
    per_day = tables["fact_claim"].groupBy("provider_key", "service_date_key").agg(F.count(F.lit(1)).alias("rows"))
    joined = per_day.join(
        tables["dim_provider"].select("provider_key", "network_effective_date"), "provider_key"
    ).join(tables["dim_date"].select(F.col("date_key").alias("service_date_key"), "calendar_date"), "service_date_key")
    on_time = F.col("calendar_date") >= F.col("network_effective_date")
    return joined.agg(*_result(7, NETWORK_DATE, F.sum("rows"), F.sum(F.when(on_time, F.col("rows")))))


CHECKS = [
    valid_keys, paid_ratio, one_current_member, one_current_provider, header_exists, procedure_exists, network_date,
]


def quality_report(tables: dict[str, DataFrame]) -> DataFrame:
    """All checks with failures, pass rate and PASS or FAIL. A finding never stops a load."""
    others = [check(tables) for check in CHECKS if check not in (valid_keys, paid_ratio, network_date)]
    return grade(reduce(DataFrame.unionByName, [_fact_checks(tables), *others]))


def grade(checks: DataFrame) -> DataFrame:
    """PASS needs at least one evaluated row and at most 1% failed ones."""
    evaluated, passed = F.col("total_rows_evaluated"), F.col("passed")
    failed = evaluated - passed
    percent = F.round(safe_divide(F.lit("100.0").cast("decimal(4,1)") * passed, evaluated), 2)
    status = F.when((evaluated > 0) & (failed * 100 <= evaluated), "PASS").otherwise("FAIL")
    return checks.select(
        "sort_order", "check_name", "total_rows_evaluated", "passed", failed.alias("failed"),
        percent.alias("pass_rate"), status.alias("status"),
    )


def findings(report: DataFrame) -> DataFrame:
    """One text naming every check that did not pass, in report order; null if all did."""
    failing = F.struct("sort_order", F.concat("check_name", F.lit(" ("), "status", F.lit(")")).alias("text"))
    return report.filter("status <> 'PASS'").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(failing)), lambda f: f["text"]), ", ").alias("findings")
    )


__all__ = ["CHECKS", "findings", "grade", "quality_report"]
