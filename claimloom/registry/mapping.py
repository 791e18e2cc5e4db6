"""General order tables presented as the nine source tables.

orders are claims, lineitem their lines, customer members, supplier providers, part both code
catalogs. No table has orphans, so unknown members, providers and codes and days off the calendar are
planted by number. Counts and the calendar come from the tables, so the same expressions hold at
every scale.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimloom import fixed_values as fv
from claimloom import schemas
from claimloom.functions import day_shift, pick
from claimloom.operators.keys import number_within

# Days that some rows are moved by, so that they fall off the calendar.
OFF_CALENDAR = 36_500
_GENDERS = ["F", "M", "X"]

# What these tables hold instead of the source system's plan and claim types.
VALUES = {
    "plan_types.plan_type": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"],
    "claims.claim_type": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"],
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


@dataclass(frozen=True)
class Calendar:
    """First and last day of the tables, and of them the last on which an order was placed."""

    start: date
    end: date
    last_order: date

    @property
    def days(self) -> tuple[date, date]:
        return self.start, self.end

    @property
    def utilization(self) -> tuple[date, date]:
        """The days whose months are reported for members: up to the last order."""
        return self.start, self.last_order


def calendar(spark: SparkSession, folder: str) -> Calendar:
    """The calendar that holds every order, its processing and every line. One row of dates comes to the driver."""
    day, ship = F.col("o_orderdate").cast("date"), F.col("l_shipdate").cast("date")
    processed = day_shift(day, F.col("o_orderkey") % 10)
    orders = table(spark, folder, "orders").agg(F.min(day).alias("start"), F.max(processed).alias("end"), F.max(day).alias("last"))
    lines = table(spark, folder, "lineitem").agg(F.min(ship).alias("start"), F.max(ship).alias("end"), F.lit(None).cast("date").alias("last"))
    found = orders.unionByName(lines).agg(F.min("start").alias("start"), F.max("end").alias("end"), F.max("last").alias("last")).first()
    if found.last is None:
        raise ValueError(f"no orders in {folder}")
    return Calendar(found.start, found.end, found.last)


def _count(df: DataFrame) -> Column:
    return df.agg(F.count(F.lit(1)).alias("n")).scalar()


def padded(number: str, width: int) -> Column:
    """A number with leading zeros, in full where it is longer than the width."""
    digits = F.col(number).cast("string")
    return F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), F.lit("0"))


def source_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The nine source tables, lazily."""
    customer, supplier, part, orders, lineitem, nation = (
        table(spark, folder, name) for name in ("customer", "supplier", "part", "orders", "lineitem", "nation")
    )
    plans = _plans(customer)
    members, member_history = _members(customer, plans)
    providers, provider_history = _providers(supplier, nation)
    code = F.col("p_partkey").cast("string")
    mapped = {
        "plan_types": plans,
        "diagnosis_codes": part.select(
            code.alias("diagnosis_code"), F.col("p_name").alias("description"),
            F.left("p_type", F.lit(3)).alias("category_code"), F.col("p_type").alias("category_name"),
        ),
        "procedure_codes": part.select(
            code.alias("procedure_code"), F.col("p_name").alias("description"),
            F.col("p_type").alias("category_name"),
        ),
        "members": members,
        "member_plan_history": member_history,
        "providers": providers,
        "provider_network_history": provider_history,
        "claims": _claims(orders, _count(supplier), _count(part)),
        "claim_lines": _lines(lineitem, _count(part)),
    }
    return {name: schemas.conform(df, name) for name, df in mapped.items()}


def _plans(customer: DataFrame) -> DataFrame:
    """One plan per market segment, numbered by name. Plan ids are small integers, which bounds their number."""
    segment = F.col("c_mktsegment")
    number = F.row_number().over(Window.orderBy(segment))
    return customer.select(segment).distinct().select(
        number.alias("plan_id"), F.upper(F.left(segment, F.lit(3))).alias("plan_code"), segment.alias("plan_name"),
        segment.alias("plan_type"), (number * 500).alias("deductible"), (number * 1000).alias("oop_max"),
        (number + 10).alias("coinsurance_pct"),
    )


def _members(customer: DataFrame, plans: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every member starts in 1994; even ones move to the next plan in 1996."""
    key = F.col("c_custkey")
    by_segment = plans.select(F.col("plan_name").alias("c_mktsegment"), F.col("plan_id").cast("smallint"))
    based = customer.join(F.broadcast(by_segment), "c_mktsegment").select(
        key.alias("member_id"),
        F.col("c_name").alias("first_name"),
        F.col("c_mktsegment").alias("last_name"),
        day_shift(F.lit("1955-01-01").cast("date"), key % 14_000).alias("date_of_birth"),
        pick(_GENDERS, 1 + key % 3).alias("gender"),
        padded("c_nationkey", 2).alias("state"),
        F.lpad((10_000 + key % 80_000).cast("string"), 5, "0").alias("zip_code"),
        day_shift(F.lit("1994-01-01").cast("date"), key % 1600).alias("enrollment_date"),
        F.col("plan_id").alias("first_plan"),
        (F.col("plan_id") % _count(plans) + 1).alias("second_plan"),
        (key % 2 == 0).alias("moves"),
        day_shift(F.lit("1996-01-01").cast("date"), key % 300).alias("moved_on"),
    )
    members = based.withColumn("plan_id", F.when(F.col("moves"), F.col("second_plan")).otherwise(F.col("first_plan")))
    first = based.select(
        (F.col("member_id") * 2).alias("history_id"), "member_id", F.col("first_plan").alias("plan_id"), "state",
        "zip_code", F.lit("1994-01-01").cast("date").alias("effective_start"),
        F.when(F.col("moves"), day_shift(F.col("moved_on"), -1)).alias("effective_end"),
    )
    second = based.filter("moves").select(
        (F.col("member_id") * 2 + 1).alias("history_id"), "member_id", F.col("second_plan").alias("plan_id"), "state",
        "zip_code", F.col("moved_on").alias("effective_start"), F.lit(None).cast("date").alias("effective_end"),
    )
    return members, first.unionByName(second)


def _providers(supplier: DataFrame, nation: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every provider starts in 1994; even ones change network status in 1997."""
    key = F.col("s_suppkey")
    out, inside = F.lit("Out-of-Network"), F.lit("In-Network")
    first_status = F.when(key % 5 == 0, out).otherwise(inside)
    joined_on = F.when(key % 50 == 7, F.lit("1998-01-01").cast("date")).otherwise(F.lit("1994-01-01").cast("date"))
    based = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        key.alias("provider_id"),
        padded("s_suppkey", 10).alias("npi"),
        F.col("s_name").alias("provider_name"),
        pick(["Physician", "Hospital", "Facility"], 1 + key % 3).alias("provider_type"),
        pick(fv.SPECIALTIES, 1 + key % 12).alias("specialty"),
        F.col("n_name").alias("city"),
        padded("s_nationkey", 2).alias("state"),
        first_status.alias("first_status"),
        F.when(first_status == "In-Network", out).otherwise(inside).alias("second_status"),
        joined_on.alias("network_effective_date"),
        (key % 2 == 0).alias("changes"),
        day_shift(F.lit("1997-01-01").cast("date"), key % 180).alias("changed_on"),
    )
    providers = based.withColumn(
        "network_status", F.when(F.col("changes"), F.col("second_status")).otherwise(F.col("first_status"))
    )
    first = based.select(
        (F.col("provider_id") * 2).alias("history_id"), "provider_id", F.col("first_status").alias("network_status"),
        "specialty", F.lit("1994-01-01").cast("date").alias("effective_start"),
        F.when(F.col("changes"), day_shift(F.col("changed_on"), -1)).alias("effective_end"), "network_effective_date",
    )
    second = based.filter("changes").select(
        (F.col("provider_id") * 2 + 1).alias("history_id"), "provider_id",
        F.col("second_status").alias("network_status"), "specialty", F.col("changed_on").alias("effective_start"),
        F.lit(None).cast("date").alias("effective_end"), "network_effective_date",
    )
    return providers, first.unionByName(second)


def _share(amount: Column, share: str) -> Column:
    return F.round(amount * F.lit(share).cast("decimal(3,2)"), 2)


def _claims(orders: DataFrame, suppliers: Column, parts: Column) -> DataFrame:
    key = F.col("o_orderkey")
    denied = F.col("o_orderstatus") == "P"
    ordered = F.col("o_orderdate").cast("date")
    day = F.when(key % 1000 == 2, day_shift(ordered, F.lit(OFF_CALENDAR))).otherwise(ordered)
    processed = day_shift(day, key % 10 + F.when(key % 1000 == 3, OFF_CALENDAR).otherwise(0))
    billed = F.col("o_totalprice").cast(schemas.MONEY)
    allowed = _share(billed, fv.ALLOWED_SHARE)
    return orders.select(
        key.alias("claim_id"),
        F.when(key % 1000 == 0, F.lit(-99)).otherwise(F.col("o_custkey")).alias("member_id"),
        F.when(key % 1000 == 1, F.lit(-99)).otherwise(key % suppliers).alias("provider_id"),
        (key % (parts + 5)).cast("string").alias("primary_diagnosis_code"),
        F.col("o_orderpriority").alias("claim_type"),
        F.when(denied, "Denied").otherwise("Paid").alias("claim_status"),
        F.when(denied, pick(fv.DENIAL_REASONS, 1 + key % 5)).alias("denial_reason"),
        day.alias("service_date"),
        processed.alias("processed_date"),
        billed.alias("total_billed"),
        allowed.alias("total_allowed"),
        F.when(denied, F.lit(0)).otherwise(_share(allowed, fv.PAID_SHARE)).alias("total_paid"),
    )


# whole rows are distinct, so all columns together order an order's lines totally
LINE_ORDER = [
    "l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus",
]
_MAPPED = LINE_ORDER.index("l_extendedprice") + 1


def _lines(lineitem: DataFrame, parts: Column) -> DataFrame:
    """Lines numbered afresh per order: the given numbers repeat, whole rows do not.

    Lines that agree up to the price differ in nothing that is mapped, so what comes behind it isn't moved to order them.
    """
    mapped = lineitem.select("l_orderkey", *LINE_ORDER[:_MAPPED])
    numbered = number_within(mapped, ["l_orderkey"], LINE_ORDER[0], LINE_ORDER[1:_MAPPED], "number")
    longest = lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("n")).scalar()
    claim, number = F.col("l_orderkey"), F.col("number")
    shipped = F.col("l_shipdate").cast("date")
    billed = F.col("l_extendedprice").cast(schemas.MONEY)
    allowed = _share(billed, fv.ALLOWED_SHARE)
    return numbered.select(
        (claim * (longest + 1) + number).alias("claim_line_id"),
        claim.alias("claim_id"),
        number.alias("line_number"),
        F.when((claim % 400 == 2) & (number == 1), "ZZZZZ")
        .otherwise(F.col("l_partkey").cast("string")).alias("procedure_code"),
        ((claim + number) % (parts + 5)).cast("string").alias("diagnosis_code"),
        F.when((claim % 400 == 3) & (number == 1), day_shift(shipped, F.lit(OFF_CALENDAR))).otherwise(shipped).alias("service_date"),
        F.col("l_quantity").cast("decimal(6,2)").alias("units"),
        billed.alias("billed_amount"),
        allowed.alias("allowed_amount"),
        _share(allowed, fv.PAID_SHARE).alias("paid_amount"),
    )


def event_history(spark: SparkSession, folder: str) -> DataFrame:
    """Events as a change history by day: many rows of a user share a start."""
    events = table(spark, folder, "events")
    return events.select(
        "user_id", "event_type", F.col("ts").cast("date").alias("effective_start"),
        F.struct("ts", "event_id").alias("history_id"),
    )
