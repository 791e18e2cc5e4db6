"""A claims data set of any scale, computed from row numbers alone.

Every value follows from a row's own number, so no task depends on another and a retried task
writes the same rows. The planted defects are unknown members, unknown providers, unknown
procedure codes and eight claims dated before their provider's network date.
"""

from __future__ import annotations

from datetime import datetime
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom import fixed_values as fv
from claimloom import schemas
from claimloom.functions import day_shift, days_between, diagnosis_chapter, hash_uniform, make_diagnosis_code, pick
from claimloom.sources.generators import series, values_relation

# --- fixed values: volumes at scale 1, smallest volumes, catalog sizes, dates ---
FULL_SIZE = {"members": 500_000, "providers": 15_000, "claims": 2_000_000}
SMALLEST = {"members": 500, "providers": 50, "claims": 2_000}
DIAGNOSES, PROCEDURES, EARLY_CLAIMS = 12_000, 8_500, 8
PROVIDERS_FROM, NETWORK_CHANGE_FROM, FUTURE_NETWORK = "2019-01-01", "2021-01-01", "2030-01-01"
LAST_SERVICE, LAST_PROCESSED = "2026-09-30", "2026-10-06"


def sizes(scale: float) -> dict[str, int]:
    """Row counts of the scaled tables; small scales stop at a floor that keeps every defect."""
    share = Decimal(str(scale))
    if not 0 < share <= 1:
        raise ValueError("scale must be above 0 and at most 1")
    return {
        name: max(SMALLEST[name], int((full * share).to_integral_value(ROUND_HALF_UP)))
        for name, full in FULL_SIZE.items()
    }


def claims_fixture(spark: SparkSession, scale: float, seed: str = "0.42") -> dict[str, DataFrame]:
    """The nine source tables."""
    n = sizes(scale)
    places = values_relation(spark, fv.LOCATIONS, "place bigint, city string, place_state string")
    members, member_history = _members(spark, n["members"], places)
    providers, provider_history = _providers(spark, n["providers"], places)
    headers = _headers(spark, n, seed)
    lines = _lines(headers)
    tables = {
        "plan_types": values_relation(
            spark,
            [(*plan[:4], *map(Decimal, plan[4:])) for plan in fv.PLANS],
            schemas.SOURCE["plan_types"],
        ),
        "diagnosis_codes": _diagnoses(spark),
        "procedure_codes": _procedures(spark),
        "members": members,
        "member_plan_history": member_history,
        "providers": providers,
        "provider_network_history": provider_history,
        "claims": _with_totals(headers),
        "claim_lines": lines,
    }
    return {name: schemas.conform(df, name) for name, df in tables.items()}


def _diagnoses(spark: SparkSession) -> DataFrame:
    code = make_diagnosis_code(F.col("n"))
    return series(spark, 1, DIAGNOSES).select(
        code.alias("diagnosis_code"),
        F.concat(F.lit("Synthetic diagnosis "), code).alias("description"),
        F.left(code, F.lit(3)).alias("category_code"),
        diagnosis_chapter(F.left(code, F.lit(1))).alias("category_name"),
    )


def _procedures(spark: SparkSession) -> DataFrame:
    code = (F.col("n") + 10_000).cast("string")
    category = F.when(F.col("n") <= fv.PROCEDURE_CATEGORIES[0][0], fv.PROCEDURE_CATEGORIES[0][1])
    for up_to, name in fv.PROCEDURE_CATEGORIES[1:]:
        category = category.when(F.col("n") <= up_to, name)
    return series(spark, 1, PROCEDURES).select(
        code.alias("procedure_code"),
        F.concat(F.lit("Synthetic procedure "), code).alias("description"),
        category.alias("category_name"),
    )


def _enrolled_on(member: Column) -> Column:
    return day_shift(F.lit("2020-01-01").cast("date"), member % 1600)


def _five_digits(number: Column) -> Column:
    return F.lpad(number.cast("string"), 5, "0")


def _members(spark: SparkSession, count: int, places: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members as of today and their plan history: every even member changes plan once."""
    n = F.col("n")
    first_plan, first_zip = 1 + n % 8, 10_000 + n % 80_000
    base = series(spark, 1, count).join(places, n % 10 == F.col("place")).select(
        n.alias("member_id"),
        pick(fv.FIRST_NAMES, 1 + n % 12).alias("first_name"),
        pick(fv.LAST_NAMES, 1 + F.floor(n / 12) % 12).alias("last_name"),
        day_shift(F.lit("1955-01-01").cast("date"), n % 18_000).alias("date_of_birth"),
        pick(fv.GENDERS, 1 + n % 5).alias("gender"),
        _enrolled_on(n).alias("enrollment_date"),
        F.array(
            F.struct(
                F.lit(1).alias("version"),
                first_plan.alias("plan_id"),
                F.col("place_state").alias("state"),
                _five_digits(first_zip).alias("zip_code"),
                _enrolled_on(n).alias("effective_start"),
            ),
            F.struct(
                F.lit(2).alias("version"),
                (1 + first_plan % 8).alias("plan_id"),
                F.when(n % 4 == 0, "WA").otherwise(F.col("place_state")).alias("state"),
                _five_digits((first_zip + 17) % 90_000 + 10_000).alias("zip_code"),
                day_shift(_enrolled_on(n), 200 + n % 300).alias("effective_start"),
            ),
        ).alias("both"),
    )
    changes = F.col("member_id") % 2 == 0
    versions = base.withColumn("versions", F.slice("both", 1, F.when(changes, 2).otherwise(1)))
    history = versions.select(
        "member_id",
        F.explode("versions").alias("v"),
        F.when(changes, day_shift(F.element_at("both", 2)["effective_start"], -1)).alias("closed"),
    ).select(
        # the first versions of all members come first, as they would from two inserts
        (F.col("member_id") + (F.col("v.version") - 1) * count).alias("history_id"),
        "member_id", "v.plan_id", "v.state", "v.zip_code", "v.effective_start",
        F.when(F.col("v.version") == 1, F.col("closed")).alias("effective_end"),
    )
    latest = F.element_at("versions", -1)
    members = versions.select(
        "member_id", "first_name", "last_name", "date_of_birth", "gender",
        *[latest[name].alias(name) for name in ("plan_id", "state", "zip_code")], "enrollment_date",
    )
    return members, history


def _providers(spark: SparkSession, count: int, places: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Providers as of today and their history. The last one joins the network in the future."""
    n = F.col("n")
    reserved = n == count
    out, inside = F.lit("Out-of-Network"), F.lit("In-Network")
    status = F.when(reserved, inside).when(n % 5 == 0, out).otherwise(inside)
    flipped = F.when(status == "In-Network", out).otherwise(inside)
    start = F.lit(PROVIDERS_FROM).cast("date")
    changed_on = day_shift(F.lit(NETWORK_CHANGE_FROM).cast("date"), n % 180)
    joined = F.when(reserved, F.lit(FUTURE_NETWORK).cast("date")).otherwise(start)

    def unless_reserved(value: Column, fixed: str) -> Column:
        return F.when(reserved, fixed).otherwise(value)

    name = F.when(n % 15 == 0, F.concat(F.lit("Regional Hospital "), n.cast("string"))).when(
        n % 7 == 0, F.concat(F.lit("Community Facility "), n.cast("string"))
    ).otherwise(
        F.concat_ws(" ", pick(fv.PRACTICE_NAMES, 1 + n % 10), pick(fv.PRACTICE_KINDS, 1 + F.floor(n / 10) % 5))
    )
    kind = F.when(n % 15 == 0, "Hospital").when(n % 7 == 0, "Facility").otherwise("Physician")
    base = series(spark, 1, count).join(places, n % 10 == F.col("place")).select(
        n.alias("provider_id"),
        F.lpad(n.cast("string"), 10, "0").alias("npi"),
        unless_reserved(name, fv.RESERVED_PROVIDER).alias("provider_name"),
        unless_reserved(kind, "Physician").alias("provider_type"),
        unless_reserved(F.col("city"), "Austin").alias("city"),
        unless_reserved(F.col("place_state"), "TX").alias("state"),
        ((n % 2 == 0) & ~reserved).alias("changes"),
        F.array(
            F.struct(
                F.lit(1).alias("version"),
                status.alias("network_status"),
                unless_reserved(pick(fv.SPECIALTIES, 1 + (n + 3) % 12), "Family Medicine").alias("specialty"),
                start.alias("effective_start"),
                joined.alias("network_effective_date"),
            ),
            F.struct(
                F.lit(2).alias("version"),
                F.when(n % 4 == 0, flipped).otherwise(status).alias("network_status"),
                pick(fv.SPECIALTIES, 1 + n % 12).alias("specialty"),
                changed_on.alias("effective_start"),
                F.when(n % 4 == 0, changed_on).otherwise(joined).alias("network_effective_date"),
            ),
        ).alias("both"),
    )
    versions = base.withColumn("versions", F.slice("both", 1, F.when(F.col("changes"), 2).otherwise(1)))
    history = versions.select(
        "provider_id",
        F.explode("versions").alias("v"),
        F.when(F.col("changes"), day_shift(F.element_at("both", 2)["effective_start"], -1)).alias("closed"),
    ).select(
        (F.col("provider_id") + (F.col("v.version") - 1) * count).alias("history_id"),
        "provider_id", "v.network_status", "v.specialty", "v.effective_start",
        F.when(F.col("v.version") == 1, F.col("closed")).alias("effective_end"),
        "v.network_effective_date",
    )
    latest = F.element_at("versions", -1)
    providers = versions.select(
        "provider_id", "npi", "provider_name", "provider_type", latest["specialty"].alias("specialty"),
        latest["network_status"].alias("network_status"), "city", "state",
        latest["network_effective_date"].alias("network_effective_date"),
    )
    return providers, history


def _headers(spark: SparkSession, n: dict[str, int], seed: str) -> DataFrame:
    """Claim headers without money. Providers follow a cubic draw: low numbers get most claims."""
    claim = F.col("claim_id")
    regular = series(spark, 1, n["claims"], "claim_id")
    anchor = F.when(claim % 1000 == 0, F.lit(1)).otherwise(1 + (claim * 13) % n["members"])
    enrolled = _enrolled_on(anchor)
    span = F.greatest(days_between(F.lit(LAST_SERVICE).cast("date"), enrolled), F.lit(1))
    draw = F.floor(F.pow(hash_uniform(seed, claim), F.lit(3.0)) * (n["providers"] - 1))
    service = day_shift(enrolled, (claim * 17) % span)
    drawn = regular.select(
        claim,
        F.when(claim % 1000 == 0, F.lit(0)).otherwise(anchor).cast("bigint").alias("member_id"),
        F.when(claim % 1000 == 1, F.lit(0)).otherwise(1 + draw).cast("bigint").alias("provider_id"),
        make_diagnosis_code(1 + claim % DIAGNOSES).alias("primary_diagnosis_code"),
        F.when(claim % 25 == 0, "Inpatient").when(claim % 7 == 0, "Emergency")
        .when(claim % 3 == 0, "Outpatient").otherwise("Professional").alias("claim_type"),
        F.when(claim % 20 == 0, "Denied").otherwise("Paid").alias("claim_status"),
        F.when(claim % 20 == 0, pick(fv.DENIAL_REASONS, 1 + F.floor(claim / 20) % 5)).alias("denial_reason"),
        service.alias("service_date"),
        F.least(day_shift(service, claim % 10), F.lit(LAST_PROCESSED).cast("date")).alias("processed_date"),
    )
    early = series(spark, 1, EARLY_CLAIMS, "member_id").select(
        (F.col("member_id") + n["claims"]).alias("claim_id"),
        "member_id",
        F.lit(n["providers"]).cast("bigint").alias("provider_id"),
        make_diagnosis_code(F.col("member_id")).alias("primary_diagnosis_code"),
        F.lit("Professional").alias("claim_type"),
        F.lit("Paid").alias("claim_status"),
        F.lit(None).cast("string").alias("denial_reason"),
        F.lit("2024-06-01").cast("date").alias("service_date"),
        F.lit("2024-06-05").cast("date").alias("processed_date"),
    )
    return drawn.unionByName(early)


def _amounts(claim: Column, claim_type: Column, claim_status: Column) -> dict[str, Column]:
    """Billed, allowed and paid amount of one line; all lines of a claim carry the same."""
    billed = (
        F.when(claim_type == "Inpatient", 1800 + claim % 9000)
        .when(claim_type == "Emergency", 400 + claim % 2000)
        .otherwise(50 + claim % 450)
    ).cast(schemas.MONEY)
    allowed = F.round(billed * F.lit(fv.ALLOWED_SHARE).cast("decimal(3,2)"), 2)
    paid = F.when(claim_status == "Denied", F.lit(0)).otherwise(
        F.round(allowed * F.lit(fv.PAID_SHARE).cast("decimal(3,2)"), 2)
    )
    return {"billed": billed, "allowed": allowed.cast(schemas.MONEY), "paid": paid.cast(schemas.MONEY)}


def _lines_per_claim(claim: Column) -> Column:
    return F.when(claim % 4 == 0, 3).otherwise(4)


def _lines(headers: DataFrame) -> DataFrame:
    claim, number = F.col("claim_id"), F.col("line_number")
    money = _amounts(claim, F.col("claim_type"), F.col("claim_status"))
    fanned = headers.withColumn("line_number", F.explode(F.sequence(F.lit(1), _lines_per_claim(claim))))
    return fanned.select(
        (claim * 10 + number).alias("claim_line_id"),
        claim,
        number,
        F.when((claim % 4000 == 2) & (number == 1), "ZZZZZ")
        .otherwise((10_001 + (claim + number) % PROCEDURES).cast("string")).alias("procedure_code"),
        make_diagnosis_code(1 + (claim + number) % DIAGNOSES).alias("diagnosis_code"),
        "service_date",
        (1 + number % 3).alias("units"),
        *[money[name].alias(f"{name}_amount") for name in money],
    )


def _with_totals(headers: DataFrame) -> DataFrame:
    """Header totals are the line sums; lines of a claim are equal, so no join back is needed."""
    claim = F.col("claim_id")
    money = _amounts(claim, F.col("claim_type"), F.col("claim_status"))
    totals = [(value * _lines_per_claim(claim)).alias(f"total_{name}") for name, value in money.items()]
    return headers.select("*", *totals)


def load_profile(source: dict[str, DataFrame], scale: float | None, now: datetime) -> DataFrame:
    """The one-row record of the source volumes; each run replaces the row.

    Without a scale it is the share that the claims are of those at scale 1. Rows are counted from file
    footers.
    """
    counts = [
        source[table].agg(F.count(F.lit(1)).alias(column))
        for table, column in (
            ("members", "member_count"), ("providers", "provider_count"),
            ("claims", "claim_count"), ("claim_lines", "claim_line_count"),
        )
    ]
    spark = source["members"].sparkSession
    share = counts[2].scalar() / FULL_SIZE["claims"] if scale is None else F.lit(str(scale))
    row = spark.range(1).select(
        F.lit(1).alias("profile_id"),
        share.cast("decimal(8,4)").alias("scale_factor"),
        *[c.scalar().alias(c.columns[0]) for c in counts],
        F.lit(now).alias("generated_at"),
    )
    return schemas.conform(row, "load_profile")
