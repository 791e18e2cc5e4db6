"""Keys, Type 1 loads, calendar, constraints, quality grades, integrity and expressions."""

from __future__ import annotations

from decimal import Decimal

import pytest
from conftest import DIAGNOSES, PLANS, day, member
from pyspark.sql import Window
from pyspark.sql import functions as F

from claimloom import functions as fx
from claimloom import schemas
from claimloom.operators import constraints, dimensions, keys, quality
from claimloom.operators.constraints import ConstraintError
from claimloom.plans import integrity


def test_keys_are_dense_and_do_not_depend_on_partitions(spark):
    rows = spark.range(5000).withColumn("id", F.col("id") * 7)
    one = keys.assign_keys(rows.repartition(13), "key", ["id"], 40, buckets=16)
    two = keys.assign_keys(rows.repartition(3), "key", ["id"], 40, buckets=16)
    got = one.orderBy("id").collect()
    assert got == two.orderBy("id").collect()
    assert sorted(r.key for r in got) == list(range(41, 5041))


def test_keys_by_file_are_dense(spark, tmp_path):
    folder = str(tmp_path / "rows")
    spark.range(3000).withColumn("even", F.col("id") % 2 == 0).repartition(5).write.partitionBy("even").parquet(folder)
    written = spark.read.schema("id bigint, even boolean").parquet(folder).filter("even")
    got = keys.assign_keys_by_file(written, "key", 10)
    assert sorted(r.key for r in got.collect()) == list(range(11, 1511))
    assert "Exchange hashpartitioning(id" not in got._jdf.queryExecution().executedPlan().toString()


def test_upsert_overwrites_adds_and_keeps(spark, make):
    def rows(*codes):
        return make("diagnosis_codes", [{**DIAGNOSES[0], "diagnosis_code": c, "description": d} for c, d in codes])

    once = dimensions.load_dim_diagnosis(schemas.empty(spark, "dim_diagnosis"), rows(("a", "1"), ("b", "1")))
    before = {r.diagnosis_code: r.diagnosis_key for r in once.collect()}
    twice = dimensions.load_dim_diagnosis(once, rows(("b", None), ("c", "2")))
    after = {r.diagnosis_code: (r.diagnosis_key, r.description) for r in twice.collect()}
    assert before["N/A"] == -1 and sorted(before.values()) == [-1, 1, 2]
    assert after == {"N/A": (-1, "Not Applicable"), "a": (before["a"], "1"), "b": (before["b"], None), "c": (3, "2")}


def test_calendar(spark):
    full = dimensions.load_dim_date(schemas.empty(spark, "dim_date"))
    verdict = integrity.calendar_complete({"dim_date": full}).first()
    assert (verdict.failed, verdict.detail) == (False, "4018 of 4018 days")
    again = dimensions.load_dim_date(full, "2019-12-30", "2020-01-02")
    assert again.count() == 4021 and integrity.calendar_complete({"dim_date": again.filter("date_key <> 5")}).first().failed
    row = full.filter("calendar_date = '2021-01-03'").first()
    assert (row.day_of_week, row.week_of_year, row.is_weekend, row.day_name, row.month_name, row.year_month, row.quarter_number) == (
        7, 53, True, "Sunday", "January", "2021-01", 1,
    )


def test_constraints(spark, make):
    people = make("members", [member(1), {**member(2), "gender": "Q"}, {**member(3), "gender": None}, member(3, plan_id=9)])
    report = constraints.constraint_report({"members": people, "plan_types": make("plan_types", PLANS)}, ["members"])
    bad = {(r.kind, r["name"]): r.violations for r in report.filter("violations > 0").collect()}
    assert bad == {("unique", "member_id"): 1, ("check", "gender"): 1, ("foreign key", "plan_id"): 1, ("not null", "gender"): 1}
    with pytest.raises(ConstraintError, match="planted"):
        constraints.require(spark.range(1), "planted")
    constraints.require(spark.range(0), "planted")


def test_null_keys_are_not_duplicates(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, 1), (2, 1)], "a int, b int")
    assert [tuple(r) for r in constraints.duplicate_keys(df, ["a", "b"]).collect()] == [(2, 1, 2)]


def test_grades(spark):
    checks = spark.createDataFrame(
        [(1, "empty", 0, 0), (2, "one percent", 1000, 990), (3, "more", 1000, 989)],
        "sort_order int, check_name string, total_rows_evaluated bigint, passed bigint",
    )
    graded = quality.grade(checks)
    got = {r.check_name: (r.failed, r.pass_rate, r.status) for r in graded.collect()}
    assert got == {"empty": (0, None, "FAIL"), "one percent": (10, Decimal("99.00"), "PASS"), "more": (11, Decimal("98.90"), "FAIL")}
    assert quality.findings(graded).first().findings == "empty (FAIL), more (FAIL)"


def test_failures_are_raised_together(spark):
    report = spark.createDataFrame([("b", True, "2"), ("a", True, "1"), ("c", False, "0")], "test_name string, failed boolean, detail string")
    with pytest.raises(ConstraintError, match=r"\(2\):\na: 1\nb: 2"):
        integrity.assert_integrity(report)
    integrity.assert_integrity(report.filter("not failed"))
    with pytest.raises(ConstraintError, match="x, y"):
        integrity.assert_not_empty(spark.createDataFrame([("y", 0), ("x", 0), ("z", 1)], "query_name string, result_rows int"))


def test_expressions(spark):
    df = spark.createDataFrame([(Decimal("-2.345"), 7, 0, day("2020-02-29"))], "d decimal(6,3), a int, b int, t date")
    row = df.select(
        F.round("d", 2).alias("rounded"), fx.safe_divide(F.col("a"), F.col("b")).alias("none"),
        F.add_months("t", 12).alias("later"), fx.day_shift(F.col("t"), 1).alias("next"),
        fx.days_between(F.lit(day("2020-03-02")), F.col("t")).alias("days"), fx.pick(["x", "y"], F.lit(2)).alias("second"),
        fx.make_diagnosis_code(F.lit(1)).alias("first_code"), fx.make_diagnosis_code(F.lit(12000)).alias("last_code"),
        fx.diagnosis_chapter(F.lit("R")).alias("chapter"), fx.same([F.lit(None)], [F.lit(None)]).alias("same"),
    ).first()
    assert row.rounded == Decimal("-2.35") and row.none is None and str(row.later) == "2021-02-28"
    assert str(row.next) == "2020-03-01" and row.days == 2 and row.second == "y" and row.same
    assert (row.first_code, row.last_code, row.chapter) == ("A00.000", "L66.666", "Factors influencing health status")


def test_hot_key_and_day_is_cut_in_order(spark):
    """A third of all rows share a key and a day; half of those share a value of the first order column too."""
    rows = [(1, day("2024-01-01"), 7 if i % 2 else i, -i, "x") for i in range(600)]
    rows += [(i % 50, day(f"2024-02-{1 + i % 28:02d}"), i, i % 5, "y") for i in range(1200)]
    df = spark.createDataFrame(rows, "k int, d date, a int, b int, c string").repartition(5)
    for order in (["a", "b", "c"], ["c", "a", "b"]):
        got = keys.number_within(df, ["k"], "d", order, "n")
        plain = df.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("d", *order)))
        assert sorted(got.select(*df.columns, "n").collect()) == sorted(plain.collect())
    share = F.lit(300)
    once, hot = keys._cut(df, df, ["k", "d"], "a", share, "p", None)
    assert hot.count() == 600
    twice, hot = keys._cut(once, hot, ["k", "d", "p"], "b", F.lit(100), "q", "p")
    assert hot.select("a").distinct().collect() == [(7,)]
    twice = twice.filter("k = 1 and d = date '2024-01-01'")
    sizes = sorted(r["count"] for r in twice.groupBy("p", "q").count().collect())
    assert len(sizes) > 60 and sizes[-1] < 60
    assert {r.p for r in once.filter("k <> 1").select("p").distinct().collect()} == {0}
