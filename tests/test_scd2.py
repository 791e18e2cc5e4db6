"""History folding against the row-by-row definition, and the checks around it."""

from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from conftest import PLANS, day, member, member_version, provider, provider_version
from pyspark.sql import functions as F

from claimloom import schemas
from claimloom.operators import dimensions, scd2
from claimloom.operators.constraints import ConstraintError
from claimloom.session import cut_lineage

END = date(9999, 12, 31)


def by_definition(rows, opened=None):
    """Read one key's rows in order and carry the open version along."""
    versions = [] if opened is None else [opened]
    for start, _, value in sorted(rows, key=lambda r: (r[0], r[1])):
        if not versions:
            versions.append((start, value))
        elif versions[-1][0] < start and versions[-1][1] != value:
            versions.append((start, value))
    ends = [v[0] - timedelta(days=1) for v in versions[1:]] + [END]
    return [(start, value, end, end == END) for (start, value), end in zip(versions, ends)][: len(versions)]


def fold(spark, rows, opened=None):
    schema = "k bigint, effective_start date, history_id bigint, v string"
    history = spark.createDataFrame(rows, schema)
    start = None
    if opened is not None:
        start = spark.createDataFrame(opened, "k bigint, effective_start date, v string")
    return scd2.fold_history(history, "k", ["v"], opened=start)


def as_dict(df):
    found = {}
    for row in df.orderBy("k", "effective_start").collect():
        found.setdefault(row.k, []).append((row.effective_start, row.v, row.effective_end, row.is_current))
    return found


def random_history(seed, keys, days, values, most):
    rng = random.Random(seed)
    rows, history_id = [], 0
    for key in range(keys):
        for _ in range(rng.randint(1, most)):
            history_id += 1
            value = rng.choice(values)
            rows.append((key, date(2024, 1, 1) + timedelta(days=rng.randint(0, days)), rng.randint(0, 10**9) * 10_000 + history_id, value))
    return rows


@pytest.mark.parametrize(
    "seed, days, values, most",
    [(1, 3, ["a", "b"], 9), (2, 6, ["a", "b", None], 14), (3, 2, ["a", "b", "c"], 12), (4, 30, ["a", "b", None, "c"], 20)],
)
def test_fold_equals_definition(spark, seed, days, values, most):
    rows = random_history(seed, 400, days, values, most)
    expected = {}
    for key in {r[0] for r in rows}:
        expected[key] = by_definition([r[1:] for r in rows if r[0] == key])
    assert as_dict(fold(spark, rows)) == expected


@pytest.mark.parametrize("seed", [5, 6])
def test_incremental_fold_equals_definition(spark, seed):
    rows = random_history(seed, 300, 8, ["a", "b", None], 14)
    cut = date(2024, 1, 4)
    opened, expected = [], {}
    for key in {r[0] for r in rows}:
        mine = [r[1:] for r in rows if r[0] == key]
        early = by_definition([r for r in mine if r[0] <= cut])
        if early:
            opened.append((key, early[-1][0], early[-1][1]))
            expected[key] = by_definition(mine, (early[-1][0], early[-1][1]))
        else:
            expected[key] = by_definition(mine)
    # the whole history is offered again: rows up to the open version must be passed over
    late_only = {
        key: by_definition(
            [r[1:] for r in rows if r[0] == key and r[1] > dict((o[0], o[1]) for o in opened).get(key, date.min)],
            next(((o[1], o[2]) for o in opened if o[0] == key), None),
        )
        for key in expected
    }
    assert as_dict(fold(spark, rows, opened)) == late_only


def test_same_day_rows(spark):
    d1, d3 = day("2024-01-01"), day("2024-01-03")
    got = as_dict(fold(spark, [(1, d1, 1, "A"), (1, d3, 2, "A"), (1, d3, 3, "B"), (2, d1, 1, "A"), (2, d3, 2, "B"), (2, d3, 3, "C")]))
    assert got[1] == [(d1, "A", day("2024-01-02"), False), (d3, "B", END, True)]
    assert got[2] == [(d1, "A", day("2024-01-02"), False), (d3, "B", END, True)]


def test_null_and_back(spark):
    days = [day(f"2024-01-0{i}") for i in range(1, 6)]
    got = as_dict(fold(spark, list(zip([1] * 5, days, range(5), ["A", None, None, "A", "A"]))))[1]
    assert [(s, v) for s, v, _, _ in got] == [(days[0], "A"), (days[1], None), (days[3], "A")]


def test_hot_key_keeps_two_rows_per_day(spark):
    """A third of all rows on one key, most on one day: same result, and a small window input."""
    rng = random.Random(9)
    rows = random_history(9, 200, 20, ["a", "b", "c"], 6)
    base = date(2024, 1, 1)
    rows += [(-1, base + timedelta(days=rng.choice([5, 5, 5, rng.randint(0, 40)])), 10**15 + i, rng.choice("abc")) for i in range(2000)]
    folded = fold(spark, rows)
    expected = {key: by_definition([r[1:] for r in rows if r[0] == key]) for key in {r[0] for r in rows}}
    assert as_dict(folded) == expected
    plan = folded._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_apply_twice_changes_nothing(spark, make):
    history = make("member_plan_history", [
        member_version(1, 1, 1), member_version(2, 1, 2, "2021-01-01"), member_version(3, 2, 1),
        member_version(4, 2, 1, "2021-06-01"),
    ])
    members = make("members", [member(1), member(2)])
    plans = cut_lineage(dimensions.load_dim_plan(schemas.empty(spark, "dim_plan"), make("plan_types", PLANS)))
    once = cut_lineage(scd2.load_dim_member(schemas.empty(spark, "dim_member"), history, members, plans))
    twice = scd2.load_dim_member(once, history, members, plans)
    assert sorted(once.collect()) == sorted(twice.collect())
    assert once.filter("member_key <> -1").count() == 3
    scd2.check_versions(once, "dim_member", "member_id")


def test_late_history_is_not_applied_and_new_version_closes_old(spark, make):
    providers = make("providers", [provider(1)])
    first = make("provider_network_history", [provider_version(1, 1, start="2020-01-01")])
    once = cut_lineage(scd2.load_dim_provider(schemas.empty(spark, "dim_provider"), first, providers))
    more = make("provider_network_history", [
        provider_version(1, 1, start="2020-01-01"),
        provider_version(2, 1, "Out-of-Network", start="2019-06-01"),
        provider_version(3, 1, "Out-of-Network", start="2021-01-01", network="2021-01-01"),
    ])
    twice = scd2.load_dim_provider(once, more, providers)
    rows = twice.filter("provider_key <> -1").orderBy("effective_start").collect()
    assert [(r.provider_key, r.network_status, str(r.effective_start), str(r.effective_end), r.is_current) for r in rows] == [
        (1, "In-Network", "2020-01-01", "2020-12-31", False),
        (2, "Out-of-Network", "2021-01-01", "9999-12-31", True),
    ]
    assert str(rows[1].network_effective_date) == "2021-01-01"


def test_specialty_change_carries_network_date(spark, make):
    history = make("provider_network_history", [
        provider_version(1, 1, network="2018-05-01"), provider_version(2, 1, specialty="Oncology", start="2021-01-01", network="2018-05-01"),
    ])
    dim = scd2.load_dim_provider(schemas.empty(spark, "dim_provider"), history, make("providers", [provider(1)]))
    rows = dim.filter("provider_key <> -1").orderBy("effective_start").collect()
    assert [str(r.network_effective_date) for r in rows] == ["2018-05-01", "2018-05-01"]


def test_checks_raise(spark):
    schema = "provider_id bigint, effective_start date, effective_end date, is_current boolean"
    two_current = spark.createDataFrame([(1, day("2020-01-01"), day("2020-12-31"), True), (1, day("2021-01-01"), END, True)], schema)
    with pytest.raises(ConstraintError, match="more than one current"):
        scd2.check_versions(two_current, "dim_provider", "provider_id")
    nested = spark.createDataFrame(
        [(1, day("2020-01-01"), day("2022-12-31"), False), (1, day("2020-02-01"), day("2020-02-02"), False), (1, day("2021-01-01"), END, True)], schema
    )
    with pytest.raises(ConstraintError, match="overlapping"):
        scd2.check_versions(nested, "dim_provider", "provider_id")


def test_overlaps_equal_pairwise_comparison(spark):
    rng = random.Random(11)
    spans = {}
    for key in range(150):
        starts = [date(2024, 1, 1) + timedelta(days=rng.randint(0, 60)) for _ in range(rng.randint(1, 4))]
        spans[key] = [(s, s + timedelta(days=rng.randint(0, 15))) for s in starts]
    expected = {
        key for key, mine in spans.items()
        if any(a[0] <= b[1] and b[0] <= a[1] for i, a in enumerate(mine) for b in mine[i + 1:])
    }
    df = spark.createDataFrame(
        [(key, *span) for key, mine in spans.items() for span in mine], "k int, effective_start date, effective_end date"
    )
    assert {r.k for r in scd2.overlapping_versions(df, "k").collect()} == expected and expected


def versions(spark):
    rows = [(10, 1, day("2020-01-01"), day("2020-12-31")), (11, 1, day("2021-01-01"), END), (-1, -1, day("1900-01-01"), END)]
    return spark.createDataFrame(rows, "provider_key bigint, provider_id bigint, effective_start date, effective_end date")


def test_point_in_time_edges(spark):
    facts = spark.createDataFrame(
        [(1, 1, day("2020-01-01")), (2, 1, day("2020-12-31")), (3, 1, day("2021-01-01")), (4, 1, day("2019-12-31")), (5, -1, day("2020-01-01")), (6, 9, day("2020-01-01"))],
        "n bigint, provider_id bigint, d date",
    )
    got = scd2.scd2_lookup(facts, versions(spark), "dim_provider", "provider_id", "d", {"provider_key": "key"})
    assert {r.n: r.key for r in got.collect()} == {1: 10, 2: 10, 3: 11, 4: None, 5: None, 6: None}


def test_point_in_time_join_splits_a_hot_key(spark):
    """With a third of the facts on one provider the planner splits its partition at run time."""
    hot = spark.range(60_000).select(F.lit(1).cast("bigint").alias("provider_id"), F.lit(day("2020-05-05")).alias("d"), "id")
    cold = spark.range(120_000).select((F.col("id") % 5000 + 2).alias("provider_id"), F.lit(day("2021-05-05")).alias("d"), "id")
    dims = spark.range(1, 5002).select(
        (F.col("id") + 100).alias("provider_key"), F.col("id").alias("provider_id"),
        F.lit(day("2020-01-01")).alias("effective_start"), F.lit(END).alias("effective_end"),
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        facts = hot.unionByName(cold).withColumn("payload", F.md5(F.col("id").cast("string"))).repartition(32)
        joined = scd2.scd2_lookup(facts, dims, "dim_provider", "provider_id", "d", {"provider_key": "key"})
        result = joined.groupBy("key").agg(F.count("payload").alias("count"), F.max("payload"))
        counts = {r.key: r["count"] for r in result.collect()}
        plan = result._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert counts[101] == 60_000 and sum(counts.values()) == 180_000 and None not in counts
    assert "skew=true" in plan
