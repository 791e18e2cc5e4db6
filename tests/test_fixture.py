"""The claims fixture: volumes, planted defects, and a full load of it."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from claimloom.operators.constraints import constraint_report
from claimloom.plans.rebuild import rebuild
from claimloom.plans.views import register_views
from claimloom.sources import TableStore, claims_fixture, load_profile, read_source, write_source
from claimloom.sources.fixture import sizes


def test_sizes():
    assert sizes(1) == {"members": 500_000, "providers": 15_000, "claims": 2_000_000}
    assert sizes(0.05) == {"members": 25_000, "providers": 750, "claims": 100_000}
    assert sizes(0.0001) == {"members": 500, "providers": 50, "claims": 2_000}
    with pytest.raises(ValueError):
        sizes(0)


def test_defects_at_the_documented_scale(spark):
    """The published counts of scale 0.05 follow from the rows alone."""
    source = claims_fixture(spark, 0.05)
    claims, lines = source["claims"], source["claim_lines"]
    assert (claims.count(), lines.count()) == (100_008, 375_030)
    unknown = claims.filter("member_id = 0 or provider_id = 0")
    assert unknown.count() == 200 and lines.join(unknown, "claim_id", "left_semi").count() == 700
    placed = lines.join(unknown, "claim_id", "left_anti")
    assert placed.filter("procedure_code = 'ZZZZZ'").count() == 26
    late = source["providers"].filter("network_effective_date = '2030-01-01'").select("provider_id")
    assert claims.join(late, "provider_id", "left_semi").count() == 8
    assert (source["member_plan_history"].count(), source["provider_network_history"].count()) == (37_500, 1_124)
    share = claims.filter("provider_id > 0").agg(F.avg((F.col("provider_id") <= 75).cast("int"))).first()[0]
    assert 0.42 < share < 0.51  # a cubic draw puts the cube root of a tenth of the providers' range first


def test_full_load(spark, tmp_path):
    write_source(claims_fixture(spark, 0.001), str(tmp_path / "source"))
    source = read_source(spark, str(tmp_path / "source"))
    assert constraint_report(source).filter("violations > 0").collect() == []
    store = TableStore(spark, str(tmp_path / "warehouse"))
    graded = rebuild(store, source)
    report = {r.sort_order: (r.failed, r.status) for r in graded.collect()}
    assert report == {1: (0, "PASS"), 2: (0, "PASS"), 3: (0, "PASS"), 4: (0, "PASS"), 5: (0, "PASS"), 6: (1, "PASS"), 7: (8, "PASS")}
    tables = store.read_all()
    assert (tables["fact_claim"].count(), tables["fact_claim_line"].count()) == (2004, 7516)
    names = register_views(tables, source)
    assert {"q01_top_providers_yoy", "q06_monthly_volume_mv", "source_balance", "dim_date", "claims"} <= set(names)
    best = spark.sql("select max(total_paid) as paid from q01_top_providers_yoy").first().paid
    paid = spark.sql(
        "select sum(f.total_paid) as paid from fact_claim f join dim_date d on d.date_key = f.service_date_key "
        "join dim_provider p on p.provider_key = f.provider_key "
        "where d.year_number = (select max(year_number) from dim_date join fact_claim on date_key = service_date_key) "
        "group by p.provider_id order by paid desc limit 1"
    ).first().paid
    assert best == paid
    assert spark.sql("select sum(unaccounted) as n from source_balance").first().n == 0
    profile = load_profile(source, 0.001, tables["fact_claim"].first().loaded_at).first()
    assert (profile.member_count, profile.provider_count, profile.claim_count, profile.claim_line_count) == (500, 50, 2008, 7530)
