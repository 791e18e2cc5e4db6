"""The monthly claim summary: refreshed as a whole after a load, read instead of the fact."""

from __future__ import annotations

from pyspark.sql import DataFrame

from claimloom.plans.analytics import Tables, monthly_totals, moving_average
from claimloom.sources.store import TableStore


def monthly_claim_volume(tables: Tables) -> DataFrame:
    """One row per service month; grouping by the month makes it unique."""
    return monthly_totals(tables)


def refresh_monthly_claim_volume(store: TableStore) -> int:
    """Recompute the summary from the published fact and publish it; readers never wait."""
    run = store.begin()
    fact = {name: run.read(name) for name in ("fact_claim", "dim_date")}
    run.replace("monthly_claim_volume", monthly_claim_volume(fact).coalesce(1))
    return run.publish()


def monthly_volume_from_summary(tables: Tables) -> DataFrame:
    """The monthly volume query answered from the summary."""
    return moving_average(tables["monthly_claim_volume"])
