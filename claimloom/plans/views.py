"""Temporary views, so that the warehouse and its queries can be read with plain SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame

from claimloom.operators import ledger, scd2
from claimloom.plans.analytics import Tables
from claimloom.plans.integrity import VIEWS


def register_views(tables: Tables, source: dict[str, DataFrame] | None = None) -> list[str]:
    """Name every table, analytic query and, given the source, staging and audit view.

    Views are lazy: a query over one is planned as a whole, down to the columns read.
    """
    views = dict(tables)
    views["mv_monthly_claim_volume"] = tables["monthly_claim_volume"]
    views.update({name: query(tables) for name, query in VIEWS.items()})
    if source is not None:
        letters = tables["etl_dead_letter"]
        views.update(source)
        views.update({
            "member_history": scd2.member_history(source["member_plan_history"], source["members"]),
            "provider_history": scd2.provider_history(source["provider_network_history"], source["providers"]),
            "claim_disposition": ledger.claim_disposition(source["claims"], tables["fact_claim"], letters),
            "claim_line_disposition": ledger.claim_line_disposition(
                source["claim_lines"], tables["fact_claim_line"], letters
            ),
            "member_history_disposition": ledger.member_history_disposition(
                source["member_plan_history"], tables["dim_member"]
            ),
            "provider_history_disposition": ledger.provider_history_disposition(
                source["provider_network_history"], tables["dim_provider"]
            ),
            "source_balance": ledger.source_balance(source, tables),
        })
    for name, view in views.items():
        view.createOrReplaceTempView(name)
    return sorted(views)
