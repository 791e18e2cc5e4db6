"""Rebuild a warehouse from its source and hold it to the gates a load has to pass."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from claimloom import fixed_values as fv
from claimloom.operators.ledger import assert_balance, source_balance
from claimloom.operators.quality import quality_report
from claimloom.plans.integrity import assert_integrity, assert_not_empty, integrity_report, smoke_counts
from claimloom.plans.load import LOAD, RESET, SUMMARY, publish
from claimloom.sources.store import TableStore


def rebuild(
    store: TableStore,
    source: dict[str, DataFrame],
    calendar: tuple = (fv.CALENDAR_START, fv.CALENDAR_END),
    now: datetime | None = None,
) -> DataFrame:
    """Empty, load and refresh in one run, then check; returns the data-quality report.

    A load that fails leaves the version before readable. Findings of the report do not stop
    anything. An unbalanced ledger, a broken assertion or an empty query raises, after the load has
    been published, for the state to be looked at.
    """
    publish(store, source, [RESET, *LOAD, SUMMARY], calendar, now)
    return verify(store, source, calendar)


def verify(
    store: TableStore, source: dict[str, DataFrame], calendar: tuple = (fv.CALENDAR_START, fv.CALENDAR_END)
) -> DataFrame:
    """The gates alone, on the published state."""
    tables = store.read_all()
    report = quality_report(tables)
    assert_balance(source_balance(source, tables))
    assert_integrity(integrity_report(tables, calendar))
    assert_not_empty(smoke_counts(tables))
    return report
