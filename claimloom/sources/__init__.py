"""Row generators, source readers, the claims fixture and the run-directory table store."""

from claimloom.sources.fixture import claims_fixture, load_profile
from claimloom.sources.generators import calendar, series, spanned, values_relation
from claimloom.sources.reader import read_source, write_source
from claimloom.sources.store import Run, TableStore

__all__ = [
    "Run", "TableStore", "calendar", "claims_fixture", "load_profile", "read_source", "series", "spanned",
    "values_relation", "write_source",
]
