"""The operators run over general order tables, with the SQL their results are checked against."""

from claimloom.registry import blocks, loads, reports
from claimloom.registry.base import ORACLE, QUERIES, loaded

__all__ = ["ORACLE", "QUERIES", "blocks", "loaded", "loads", "reports"]
