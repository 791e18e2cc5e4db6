"""Whole-warehouse plans: the load, the analytic queries, the summary and the integrity suite."""
