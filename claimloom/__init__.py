"""A Spark-native claims warehouse: dimension and fact loads, audit ledger, quality report, analytics."""
