"""Load, audit and quality operators: functions from DataFrames to DataFrames."""
