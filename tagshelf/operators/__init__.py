"""Operators: functions from DataFrames to DataFrames, usable with ``df.transform``."""
