"""Operators: functions that take DataFrames and return a DataFrame."""
