"""Operators: functions of DataFrames to DataFrames."""
