"""Analytic operators: functions from DataFrames to DataFrames."""
