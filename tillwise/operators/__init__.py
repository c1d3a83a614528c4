"""Marts and analyses: functions from DataFrames to DataFrames."""
