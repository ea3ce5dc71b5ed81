"""Operators: functions from DataFrames to DataFrames or fitted Spark ML models."""
