"""Retail operators: functions from DataFrame to DataFrame."""
