"""Operators: functions from DataFrame to DataFrame that start no job."""
