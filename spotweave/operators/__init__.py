"""Operators: plain functions that take and return DataFrames."""
