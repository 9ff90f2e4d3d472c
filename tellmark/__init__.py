"""Screening of large review tables for machine-written text, on Spark DataFrames."""
