"""Deterministic tick replay and time-ordered analytics on Spark DataFrames."""
