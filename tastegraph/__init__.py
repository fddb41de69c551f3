"""Recommendation and audience-profiling jobs on PySpark DataFrames."""
