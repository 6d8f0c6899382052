"""Candidate and company alignment analytics on Spark DataFrames."""
