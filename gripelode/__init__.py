"""Gripelode: pain-point evidence jobs on Spark DataFrames."""
