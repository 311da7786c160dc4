"""Zonal land-change analytics on Spark DataFrames."""
