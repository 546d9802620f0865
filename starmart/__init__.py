"""Batch data quality and star-schema building for travel-arrival records, on Spark DataFrames."""
