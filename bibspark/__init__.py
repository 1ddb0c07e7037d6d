"""Bibliographic data preparation on Spark DataFrames."""
