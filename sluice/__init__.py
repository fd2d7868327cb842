"""Sluice: market time-series features and training-data operators on Spark DataFrames."""
