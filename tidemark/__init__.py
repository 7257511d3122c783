"""Batch and streaming operators for market and payment event data, on Spark DataFrames."""

__version__ = "0.1.0"
