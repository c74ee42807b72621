"""Batch analytics for traceable sequence annotation, built on Spark DataFrames."""

__version__ = "0.1.0"
