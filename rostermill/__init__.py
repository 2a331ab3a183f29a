"""Ingest and reconcile health-plan data with Spark DataFrames."""

__version__ = "0.1.0"
