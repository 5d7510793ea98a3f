"""Observation analytics as Spark DataFrames: ingest, profile, features, splits, models, metrics."""

__version__ = "0.1.0"
