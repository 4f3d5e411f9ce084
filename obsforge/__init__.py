"""Tabular feature and model-quality operators for daily observation tables, on Spark."""

__version__ = "0.1.0"
