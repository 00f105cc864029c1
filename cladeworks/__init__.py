"""Spark-first marker-gene analytics: occupancy, screening, trees, reports."""

__version__ = "0.1.0"
