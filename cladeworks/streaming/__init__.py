"""Streaming of the marker-gene engine."""
