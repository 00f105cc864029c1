"""Operators of the marker-gene engine."""
