"""Sources of the marker-gene engine."""
