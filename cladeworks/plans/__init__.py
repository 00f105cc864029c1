"""Plans of the marker-gene engine."""
