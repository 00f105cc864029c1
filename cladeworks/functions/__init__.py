"""Functions of the marker-gene engine."""
