"""Geospatial grid-capacity analytics as plain PySpark DataFrame operators."""
