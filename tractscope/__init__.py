"""Residential-area analytics by census tract, as Spark DataFrame plans."""
