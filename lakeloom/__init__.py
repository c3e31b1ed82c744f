"""Lakeloom: layered-lakehouse analytics as plain PySpark DataFrame functions."""
