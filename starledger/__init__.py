"""Lakehouse layers, a star schema and its measures as plain PySpark DataFrames."""
