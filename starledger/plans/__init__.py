"""Layers: typed tables from raw records, the star schema, its measures and report queries."""
