"""Operators over DataFrames: reshaping, keys, calendars and quality reports."""
