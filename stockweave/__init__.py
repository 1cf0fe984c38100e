"""Retail demand series on Spark: regular series, encodings, splits, forecasts, drift checks."""
