"""Spark-first engine for published statistical time series."""
