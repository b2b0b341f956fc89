"""Retail star-schema analytics on PySpark: cleaning, metrics, segments, cohorts."""
