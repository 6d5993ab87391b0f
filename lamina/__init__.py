"""Layered-table analytics on Spark: raw -> refined -> feature -> model."""
