"""Batch record linkage as lazy Spark DataFrame plans."""
