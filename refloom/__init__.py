"""Scholarly identifier extraction and record linkage as Spark DataFrame plans."""
