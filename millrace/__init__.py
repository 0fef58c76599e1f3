"""Millrace: layered table refinement on Spark.

Batches of raw drops go through landing, bronze and silver tables into a star
schema.  Every operator takes and returns a DataFrame and is set up by plain
data (keys, defaults, weights, column specs).
"""
