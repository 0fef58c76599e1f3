"""Operators of a training-data pipeline: mixing, cleaning, scoring, sharding and search over text."""
