"""Ready-made queries over the sales-like test tables, each with its SQL twin.

A line item with its order stands for an enrolment (order date = start, ship
date = end), a customer for a student and a part for a course.
"""

from millrace.catalog import arrivals, layers, merging, refining, scanning, starring, tracking  # noqa: F401
from millrace.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
