"""Operators for large training-data pipelines (quality, dedup, mixing,
packing, serialization) and their registered queries.

Nothing else in the library imports this subpackage.
"""
