"""wardline: entity-timeline analytics on Spark DataFrames.

Entities (patients), intervals (stays), timestamped text events (notes),
scores and flags go in; cohorts, labels, token tables, feature tables,
samples, linear models and ROC reports come out.  Every operator is a
lazy DataFrame -> DataFrame function built from Spark expressions.
"""

__version__ = "0.1.0"
