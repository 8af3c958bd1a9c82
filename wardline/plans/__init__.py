"""Composed plans: registered queries (catalog) and end-to-end pipelines."""
