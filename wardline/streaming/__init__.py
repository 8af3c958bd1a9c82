"""Structured Streaming forms of the per-entity note statistics."""
