"""Operators for large-scale training-data pipelines, their queries and their SQL."""
