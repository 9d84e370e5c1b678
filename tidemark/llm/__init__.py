"""Operators for large-scale training-data pipelines over documents and vectors."""
