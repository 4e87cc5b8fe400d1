"""Operators of a large-scale training-data pipeline; nothing outside imports this package."""
