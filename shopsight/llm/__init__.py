"""Operators for training-data pipelines over document tables. Nothing else in the library imports this package."""
