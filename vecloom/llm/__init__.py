"""Operators for training-data pipelines: ten Spark jobs over text, page and benchmark tables."""
