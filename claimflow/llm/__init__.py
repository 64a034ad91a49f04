"""Operators for training-data pipelines, each a set of Spark jobs."""
