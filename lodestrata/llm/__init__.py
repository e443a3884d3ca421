"""Operators for large training-data pipelines.

Nothing else in the package imports this one; ``__spark_entry__`` adds its
queries where it can be imported.
"""
