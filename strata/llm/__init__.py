"""Operators for large training-text pipelines.

Nothing else in the library imports this subpackage. Every operator takes a
DataFrame with an id and a text column and returns a DataFrame; work on text
runs in Arrow batches inside Spark tasks (``mapInArrow``), everything that
brings rows together is a Spark join or aggregation.
"""
