"""Operators of a training-data pipeline. Nothing else in the library imports this package.

One operator per module; ``queries`` applies each to its whole table. Every operator takes a
DataFrame and returns one, keeps its models to a documented size, and writes intermediate tables
to the shared folder of ``spark.checkpoint.dir``.
"""
