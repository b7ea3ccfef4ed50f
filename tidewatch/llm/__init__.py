"""Operators of a training-data pipeline, each under its own module.

Nothing outside this package imports it; ``__spark_entry__.py`` registers its
queries only when it is present.
"""
