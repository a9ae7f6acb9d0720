"""Operators for large training-data pipelines.

Nothing else in the library imports this subpackage; ``__spark_entry__.py``
adds its queries when it can be imported. Every operator takes DataFrames and
column names, picks only the columns it needs (extra columns, also ones with
clashing names, are ignored) and returns a DataFrame.
"""
