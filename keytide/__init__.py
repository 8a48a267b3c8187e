"""Keyed record logs and the tables they imply, as PySpark DataFrame functions.

A *log* is a DataFrame with a ``key`` column, value columns, ``off`` (arrival order, unique
in the log) and ``ts`` (event time). Everything here takes and returns DataFrames.
"""
