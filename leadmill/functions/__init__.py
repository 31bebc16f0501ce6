"""Scalar functions: every one takes and returns Columns and stays in the JVM unless its name ends in _udf."""
