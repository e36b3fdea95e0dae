"""Operators: pure ``DataFrame -> DataFrame`` functions, the same for batch and
streaming inputs wherever Spark allows it."""
