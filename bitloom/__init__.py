"""Parallel-text preparation, scoring and quality estimation as Spark DataFrame operators."""
