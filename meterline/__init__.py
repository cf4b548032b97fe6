"""Incremental trip marts as Spark DataFrame jobs."""
