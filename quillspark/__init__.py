"""Spark-first analytics over versioned document archives and dated events."""
