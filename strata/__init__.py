"""Medallion-style data work as plain DataFrame, Spark SQL and Structured Streaming jobs."""
