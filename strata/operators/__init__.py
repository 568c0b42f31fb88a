"""Batch operators: DataFrame in, DataFrame out, no action on the data."""
