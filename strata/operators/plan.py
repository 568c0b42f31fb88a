"""Shaping plans where the optimizer would repeat work."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def computed_once(df: DataFrame, struct: Column) -> DataFrame:
    """Add the fields of a costly struct as columns, computed once per row.

    A filter on a plain computed column is pushed below it and computes it again for every condition and use. A
    one-element ``inline`` keeps the filter above.
    """
    return df.select("*", F.inline(F.array(struct)))
