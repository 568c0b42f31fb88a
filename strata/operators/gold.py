"""Gold: aggregates, metrics, wide tables and feature tables."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

# The aggregate functions a metric expression or an aggregation may use.
AGGREGATES = ("sum", "count", "avg", "mean", "min", "max")


def exact_sum(col: Column | str, scale: int) -> Column:
    """Sum of doubles that have ``scale`` places: the same answer in whatever order partitions arrive.

    Up to 28 digits; a larger value raises. Further places are rounded, so the scale must be that of the data.
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.sum(c.cast(T.DecimalType(28, scale))).cast("double")


def exact_avg(col: Column | str, scale: int) -> Column:
    """Mean with an exact numerator."""
    c = F.col(col) if isinstance(col, str) else col
    return F.try_divide(exact_sum(c, scale), F.count(c))


def _aggregate(column: str, function: str, dtype: T.DataType, scale: int | None) -> Column:
    col = F.col(f"`{column}`")
    exact = scale is not None and isinstance(dtype, (T.DoubleType, T.FloatType))
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        col = F.when(~F.isnan(col), col)
    if function == "sum":
        return F.coalesce(exact_sum(col, scale) if exact else F.sum(col), F.lit(0))
    if function == "count":
        return F.count(col)
    if function in ("avg", "mean"):
        return exact_avg(col, scale) if exact else F.avg(col)
    if function == "min":
        return F.min(col)
    if function == "max":
        return F.max(col)
    raise ValueError(f"unknown aggregation {function!r}; use one of {', '.join(AGGREGATES)}")


def aggregate(
    df: DataFrame,
    group_by: Sequence[str],
    aggregations: Mapping[str, str],
    scale: int | None = None,
) -> DataFrame:
    """Group and aggregate, one function per column; the output keeps the column's name.

    Rows with a NULL or NaN key are dropped, NaN values count as missing, and a sum over no values is 0. ``scale`` sums doubles as decimals with that
    many places. Partial aggregation runs before the shuffle, so hot keys cost one row per map task.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    aggs = [_aggregate(c, f, types[c], scale).alias(c) for c, f in aggregations.items()]
    return df.dropna(subset=list(group_by)).groupBy(*group_by).agg(*aggs)


def _check_metric(name: str, expression: str) -> None:
    calls = re.findall(r"([A-Za-z_][A-Za-z_0-9]*)\s*\(", expression)
    unknown = sorted({c.lower() for c in calls} - set(AGGREGATES))
    if not calls or unknown:
        raise ValueError(f"metric {name!r}: use {', '.join(AGGREGATES)} only, found {unknown or 'no aggregate'}")


def metrics(df: DataFrame, definitions: Mapping[str, str]) -> DataFrame:
    """Named whole-table metrics from expression text, all in one pass and one row."""
    for name, expression in definitions.items():
        _check_metric(name, expression)
    return df.agg(*[F.expr(e).alias(n) for n, e in definitions.items()])


def ml_features(df: DataFrame, features: Sequence[str], target: str | None = None) -> DataFrame:
    """Project the feature columns and, when given, the target."""
    return df.select(*features, *([target] if target else []))


def denormalize(facts: DataFrame, *dimensions: tuple[DataFrame, str, str]) -> DataFrame:
    """Left-join dimensions ``(frame, fact column, dimension key)`` onto the facts, one after the other.

    No broadcast hint: Spark broadcasts a dimension it has measured below the threshold, and otherwise splits
    skewed fact partitions of the shuffle join.
    """
    out = facts
    for frame, fact_column, key in dimensions:
        out = out.join(frame, F.col(fact_column) == F.col(key), "left")
    return out


def rollup_time(
    df: DataFrame, time_column: str, unit: str, aggs: Sequence[Column], by: Sequence[str] = (),
) -> DataFrame:
    """Daily, weekly, monthly … rollup."""
    period = F.date_trunc(unit, F.col(time_column)).cast("timestamp_ntz").alias("period")
    return df.groupBy(period, *by).agg(*aggs)


def period_over_period(df: DataFrame, period: str, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Previous value, change and growth rate of an already aggregated series."""
    window = Window.partitionBy(*by).orderBy(period) if by else Window.orderBy(period)
    before = F.lag(value).over(window)
    return df.withColumns({
        f"previous_{value}": before,
        f"{value}_change": F.col(value) - before,
        f"{value}_growth": F.try_divide(F.col(value) - before, before),
    })


def unify(base: DataFrame, key: str, *sources: DataFrame) -> DataFrame:
    """One row per base key with every source's columns. Sources come pre-aggregated to the key: no fan-out."""
    out = base
    for source in sources:
        out = out.join(source, key, "left")
    return out
