"""Silver: trimmed, typed, deduplicated rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from strata.functions.text import trim_unicode


def trim_strings(df: DataFrame) -> DataFrame:
    """Trim every top-level string column; NULL stays NULL."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({n: trim_unicode(F.col(f"`{n}`")) for n in names}) if names else df


def deduplicate(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    keep: str = "last",
) -> DataFrame:
    """One row per key: the last (or first) by ``order_by``; ties fall to the remaining columns.

    ``row_number() = 1`` lets Spark keep a single row per key in every map task before it shuffles, so a key that
    holds a third of the table reaches the final task as a handful of rows.
    """
    if keep not in ("first", "last"):
        raise ValueError(f"keep must be 'first' or 'last', not {keep!r}")
    if not keys:
        raise ValueError("deduplicate needs at least one key column")
    orderable = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    rest = [n for n in orderable if n not in keys and n not in order_by]
    direction = F.desc_nulls_last if keep == "last" else F.asc_nulls_last
    window = Window.partitionBy(*keys).orderBy(*[direction(n) for n in [*order_by, *rest]])
    return df.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")


# A target is pruned by so many single values of a column; beyond, by their range.
_VALUES = 1000


def portable(name: str, kind: T.DataType) -> Column:
    """A value as the driver can hold it without loss, whatever the time zones of session and driver."""
    return F.unix_micros(name) if isinstance(kind, T.TimestampType) else F.col(name).cast("string")


def literal(value: int | str | None, kind: T.DataType) -> Column:
    """The value that ``portable`` gave, as a constant."""
    return F.timestamp_micros(F.lit(value)) if isinstance(kind, T.TimestampType) else F.lit(value).cast(kind)


def may_hold(df: DataFrame, columns: Sequence[str]) -> Column:
    """A condition on another table with these columns: whether a row can have an equal in all of them here.

    Constants only, so that Spark prunes directories and row groups with it. It takes a pass over ``df`` for each column,
    and a bounded number of values reaches the driver.
    """
    condition = F.lit(True)
    for name in columns:
        kind = df.schema[name].dataType
        found = df.select(name).distinct().select(portable(name, kind).alias("v")).limit(_VALUES + 1).collect()
        if len(found) <= _VALUES:
            values = [literal(r.v, kind) for r in found if r.v is not None]
            own = F.col(name).isin(values) if values else F.lit(False)
            nulls = len(values) < len(found)
        else:
            ends = df.agg(F.min(name).alias(name), F.max(name).alias("_high"), F.bool_or(F.col(name).isNull()).alias("nulls"))
            low, high, nulls = ends.select(portable(name, kind), portable("_high", kind), "nulls").first()
            own = F.col(name).between(literal(low, kind), literal(high, kind))
        condition = condition & (own | F.col(name).isNull() if nulls else own)
    return condition


def without_existing(df: DataFrame, target: DataFrame, keys: Sequence[str], within: Sequence[str] = ()) -> DataFrame:
    """Rows whose key is not in the target yet. NULL keys are compared as equal.

    The target's keys are made distinct first: a key it holds very often is one row per map task in the shuffle.

    ``within`` names further columns of the key by which the target is laid out, such as its partition. What of the
    target can't hold a row of ``df`` is then not read, and of the rest only keys that ``df`` has go on to the anti join:
    the cost follows ``df``, not the age of the target. ``df`` is read several times.
    """
    keys = list(dict.fromkeys([*keys, *within]))

    def equal(other: str) -> Column:
        return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{other}{k}")) for k in keys])

    existing = target.where(may_hold(df, within)) if within else target
    if within:
        asked = df.select(*[F.col(k).alias(f"_a_{k}") for k in keys]).distinct()
        existing = existing.select(*keys).join(asked, equal("_a_"), "left_semi")
    existing = existing.select(*[F.col(k).alias(f"_t_{k}") for k in keys]).distinct()
    return df.join(existing, equal("_t_"), "left_anti")


_DATE = r"^\s*\d{4,6}-\d{1,2}-\d{1,2}"


def _fits(raw: Column, source: T.DataType, target: T.DataType) -> Column:
    """Whether a value keeps its meaning in the target type: it casts, and casts back to what it was.

    Text must name a whole date for dates and times, and nothing but that for dates; decimal text must not lose places.
    Floating targets may round, as any decimal number in them does.
    """
    cast = raw.try_cast(target)
    fits = cast.isNotNull()
    if isinstance(source, T.StringType):
        if isinstance(target, T.DateType):
            return fits & raw.rlike(_DATE + r"\s*$")
        if isinstance(target, (T.TimestampType, T.TimestampNTZType)):
            return fits & raw.rlike(_DATE)
        if isinstance(target, T.DecimalType):
            return fits & raw.try_cast(T.DecimalType(38, 18)).eqNullSafe(cast.cast(T.DecimalType(38, 18)))
        return fits
    exact = isinstance(source, T.AtomicType) and not isinstance(target, (T.StringType, T.FloatType, T.DoubleType))
    return fits & cast.try_cast(source).eqNullSafe(raw) if exact and source != target else fits


def conform_errors(df: DataFrame, schema: T.StructType) -> Column:
    """What in a row does not fit the declared schema, field by field; an empty list means it fits.

    A value that a cast would change, such as 1.9 in an integer column, does not fit.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    errors: list[Column] = []
    for field in schema.fields:
        if field.name not in df.columns:
            if not field.nullable:
                errors.append(F.lit(f"{field.name} is missing"))
            continue
        raw = F.col(f"`{field.name}`")
        errors.append(F.when(raw.isNotNull() & ~F.coalesce(_fits(raw, types[field.name], field.dataType), F.lit(False)),
                             F.lit(f"{field.name} is not {field.dataType.simpleString()}")))
        if not field.nullable:
            errors.append(F.when(raw.isNull(), F.lit(f"{field.name} is required")))
    return F.array_compact(F.array(*errors)) if errors else F.array().cast("array<string>")


def conform(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Rows cast to the declared schema, and the untouched rows that do not fit, with their reasons."""
    checked = df.withColumn("conform_errors", conform_errors(df, schema))
    typed = [
        (F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType))
        .alias(f.name)
        for f in schema.fields
    ]
    return checked.filter(F.size("conform_errors") == 0).select(*typed), checked.filter(F.size("conform_errors") > 0)


def standardize(df: DataFrame, rules: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """One rule per column: upper, lower, title, trim, date, timestamp, or ``scale:<factor>`` for units.

    Rows with a date or time that cannot be read come back untouched as the second frame, with their reasons in
    ``standardize_errors``.
    """
    out: dict[str, Column] = {}
    errors: list[Column] = []
    for name, rule in rules.items():
        col = F.col(f"`{name}`")
        if rule == "upper":
            out[name] = F.upper(trim_unicode(col))
        elif rule == "lower":
            out[name] = F.lower(trim_unicode(col))
        elif rule == "title":
            out[name] = F.initcap(F.lower(trim_unicode(col)))
        elif rule == "trim":
            out[name] = trim_unicode(col)
        elif rule in ("date", "timestamp"):
            kind = T.DateType() if rule == "date" else T.TimestampType()
            text = trim_unicode(col.cast("string"))
            out[name] = text.try_cast(kind)
            errors.append(F.when(col.isNotNull() & ~F.coalesce(_fits(text, T.StringType(), kind), F.lit(False)),
                                 F.lit(f"{name} is no {rule}")))
        elif rule.startswith("scale:"):
            out[name] = col * F.lit(float(rule.split(":", 1)[1]))
        else:
            raise ValueError(f"unknown rule {rule!r} for column {name!r}")
    checked = df.withColumn("standardize_errors", F.array_compact(F.array(*errors)) if errors
                            else F.array().cast("array<string>"))
    good = checked.filter(F.size("standardize_errors") == 0).drop("standardize_errors").withColumns(out)
    return good, checked.filter(F.size("standardize_errors") > 0)


def bronze_to_silver(
    df: DataFrame,
    schema: T.StructType | None = None,
    keys: Sequence[str] | None = None,
    order_by: Sequence[str] = (),
    keep: str = "last",
) -> tuple[DataFrame, DataFrame | None]:
    """Trim, deduplicate (when keys are given), check against the schema; one lazy plan."""
    out = trim_strings(df)
    if keys:
        out = deduplicate(out, keys, order_by, keep)
    return conform(out, schema) if schema is not None else (out, None)
