"""Data-quality rules: many rules, one scan, one result row per rule."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F, types as T

from strata.operators.silver import conform_errors

CHECKS = ("not_null", "unique", "range", "pattern", "timestamp_range", "schema")

# Weight of a severity in a weighted score.
SEVERITY_WEIGHTS = {"critical": 4.0, "high": 3.0, "medium": 2.0, "low": 1.0}


@dataclass(frozen=True)
class Rule:
    """One check on one column. Ranges take ``low`` and ``high`` (either may be left out), patterns ``regex``; a
    ``schema`` check is about whole rows (column ``*``) and takes the declared ``schema``."""

    check: str
    column: str
    severity: str = "high"
    params: Mapping[str, Any] = field(default_factory=dict)
    name: str | None = None

    def __post_init__(self) -> None:
        if self.check not in CHECKS:
            raise ValueError(f"unknown check {self.check!r}; use one of {', '.join(CHECKS)}")

    @property
    def label(self) -> str:
        return self.name or f"{self.check}:{self.column}"

    @classmethod
    def parse(cls, text: str, severity: str = "high", name: str | None = None) -> Rule:
        """A rule from text such as ``not_null:id``, ``range:age:0:120``, ``range:age::120`` or ``pattern:code:^[A-Z]+$``.

        Bounds of ``timestamp_range`` are times; they hold colons, so they are divided by ``..``.
        """
        check, _, rest = text.partition(":")
        column, _, given = rest.partition(":")
        if not column or (check in ("not_null", "unique") and given):
            raise ValueError(f"cannot read the rule {text!r}")
        if check == "range":
            low, _, high = given.partition(":")
            params = {k: float(v) for k, v in (("low", low), ("high", high)) if v}
        elif check == "timestamp_range":
            low, _, high = given.partition("..")
            params = {k: F.lit(v).cast("timestamp_ntz") for k, v in (("low", low), ("high", high)) if v}
        else:
            params = {"regex": given} if check == "pattern" and given else {}
        if check in ("range", "timestamp_range", "pattern") and not params:
            raise ValueError(f"the rule {text!r} needs a bound or a pattern")
        return cls(check, column, severity, params, name)


def rules_from(config: Sequence[Mapping[str, Any]], schema: T.StructType | None = None) -> list[Rule]:
    """Rules from configuration entries with ``rule`` (text), ``name`` and ``severity``.

    An entry named ``schema_conformance`` checks all rows against the table's declared schema.
    """
    out = []
    for entry in config:
        severity, name = entry.get("severity", "high"), entry.get("name")
        if name == "schema_conformance" and "rule" not in entry:
            if schema is None:
                raise ValueError("schema_conformance needs the declared schema")
            out.append(Rule("schema", "*", severity, {"schema": schema}, name))
        else:
            out.append(Rule.parse(entry["rule"], severity, name))
    return out


def _bound(value: Any) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def violates(rule: Rule, df: DataFrame) -> Column | None:
    """Whether one row breaks the rule; None for rules about the whole table. NULLs break ``not_null`` only, or a schema."""
    if rule.check == "schema":
        return F.size(conform_errors(df, rule.params["schema"])) > 0
    col = F.col(f"`{rule.column}`")
    if rule.check == "not_null":
        return col.isNull()
    if rule.check in ("range", "timestamp_range"):
        parts = []
        if rule.params.get("low") is not None:
            parts.append(col < _bound(rule.params["low"]))
        if rule.params.get("high") is not None:
            parts.append(col > _bound(rule.params["high"]))
        if not parts:
            raise ValueError(f"{rule.label} needs low or high")
        return reduce(lambda a, b: a | b, parts)
    if rule.check == "pattern":
        return ~col.rlike(rule.params["regex"])
    return None


def run_suite(df: DataFrame, rules: Sequence[Rule], layer: str = "unknown", table: str = "unknown") -> DataFrame:
    """Every rule in one aggregate. A rule on a column the table lacks fails with an error.

    ``unique`` compares rows with distinct values, where all NULLs together count as one value.
    """
    known = set(df.columns)
    counters: list[Column] = [F.count(F.lit(1)).alias("_total")]
    results: list[Column] = []
    total = F.col("_total")
    for i, rule in enumerate(rules):
        error, failed, unique = F.lit(None).cast("string"), F.lit(None).cast("bigint"), F.lit(None).cast("bigint")
        if rule.column not in known and rule.check != "schema":
            passed = F.lit(False)
            error = F.lit(f"column {rule.column} not found")
        elif rule.check == "unique":
            col = F.col(f"`{rule.column}`")
            counters += [F.count_distinct(col).alias(f"_d{i}"), F.max(col.isNull().cast("int")).alias(f"_n{i}")]
            unique = F.col(f"_d{i}") + F.coalesce(F.col(f"_n{i}"), F.lit(0))
            failed = total - unique
            passed = failed == 0
        else:
            counters.append(F.count_if(violates(rule, df)).alias(f"_c{i}"))
            failed = F.col(f"_c{i}")
            passed = failed == 0
        results.append(F.struct(
            F.lit(layer).alias("layer"), F.lit(table).alias("table_name"), F.lit(rule.label).alias("check_name"),
            F.lit(rule.check).alias("check_type"), F.lit(rule.column).alias("column_name"),
            F.lit(rule.severity).alias("severity"), passed.alias("passed"),
            total.alias("total_rows"), failed.cast("bigint").alias("failed_rows"),
            unique.cast("bigint").alias("unique_values"), error.alias("error")))
    return df.agg(*counters).select(F.inline(F.array(*results)))


def score(results: DataFrame, weighted: bool = False) -> DataFrame:
    """Quality score from 0 to 100 per layer and table: passed checks out of all, optionally by severity."""
    weight = F.lit(1.0)
    if weighted:
        weights = F.create_map(*[F.lit(x) for pair in SEVERITY_WEIGHTS.items() for x in pair])
        weight = F.coalesce(F.try_element_at(weights, F.col("severity")), F.lit(1.0))
    return results.groupBy("layer", "table_name").agg(
        F.count(F.lit(1)).alias("checks"), F.count_if("passed").alias("passed_checks"),
        (F.sum(F.when(F.col("passed"), weight).otherwise(0.0)) * 100 / F.sum(weight)).alias("score"))


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def reasons(rules: Sequence[Rule], df: DataFrame) -> Column:
    """Labels of the row-level rules a row breaks."""
    listed = []
    for rule in rules:
        broken = violates(rule, df)
        if broken is None:
            raise ValueError(f"{rule.label} is about the whole table, not about a row")
        listed.append(F.when(broken, F.lit(rule.label)))
    return F.array_compact(F.array(*listed))


def quarantine(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """Rows that keep every rule, and the rest with ``reasons``."""
    checked = df.withColumn("reasons", reasons(rules, df))
    return checked.filter(F.size("reasons") == 0).drop("reasons"), checked.filter(F.size("reasons") > 0)
