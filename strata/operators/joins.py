"""Joins Spark has no equality key for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


# A band is joined by cells of a width that makes it cover about so many at most.
_CELLS = 64


def range_join(
    points: DataFrame, bands: DataFrame, value: str, low: str, high: str, width: float, salts: int = 1,
) -> DataFrame:
    """Points inside bands: ``low <= value < high``.

    A point falls in one cell of ``width``, a band covers a run of cells, and the cells are joined by equality, so
    no nested-loop plan appears. Choose ``width`` near a typical band. A wider band uses cells 64, 4096, ... times as
    wide, and points look into a cell of each width that some band uses; so no band becomes more than some 64 rows.
    With ``salts`` above 1 every cell is dealt out over that many keys, for points that crowd into a few cells.
    """
    def cell(column: Column, level: Column) -> Column:
        return F.floor(column.cast("double") / (F.lit(float(width)) * F.pow(F.lit(float(_CELLS)), level)))

    covered = (F.col(high).cast("double") - F.col(low).cast("double")) / width
    level = F.when(covered > _CELLS, F.ceil(F.log(covered / _CELLS) / F.log(F.lit(float(_CELLS)))).cast("int")).otherwise(0)
    sized = bands.filter(F.col(low) < F.col(high)).withColumn("_level", level)
    top = sized.agg(F.max("_level")).first()[0] or 0
    dealt = F.pmod(F.xxhash64(*points.columns), F.lit(salts)).cast("int")
    levels = F.explode(F.array(*[F.lit(k) for k in range(top + 1)])) if top else F.lit(0)
    keyed = points.withColumn("_salt", dealt).withColumn("_level", levels).withColumn("_cell", cell(F.col(value), F.col("_level")))
    spread = sized.withColumn("_cell", F.explode(F.sequence(cell(F.col(low), F.col("_level")), cell(F.col(high), F.col("_level")))))
    spread = spread.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return keyed.join(spread, ["_level", "_cell", "_salt"]).filter(
        (F.col(value) >= F.col(low)) & (F.col(value) < F.col(high))).drop("_cell", "_salt", "_level")
