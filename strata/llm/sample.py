"""Bounded samples to fit models on."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

MOST_CLASSES = 1000


def bounded_sample(rows: DataFrame, key: str, id_col: str, most: int) -> DataFrame:
    """At most ``most`` rows of each value of ``key``: those with the lowest hashes of their id, alike for any layout.

    Rows with a NULL key are left out; ties and repeated ids go by hash of the whole row. One pass counts the values,
    a second one keeps twice as many rows as are needed by a bound on the hash, so few rows are ever shuffled. More
    than ``MOST_CLASSES`` values raise.
    """
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).count().limit(MOST_CLASSES + 1).collect()
    if len(counts) > MOST_CLASSES:
        raise ValueError(f"{key} has more than {MOST_CLASSES} values")
    place = F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) / F.lit(2.0 ** 64) + 0.5
    share = F.lit(None).cast("double")
    for value, count in counts:
        share = F.when(F.col(key) == value, (2 * most + 200) / count).otherwise(share)
    order = Window.partitionBy(key).orderBy("_place", F.xxhash64(*[c for c in rows.columns]))
    return (rows.withColumn("_place", place).where(F.col("_place") <= share)
            .withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= most)
            .orderBy(key, "_n").drop("_place", "_n"))
