"""Global order without a single sorted partition (O1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playstream.session import materialize


def global_rank(df: DataFrame, order: Sequence[str], out: str = "place") -> DataFrame:
    """``df`` sorted by ``order`` (nulls first) with every row's place from 1.

    Rows are dealt into ranges of the order and written once, so that ranges
    stay what they are; a place is the number of rows in the ranges before
    (a prefix over one count per range) plus the number inside the range.
    Rows equal in all of ``order`` share a range, so it should tell rows apart."""
    parts = materialize(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    counts = parts.groupBy("_range").agg(F.count("*").alias("_n"))   # a row per range
    before = counts.select("_range", (F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    ranked = parts.withColumn("_inside", inside).join(before, "_range")
    return ranked.withColumn(out, (F.col("_before") + F.col("_inside")).cast("long")).drop("_range", "_before", "_inside").orderBy(out)
