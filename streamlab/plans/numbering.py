"""Consecutive row numbers without sorting everything in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def number_rows(df: DataFrame, bucket: Column, order: list[Column], name: str) -> DataFrame:
    """1, 2, 3, ... in (``bucket``, ``order``) order.

    Rows are numbered inside their bucket; buckets start where the earlier ones end. A null bucket
    comes first. Only the row
    counts per bucket pass through a single task. Pick a bucket that grows with the rows, such as
    the minute of an event.
    """
    placed = df.withColumn("_bucket", bucket)
    starts = (
        placed.groupBy("_bucket")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(
            F.col("_bucket").alias("_place"),
            (
                F.sum("_rows").over(
                    Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
                )
                - F.col("_rows")
            ).alias("_before"),
        )
    )
    local = placed.withColumn(
        "_n", F.row_number().over(Window.partitionBy("_bucket").orderBy(*order))
    )
    return (
        local.join(starts, F.col("_bucket").eqNullSafe(F.col("_place")))
        .withColumn(name, (F.col("_before") + F.col("_n")).cast("long"))
        .drop("_bucket", "_place", "_before", "_n")
    )
