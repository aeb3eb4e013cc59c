"""Equi-join form of "point inside interval"."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The level of an interval without an end. A length in milliseconds has at most 63 bits.
OPEN_LEVEL = 64
#: Open intervals have no bin, so they are spread over this many parts.
OPEN_PARTS = 64


def interval_point_join(
    intervals: DataFrame, points: DataFrame, start: Column, end: Column, at: Column
) -> DataFrame:
    """All pairs with ``start <= at < end``, in epoch milliseconds; a null end is open.

    Each interval gets the level whose bin width (a power of two) is just above its length, so it
    touches at most two bins of that level; each point enters one bin per level that some interval
    has (at most 64, found first). The join is then an ordinary hash join on (level, bin). Open
    intervals have a level of their own. ``points`` should be the smaller side.
    """
    spans = intervals.withColumn("_s", start).withColumn("_e", end).filter("_e IS NULL OR _s < _e")
    is_open = F.col("_e").isNull()
    level = F.when(is_open, F.lit(OPEN_LEVEL)).otherwise(
        F.length(F.bin(F.col("_e") - F.col("_s") - 1))
    )
    first, last = F.expr("shiftright(_s, _level)"), F.expr("shiftright(_e - 1, _level)")
    # In the open level the bin number is the part.
    part = F.pmod(F.xxhash64(*intervals.columns), F.lit(OPEN_PARTS)).cast("long")
    bins = F.when(is_open, F.array(part)).otherwise(F.array_distinct(F.array(first, last)))
    binned = spans.withColumn("_level", level).withColumn("_bin", F.explode(bins))
    levels = spans.select(F.collect_set(level)).scalar()
    located = (
        points.withColumn("_at", at)
        .withColumn("_level", F.explode(levels))
        .withColumn(
            "_bin",
            F.explode(
                F.when(
                    F.col("_level") == OPEN_LEVEL,
                    F.sequence(F.lit(0), F.lit(OPEN_PARTS - 1)).cast("array<bigint>"),
                ).otherwise(F.array(F.expr("shiftright(_at, _level)")))
            ),
        )
    )
    return (
        binned.join(located, ["_level", "_bin"])
        .filter("_s <= _at AND (_e IS NULL OR _at < _e)")
        .drop("_level", "_bin", "_s", "_e", "_at")
    )


def bucket_join(
    spans: DataFrame,
    rows: DataFrame,
    start: Column,
    end: Column,
    at: Column,
    width_ms: int,
) -> DataFrame:
    """All pairs with ``start <= at < end`` (epoch milliseconds, null end is open) for few spans and
    many rows: spans are repeated per time bucket, rows enter exactly one bucket (``_bucket``).

    A span is repeated only up to the last row, so it has no more copies than buckets it can match.
    Spark broadcasts the spans when they are small and shuffles by bucket otherwise.
    """
    last = rows.select(F.max(at)).scalar()
    spread = (
        spans.withColumn("_s", start)
        .withColumn("_e", end)
        .withColumn("_last", F.least(F.coalesce(F.col("_e") - 1, last), last))
        .filter("_s <= _last")
        .withColumn(
            "_bucket",
            F.explode(
                F.sequence(
                    F.floor(F.col("_s") / width_ms),
                    F.floor(F.col("_last") / width_ms),
                )
            ),
        )
        .drop("_last")
    )
    placed = rows.withColumn("_at", at).withColumn("_bucket", F.floor(F.col("_at") / width_ms))
    return (
        placed.join(spread, "_bucket")
        .filter("_s <= _at AND (_e IS NULL OR _at < _e)")
        .drop("_s", "_e", "_at")
    )
