"""Driving segments, sessions and ordering of car events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streamlab.functions.rides import erraticness_label
from streamlab.operators.rides import running_count
from streamlab.plans.hotkeys import PART_ROWS, split_by_position
from streamlab.plans.scans import Carry, drop_parts, part_window, with_carries


def segment_stats(keep: Column | None = None) -> list[Column]:
    """Aggregates of a segment over the rows where ``keep`` holds."""
    def only(c: Column) -> Column:
        return c if keep is None else F.when(keep, c)

    return [
        F.min(only(F.col("ts"))).alias("startTime"),
        F.count(only(F.lit(1))).alias("length"),
        F.max(only(F.col("speed"))).cast("int").alias("maxSpeed"),
        F.stddev_pop(only(F.col("throttle").cast("double"))).alias("erraticness"),
    ]


_OUTPUT = ["carId", "startTime", "length", "maxSpeed", "erraticness", "label"]


def _labelled(segments: DataFrame) -> DataFrame:
    return segments.withColumn("label", erraticness_label(F.col("erraticness"))).select(*_OUTPUT)


def driving_segments(
    cars: DataFrame, require_leading_stop: bool = False, part_rows: int = PART_ROWS
) -> DataFrame:
    """Runs of driving rows that end at a stop (speed 0), one row per run.

    The run before a car's first stop counts unless ``require_leading_stop``; a run without a
    closing stop does not. Driving rows at exactly the time of a stop belong to no run. Batch form.
    """
    cars = cars.withColumn("_us", F.unix_micros("ts")).withColumn(
        "_stop", (F.col("speed") == 0).cast("int")
    )
    rows = split_by_position(cars, ["carId"], F.col("_us"), part_rows)
    by_time = part_window(["carId"], F.col("_us"))
    local = rows.withColumn(
        "_stopsBefore", F.sum("_stop").over(by_time.rangeBetween(Window.unboundedPreceding, -1))
    ).withColumn("_stopsNow", F.sum("_stop").over(by_time.rangeBetween(0, 0)))
    counted = with_carries(local, rows, ["carId"], {"_carried": Carry(F.sum("_stop"), "sum")})
    run = F.coalesce("_stopsBefore", F.lit(0)) + F.coalesce("_carried", F.lit(0))
    driving = (F.col("_stop") == 0) & (F.col("_stopsNow") == 0)
    runs = (
        counted.withColumn("_run", run)
        .groupBy("carId", "_run")
        .agg(*segment_stats(driving), F.max("_stop").alias("_closed"))
        .filter((F.col("length") > 0) & (F.col("_closed") == 1))
    )
    if require_leading_stop:
        runs = runs.filter("_run > 0")
    return _labelled(runs)


def driving_sessions(
    cars: DataFrame, gap: str = "15 seconds", part_rows: int = PART_ROWS
) -> DataFrame:
    """Runs of rows of a car with no gap longer than ``gap``.

    Streams use the built-in session window. The batch form numbers the sessions by a running count
    of gaps instead, because the built-in one merges all rows of a car in one task.
    """
    if cars.isStreaming:
        sessions = cars.groupBy("carId", F.session_window("ts", gap)).agg(*segment_stats())
        return _labelled(sessions)
    cars = cars.withColumn("_us", F.unix_micros("ts"))
    rows = split_by_position(cars, ["carId"], F.col("_us"), part_rows)
    by_time = part_window(["carId"], F.col("_us"))
    local = rows.withColumn("_lag", F.lag("_us").over(by_time))
    linked = with_carries(local, rows, ["carId"], {"_lastBefore": Carry(F.max("_us"), "max")})
    gap_us = F.unix_micros(F.timestamp_seconds(F.lit(0)) + F.expr(f"INTERVAL {gap}"))
    previous = F.coalesce("_lag", "_lastBefore")
    flagged = linked.withColumn(
        "_new", F.when(F.col("_us") - previous <= gap_us, 0).otherwise(1)
    ).drop("_lag", "_lastBefore")
    numbered = flagged.withColumn(
        "_run", F.sum("_new").over(by_time.rowsBetween(Window.unboundedPreceding, 0))
    )
    counted = with_carries(numbered, flagged, ["carId"], {"_carried": Carry(F.sum("_new"), "sum")})
    run = F.col("_run") + F.coalesce("_carried", F.lit(0))
    sessions = drop_parts(counted).withColumn("_run", run).groupBy("carId", "_run")
    return _labelled(sessions.agg(*segment_stats()))


def event_time_sort(df: DataFrame, key: str, ts: str, tie: str | None = None) -> DataFrame:
    """All rows ordered by (key, time): a range-partitioned sort, so a busy key spans partitions."""
    return df.orderBy(key, ts, *([tie] if tie else []))


def event_time_order(
    df: DataFrame, key: str, ts: str, tie: str, name: str = "seq", part_rows: int = PART_ROWS
) -> DataFrame:
    """The place of each row in the time order of its key, as a column."""
    return running_count(
        df, key, [F.col(ts), F.col(tie)], F.unix_micros(ts), name=name, part_rows=part_rows
    )
