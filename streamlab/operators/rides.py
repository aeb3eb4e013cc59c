"""Ride stream operators: cleansing, cells, windows and counts. All work on batch and streaming input
unless the text says otherwise."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streamlab.functions import geo
from streamlab.functions import rides as rx
from streamlab.operators.predicates import check_predicates, predicate_scope
from streamlab.plans.hotkeys import PART, PART_ROWS, hot_keys, split_by_position, with_hot
from streamlab.plans.scans import Carry, drop_parts, part_window, with_carries


def with_event_time(rides: DataFrame, delay: str | None = None) -> DataFrame:
    """Add ``eventTime``; with ``delay`` also the watermark (a no-op on batch input)."""
    timed = rides if "eventTime" in rides.columns else rides.withColumn("eventTime", rx.event_time())
    return timed.withWatermark("eventTime", delay) if delay is not None else timed


def cleanse_rides(rides: DataFrame) -> DataFrame:
    return rides.filter(rx.inside_city())


def start_rides(rides: DataFrame) -> DataFrame:
    return rides.filter("isStart")


def end_rides(rides: DataFrame) -> DataFrame:
    return rides.filter("NOT isStart")


def drop_every_nth(df: DataFrame, key: str, n: int) -> DataFrame:
    return df.filter(F.col(key) % n != 0)


def ride_cells(rides: DataFrame) -> DataFrame:
    return rides.withColumn("cell", rx.ride_cell())


def dest_cells(rides: DataFrame) -> DataFrame:
    return rides.withColumn("destCell", rx.dest_cell())


# --- windows -------------------------------------------------------------------------------------


def popular_places(
    rides: DataFrame,
    min_count: int = 20,
    size: str = "15 minutes",
    slide: str = "5 minutes",
) -> DataFrame:
    """Cells with at least ``min_count`` starts or ends in a sliding window."""
    counts = (
        ride_cells(cleanse_rides(with_event_time(rides)))
        .groupBy(F.window("eventTime", size, slide), "cell", "isStart")
        .agg(F.count("isStart").alias("cnt"))
        .filter(F.col("cnt") >= min_count)
    )
    return counts.select(
        geo.cell_center_lon(F.col("cell")).alias("lon"),
        geo.cell_center_lat(F.col("cell")).alias("lat"),
        F.col("window.start").alias("windowStart"),
        F.col("window.end").alias("windowEnd"),
        "isStart",
        "cnt",
    )


POPULAR_PLACES_SQL = """
SELECT window(eventTime, '15 minutes', '5 minutes') AS span,
       toCoords(toCellId(if(isStart, startLon, endLon), if(isStart, startLat, endLat))) AS place,
       isStart AS starting, count(*) AS events
FROM {rides}
WHERE isInNYC(startLon, startLat) AND isInNYC(endLon, endLat)
GROUP BY 1, 2, 3
HAVING events > {over}
"""


def hourly_tips(fares: DataFrame, size: str = "1 hour") -> DataFrame:
    """Tips per driver and hour."""
    return _tips_by_driver(fares, size).select(
        F.col("window.end").alias("windowEnd"), "driverId", "tips"
    )


def _tips_by_driver(fares: DataFrame, size: str) -> DataFrame:
    return fares.groupBy(F.window("startTime", size), "driverId").agg(
        F.sum(F.col("tip").cast("double")).alias("tips")
    )


def hourly_tip_max(fares: DataFrame, size: str = "1 hour") -> DataFrame:
    """The driver with the highest tips of each hour; the smallest driverId wins ties."""
    return (
        _tips_by_driver(fares, size)
        .groupBy(F.window(F.window_time("window"), size))
        .agg(F.max(F.struct("tips", (-F.col("driverId")).alias("rank"))).alias("best"))
        .select(
            F.col("window.end").alias("windowEnd"),
            (-F.col("best.rank")).alias("driverId"),
            F.col("best.tips").alias("tips"),
        )
    )


HOURLY_TIPS_HAVING_SQL = """
SELECT window(eventTime, '1 hour') AS span, driverId, sum(double(tip)) AS earned
FROM {fares}
GROUP BY 1, 2
HAVING earned > {over}
"""


def rides_per_hour(rides: DataFrame) -> DataFrame:
    return (
        with_event_time(rides)
        .groupBy(F.window("eventTime", "1 hour"), "isStart")
        .agg(F.count("isStart").alias("cnt"))
        .select(F.col("window.start").alias("windowStart"), "isStart", "cnt")
    )


def avg_duration_by_passengers(rides: DataFrame) -> DataFrame:
    """Average ride duration in ms per passenger count, over END rows (which know both times)."""
    return (
        end_rides(rides)
        .groupBy("passengerCnt")
        .agg(F.avg(F.unix_millis("endTime") - F.unix_millis("startTime")).alias("avgDurationMs"))
    )


# --- counts --------------------------------------------------------------------------------------


def ride_count(rides: DataFrame) -> DataFrame:
    """Events per driver, START and END alike. On a stream use output mode ``update``."""
    return rides.groupBy("driverId").agg(F.count(F.lit(1)).alias("cnt"))


def running_count(
    df: DataFrame,
    key: str,
    order: list[Column],
    position: Column,
    name: str = "cnt",
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """Batch form of a count per key that emits on every row: the row's number within its key.

    ``position`` is the leading order column as a BIGINT.
    """
    rows = split_by_position(df, [key], position, part_rows)
    upto = part_window([key], *order).rowsBetween(Window.unboundedPreceding, 0)
    local = rows.withColumn("_n", F.count(F.lit(1)).over(upto))
    total = with_carries(local, rows, [key], {"_before": Carry(F.count(F.lit(1)), "sum")})
    return drop_parts(
        total.withColumn(name, F.col("_n") + F.coalesce("_before", F.lit(0))).drop("_n", "_before")
    )


def rolling_count(
    df: DataFrame,
    key: str,
    ts: str,
    within_ms: int = 600_000,
    slice_ms: int = 3_600_000,
    name: str = "cnt",
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """Rows of the same key in the last ``within_ms`` (inclusive, ties counted), for every row.

    Time is cut into slices; a row near the end of a slice is also sent to the next one as context, and
    dropped there after counting. For a key above ``part_rows`` rows the count is a difference of two
    running counts: rows up to now, less rows before now - ``within_ms``. Both are looked up in a scan of the
    key's instants that is split over tasks, so neither a busy hour nor a burst sits in one task.
    Rows without a time count among themselves. Batch only; the streaming form is a stateful processor.
    """
    if slice_ms < within_ms:
        raise ValueError("slice_ms must not be shorter than within_ms")
    back = within_ms * 1000
    hot = hot_keys(df, [key], part_rows)
    timed = df.withColumn("_us", F.unix_micros(ts))
    if not hot.take(1):  # the usual case, which needs no second plan
        return _sliced_count(timed, key, ts, within_ms, slice_ms, name).drop("_us")
    rows = with_hot(timed, hot, [key])
    plain = _sliced_count(rows.where("_parts IS NULL"), key, ts, within_ms, slice_ms, name)
    busy = rows.where("_parts IS NOT NULL")
    at = F.explode(F.array(F.struct(F.col("_us").alias("at"), F.lit(1).alias("n")), F.struct((F.col("_us") - back).alias("at"), F.lit(0).alias("n"))))
    instants = busy.select(key, at.alias("i")).groupBy(key, "i.at").agg(F.sum("i.n").alias("_n"))
    parts = split_by_position(instants, [key], F.col("at"), part_rows)
    upto = part_window([key], F.col("at")).rowsBetween(Window.unboundedPreceding, 0)
    local = parts.withColumn("_upto", F.sum("_n").over(upto))
    scanned = with_carries(local, parts, [key], {"_before": Carry(F.sum("_n"), "sum")})
    upto_now = F.col("_upto") + F.coalesce("_before", F.lit(0))
    counts = scanned.select(F.col(key).alias("_of"), F.col("at").alias("_at"), upto_now.alias("_now"), (upto_now - F.col("_n")).alias("_gone"))

    def look_up(found: DataFrame, at: Column, value: str) -> DataFrame:
        picked = counts.select("_of", "_at", value)
        same = F.col(key).eqNullSafe(F.col("_of")) & at.eqNullSafe(F.col("_at"))
        return found.join(picked, same).drop("_of", "_at")

    counted = look_up(look_up(busy, F.col("_us"), "_now"), F.col("_us") - back, "_gone")
    counted = counted.withColumn(name, F.when(F.col("_us").isNull(), F.col("_now")).otherwise(F.col("_now") - F.col("_gone")))
    return plain.unionByName(counted.drop("_now", "_gone")).drop("_us", "_parts")


def _sliced_count(timed: DataFrame, key: str, ts: str, within_ms: int, slice_ms: int, name: str) -> DataFrame:
    ms = F.unix_millis(ts)
    own = F.floor(ms / slice_ms)
    frame = (
        Window.partitionBy(key, PART)
        .orderBy("_us")
        .rangeBetween(-within_ms * 1000, Window.currentRow)
    )
    return (
        timed.withColumn("_own", own)
        .withColumn(
            PART,
            F.explode(F.array_distinct(F.array(own, F.floor((ms + within_ms + 1) / slice_ms)))),
        )
        .withColumn(name, F.count(F.lit(1)).over(frame))
        .filter(F.col(PART).eqNullSafe(F.col("_own")))
        .drop("_own", PART)
    )


def ending_rides_rolling_count(
    rides: DataFrame, cell: int | None = None, slice_ms: int = 3_600_000, part_rows: int = PART_ROWS
) -> DataFrame:
    """For each END row, the ENDs in its cell within the last 10 minutes."""
    ends = end_rides(with_event_time(rides)).withColumn("cell", rx.dest_cell())
    if cell is not None:
        ends = ends.filter(F.col("cell") == cell)
    counted = rolling_count(ends, "cell", "eventTime", slice_ms=slice_ms, part_rows=part_rows)
    return counted.select(F.col("cell").cast("string").alias("cell"), "eventTime", "cnt")


def latest_ride(rides: DataFrame) -> DataFrame:
    """The newest row of each taxi by ride order."""
    timed = with_event_time(rides)
    newest = F.max_by(F.struct(*timed.columns), F.struct(*rx.ride_order()))
    return timed.groupBy("taxiId").agg(newest.alias("r")).select("r.*")


# --- user predicates -----------------------------------------------------------------------------


def match_predicate(rides: DataFrame, predicate: str) -> DataFrame:
    """Rides for which a SQL predicate holds; ``watermark`` is the row's own event time."""
    timed = with_event_time(rides)
    scope = predicate_scope(timed, F.unix_millis("eventTime"))
    check_predicates(scope, [predicate])
    return scope.filter(F.expr(predicate)).drop("ride", "watermark")
