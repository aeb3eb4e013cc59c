"""Keyed joins of event streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streamlab.operators.rides import end_rides, start_rides, with_event_time
from streamlab.plans.hotkeys import PART_ROWS, hot_keys_by_sketch, salted_join, split_by_position
from streamlab.plans.scans import Carry, drop_parts, part_window, with_carries


def _newest_per_key(df: DataFrame, key: str, ts: str, name: str) -> DataFrame:
    """One row per key, the newest: later rows of a key overwrite earlier ones. The aggregate
    combines before the shuffle, so a repeated key can neither pile up nor multiply in the join."""
    order = F.struct(ts, *[c for c in df.columns if c not in (key, ts)])
    return df.groupBy(key).agg(F.max_by(F.struct(*df.columns), order).alias(name))


def join_rides_fares(rides: DataFrame, fares: DataFrame, tolerance: str | None = None) -> DataFrame:
    """START rides with their fares as ``(rideId, ride, fare)``.

    Batch: one ride and one fare per rideId. Stream: both sides need ``tolerance``, the largest
    distance of the two event times, so that state is bounded.
    """
    starts = start_rides(with_event_time(rides))
    if starts.isStreaming or fares.isStreaming:
        return _stream_pairs(starts, fares, tolerance or "1 hour", "inner").select(
            "rideId", "ride", "fare"
        )
    left = _newest_per_key(starts, "rideId", "eventTime", "ride")
    right = _newest_per_key(fares, "rideId", "startTime", "fare")
    return left.join(right, "rideId")


def match_or_expire(rides: DataFrame, fares: DataFrame, tolerance: str | None = None) -> DataFrame:
    """Full outer join of START rides and fares with a ``status``: matched, left_only or right_only.

    A ride and a fare match if their times differ by ``tolerance`` at most (batch without it: by any
    time). What has waited longer than that has expired and comes out alone. In batch the newest row of
    an id is the one that counts.
    """
    starts = start_rides(with_event_time(rides))
    if starts.isStreaming or fares.isStreaming:
        pairs = _stream_pairs(starts, fares, tolerance or "1 hour", "full_outer")
    else:
        left = _newest_per_key(starts, "rideId", "eventTime", "ride")
        right = _newest_per_key(fares, "rideId", "startTime", "fare")
        pairs = expiring_join(left, right, "rideId", "ride", "fare", "ride.eventTime", "fare.startTime", tolerance)
    status = (
        F.when(F.col("fare").isNull(), "left_only")
        .when(F.col("ride").isNull(), "right_only")
        .otherwise("matched")
    )
    return pairs.select("rideId", status.alias("status"), "ride", "fare")


def expiring_join(
    left: DataFrame, right: DataFrame, key: str, left_name: str, right_name: str, left_ts: str,
    right_ts: str, tolerance: str | None,
) -> DataFrame:
    """``(key, left, right)`` of two sides with one row per key: pairs that are near in time, other rows alone."""
    pairs = left.join(right, key, "full_outer")
    if tolerance is None:
        return pairs
    span = F.expr(f"INTERVAL {tolerance}")
    lt, rt = F.col(left_ts), F.col(right_ts)
    far = F.coalesce((rt < lt - span) | (rt > lt + span), F.col(left_name).isNotNull() & F.col(right_name).isNotNull())
    one, two = F.col(left_name), F.col(right_name)
    row = lambda a, b: F.struct(a.alias(left_name), b.alias(right_name))
    none = lambda c, name: F.lit(None).cast(c.schema[name].dataType)
    apart = F.array(row(one, none(right, right_name)), row(none(left, left_name), two))
    return pairs.select(key, F.inline(F.when(far, apart).otherwise(F.array(row(one, two)))))


def _stream_pairs(starts: DataFrame, fares: DataFrame, tolerance: str, how: str) -> DataFrame:
    """Stream-stream join. Inputs carry watermarks on eventTime and startTime."""
    left = starts.select(
        F.col("rideId").alias("_l"),
        F.col("eventTime").alias("_lt"),
        F.struct(*[c for c in starts.columns]).alias("ride"),
    )
    right = fares.select(
        F.col("rideId").alias("_r"),
        F.col("startTime").alias("_rt"),
        F.struct(*[c for c in fares.columns]).alias("fare"),
    )
    near = F.expr(
        f"_l = _r AND _rt >= _lt - INTERVAL {tolerance} AND _rt <= _lt + INTERVAL {tolerance}"
    )
    return left.join(right, near, how).withColumn("rideId", F.coalesce("_l", "_r"))


NO_CUSTOMER = "No customer info available"


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: str,
    on: str,
    values: list[str],
    defaults: dict[str, object] | None = None,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """Each left row with ``values`` of the newest right row at or before its time, same key.

    One pass over the union of both sides in time order (right first on ties); no pairs are built.
    Among right rows with equal key and time the one with the greatest values wins.
    """
    right_cols = {"_value": F.struct(*values), "_side": F.lit(0)}
    left_cols = {"_left": F.struct(*left.columns), "_side": F.lit(1)}
    tagged = right.filter(F.col(by).isNotNull()).select(
        by, on, *[c.alias(n) for n, c in right_cols.items()]
    ).unionByName(
        left.select(by, on, *[c.alias(n) for n, c in left_cols.items()]), allowMissingColumns=True
    )
    rows = split_by_position(tagged, [by], F.unix_micros(on), part_rows)
    upto = part_window([by], F.col(on), F.col("_side"), F.col("_value")).rowsBetween(
        Window.unboundedPreceding, 0
    )
    local = rows.withColumn("_seen", F.last("_value", ignorenulls=True).over(upto)).filter(
        "_side = 1"
    )
    newest = F.max_by("_value", F.when(F.col("_side") == 0, F.struct(on, "_value")))
    found = with_carries(
        local.drop("_value", "_side"), rows, [by], {"_earlier": Carry(newest, "last")}
    )
    # A null key equals no key: its rows only share a window, and get the defaults.
    matched = F.when(F.col(by).isNotNull(), F.coalesce("_seen", "_earlier"))
    defaults = defaults or {}
    outputs = [
        (
            F.coalesce(matched[v], F.lit(defaults[v])) if v in defaults else matched[v]
        ).alias(v)
        for v in values
    ]
    return drop_parts(found).select("_left.*", *outputs)


def enrich_trades(trades: DataFrame, customers: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """Trades as ``(trade, customerInfo)`` with the customer version valid at trade time."""
    joined = asof_join(
        trades,
        customers,
        by="customerId",
        on="ts",
        values=["customerInfo"],
        defaults={"customerInfo": NO_CUSTOMER},
        part_rows=part_rows,
    )
    return joined.select(F.struct(*trades.columns).alias("trade"), "customerInfo")


def unmatched_within(
    starts: DataFrame,
    ends: DataFrame,
    key: str,
    start_ts: str,
    end_ts: str,
    within: str,
    horizon: Column | None = None,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """Start rows without an end row of the same key up to ``within`` later.

    An end before the start counts, because order of arrival does not matter. Only the earliest end
    per key is needed, so ends are reduced before the join. With ``horizon`` only starts whose time
    has run out by then are reported.
    """
    span = F.expr(f"INTERVAL {within}")
    first_end = ends.groupBy(key).agg(F.min(end_ts).alias("_end"))
    # Keys are ids that mostly occur once: counting them all would shuffle them all.
    hot = hot_keys_by_sketch(starts, [key], part_rows)
    joined = salted_join(starts, first_end, [key], [start_ts], "left", part_rows, hot=hot)
    open_rows = joined.filter(
        F.col("_end").isNull() | (F.col("_end") > F.col(start_ts) + span)
    ).drop("_end")
    if horizon is not None:
        open_rows = open_rows.filter(F.col(start_ts) + span <= horizon)
    return open_rows.select(*starts.columns)


def long_rides(
    rides: DataFrame, within: str = "120 minutes", horizon: Column | None = None,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """START rows of rides that are not over after two hours."""
    timed = with_event_time(rides)
    ends = end_rides(timed).select("rideId", F.col("eventTime").alias("_endTime"))
    return unmatched_within(
        start_rides(timed), ends, "rideId", "eventTime", "_endTime", within, horizon, part_rows
    )


def sequence_timeout(
    events: DataFrame,
    key: str,
    ts: str,
    first: Column,
    second: Column,
    within: str,
    horizon: Column | None = None,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """Rows matching ``first`` that no row matching ``second`` follows in time (same key)."""
    seconds = events.filter(second).select(key, F.col(ts).alias("_secondTime"))
    return unmatched_within(
        events.filter(first), seconds, key, ts, "_secondTime", within, horizon, part_rows
    )
