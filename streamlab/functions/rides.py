"""Expressions over ride, fare and segment rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from streamlab.functions import geo
from streamlab.schemas import EVENT_TIME_FORMAT


def event_time() -> Column:
    return F.when(F.col("isStart"), F.col("startTime")).otherwise(F.col("endTime"))


def ride_order() -> list[Column]:
    """Sort key of rides: event time, START before END on ties, then ids to make it total."""
    return [F.col("eventTime"), ~F.col("isStart"), F.col("rideId")]


def inside_city() -> Column:
    return geo.is_in_nyc(F.col("startLon"), F.col("startLat")) & geo.is_in_nyc(
        F.col("endLon"), F.col("endLat")
    )


def ride_cell() -> Column:
    """Cell where the event happened: START at the pick-up, END at the drop-off."""
    return F.when(
        F.col("isStart"), geo.cell_id(F.col("startLon"), F.col("startLat"))
    ).otherwise(geo.cell_id(F.col("endLon"), F.col("endLat")))


def dest_cell() -> Column:
    return geo.cell_id(F.col("endLon"), F.col("endLat"))


def ride_distance(lon: Column, lat: Column) -> Column:
    """Distance from a point to where the event happened."""
    at_lon = F.when(F.col("isStart"), F.col("startLon")).otherwise(F.col("endLon"))
    at_lat = F.when(F.col("isStart"), F.col("startLat")).otherwise(F.col("endLat"))
    return geo.distance(lon, lat, at_lon, at_lat)


def minutes_between(start: Column, end: Column) -> Column:
    return (F.unix_millis(end) - F.unix_millis(start)) / F.lit(60000.0)


def whole_minutes(start_ms: Column, end_ms: Column) -> Column:
    """Truncating minutes between two epoch-millisecond columns."""
    return ((end_ms - start_ms) / F.lit(60000.0)).cast("long")


def erraticness_label(erraticness: Column) -> Column:
    known = F.when(erraticness < 2.5, "calm").when(erraticness < 5, "busy").otherwise("crazy")
    return F.when(erraticness.isNotNull(), known)


def csv(*fields: Column) -> Column:
    """Fields between commas; a null field is empty, so that the others keep their places."""
    return F.concat_ws(",", *[F.coalesce(f.cast("string"), F.lit("")) for f in fields])


def format_time(ts: Column) -> Column:
    return F.date_format(ts, EVENT_TIME_FORMAT)


def ride_text(end_time_first: bool = False) -> Column:
    """CSV text of a ride. ``end_time_first`` swaps the two times of END rows, as in the files."""
    start, end = format_time(F.col("startTime")), format_time(F.col("endTime"))
    swap = ~F.col("isStart") & F.lit(end_time_first)
    return csv(
        F.col("rideId"),
        F.when(F.col("isStart"), "START").otherwise("END"),
        F.when(swap, end).otherwise(start),
        F.when(swap, start).otherwise(end),
        *[
            F.col(name).cast("string")
            for name in ("startLon", "startLat", "endLon", "endLat")
        ],
        F.col("passengerCnt"),
        F.col("taxiId"),
        F.col("driverId"),
    )


def fare_text() -> Column:
    return csv(
        F.col("rideId"),
        F.col("taxiId"),
        F.col("driverId"),
        format_time(F.col("startTime")),
        F.col("paymentType"),
        *[F.col(name).cast("string") for name in ("tip", "tolls", "totalFare")],
    )


def segment_text() -> Column:
    return F.concat(
        F.unix_millis("startTime").cast("string"),
        F.lit(","),
        F.col("length").cast("string"),
        F.lit(" events,"),
        F.col("maxSpeed").cast("string"),
        F.lit(" kph,"),
        erraticness_label(F.col("erraticness")),
    )


def point_text(ts: Column, value: Column, key: Column | None = None) -> Column:
    """Text of a time-series point: milliseconds, key (if any) and value."""
    parts = [F.unix_millis(ts), value] if key is None else [F.unix_millis(ts), key, value]
    return csv(*parts)
