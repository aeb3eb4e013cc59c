"""Questions asked while rides flow: nearest taxi, ongoing rides, user predicates. Batch forms.

A control row carries the event time at which it was asked. Each question sees what was known at
that time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streamlab.functions import geo
from streamlab.functions import rides as rx
from streamlab.operators.predicates import check_predicates, distinct_predicates, one_of, predicate_scope
from streamlab.operators.rides import end_rides, with_event_time
from streamlab.plans.hotkeys import PART_ROWS, split_by_position
from streamlab.plans.intervals import bucket_join, interval_point_join
from streamlab.plans.scans import Carry, drop_parts, part_window, with_carries
from streamlab.schemas import RIDE_COLUMNS

HOUR_MS = 3_600_000


def _millis(interval: str) -> Column:
    return F.unix_millis(F.timestamp_seconds(F.lit(0)) + F.expr(f"INTERVAL {interval}"))


def next_time(
    controls: DataFrame, after: Column, part_rows: int, name: str = "_until"
) -> DataFrame:
    """For each control the first control time (ms) later than ``after`` (ms); null if none."""
    events = controls.select(
        F.lit(0).alias("_all"), F.unix_millis("ts").alias("_ms"), F.lit(1).alias("_asked")
    ).unionByName(
        controls.select(
            F.lit(0).alias("_all"),
            after.alias("_ms"),
            F.lit(0).alias("_asked"),
            F.struct(*controls.columns).alias("_control"),
        ),
        allowMissingColumns=True,
    )
    rows = split_by_position(events, ["_all"], F.col("_ms"), part_rows)
    asked = F.when(F.col("_asked") == 1, F.col("_ms"))
    later = part_window(["_all"], F.col("_ms")).rangeBetween(1, Window.unboundedFollowing)
    local = rows.withColumn("_near", F.min(asked).over(later)).filter("_asked = 0")
    found = with_carries(
        local, rows, ["_all"], {"_far": Carry(F.min(asked), "min")}, backwards=True
    )
    return found.select("_control.*", F.coalesce("_near", "_far").alias(name))


# --- nearest taxi --------------------------------------------------------------------------------


def taxi_reports(
    rides: DataFrame,
    queries: DataFrame,
    query_ttl: str | None = None,
    bucket_ms: int = HOUR_MS,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """A row (queryId, taxiId, km, ...) for each END ride while a query is active.

    A query is active from its time on. With ``query_ttl`` it is dropped by the first control row
    that comes more than that later. A query at longitude 0 is a tick: it drops others and is not
    stored itself.
    """
    if query_ttl is None:
        asked = queries.withColumn("_until", F.lit(None).cast("long"))
    else:
        expiry = F.unix_millis("ts") + _millis(query_ttl)
        asked = next_time(queries, expiry, part_rows)
    active = asked.filter("lon <> 0").select(
        "queryId", F.col("ts").alias("_asked"), "lon", "lat", "_until"
    )
    ends = end_rides(with_event_time(rides)).select(
        "rideId", "taxiId", "eventTime", "isStart", "startLon", "startLat", "endLon", "endLat"
    )
    pairs = bucket_join(
        active,
        ends,
        F.unix_millis("_asked"),
        F.col("_until"),
        F.unix_millis("eventTime"),
        bucket_ms,
    )
    km = rx.ride_distance(F.col("lon"), F.col("lat")).cast("float")
    return pairs.select("queryId", "taxiId", km.alias("km"), "eventTime", "rideId", "_bucket")


def nearest_taxi(reports: DataFrame) -> DataFrame:
    """The closest report of each query; the earliest one wins ties."""
    best = F.min(F.struct("km", "eventTime", "rideId", "taxiId"))
    return (
        reports.groupBy("queryId")
        .agg(best.alias("b"))
        .select("queryId", "b.taxiId", "b.km", "b.eventTime")
    )


def nearest_taxi_improvements(reports: DataFrame) -> DataFrame:
    """The reports that are closer than all earlier ones of their query.

    A first pass keeps the improvements within each time bucket, so that one query's reports are
    read in parallel; the second pass compares those few rows across buckets.
    """
    def improving(rows: DataFrame, keys: list[str]) -> DataFrame:
        earlier = (
            Window.partitionBy(*keys)
            .orderBy("eventTime", "rideId")
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        return (
            rows.withColumn("_best", F.min("km").over(earlier))
            .filter("_best IS NULL OR km < _best")
            .drop("_best")
        )

    per_bucket = improving(reports, ["queryId", "_bucket"])
    return improving(per_bucket, ["queryId"]).select("queryId", "taxiId", "km", "eventTime")


# --- latest ride per taxi ------------------------------------------------------------------------


def ride_validity(rides: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """Each ride row with ``_until``: when the next row of the same taxi replaces it (null: never)."""
    timed = with_event_time(rides).withColumn("_ms", F.unix_millis("eventTime"))
    rows = split_by_position(timed, ["taxiId"], F.col("_ms"), part_rows)
    in_order = part_window(["taxiId"], *rx.ride_order())
    local = rows.withColumn("_near", F.lead("_ms").over(in_order))
    found = with_carries(
        local, rows, ["taxiId"], {"_far": Carry(F.min("_ms"), "min")}, backwards=True
    )
    return drop_parts(found.withColumn("_until", F.coalesce("_near", "_far")).drop("_near", "_far"))


def ongoing_rides(
    rides: DataFrame, controls: DataFrame, part_rows: int = PART_ROWS
) -> DataFrame:
    """For each control (controlId, ts, minutes): taxis whose latest row then is a START at least
    that many whole minutes old."""
    valid = ride_validity(rides, part_rows).filter("isStart")
    asked = controls.select(
        "controlId", F.col("ts").alias("controlTime"), "minutes"
    )
    seen = interval_point_join(
        valid, asked, F.col("_ms"), F.col("_until"), F.unix_millis("controlTime")
    )
    age = rx.whole_minutes(F.col("_ms"), F.unix_millis("controlTime"))
    return seen.filter(age >= F.col("minutes")).drop("_ms", "_until")


# --- user predicates -----------------------------------------------------------------------------


def decide_candidates(candidates: DataFrame) -> DataFrame:
    """(kind, at, controlId, rideId, text) of candidates (kind, at, controlId, predicate, ride): questions
    as they are, and the rides for which the predicate holds. ``watermark`` in a predicate is ``at``."""
    texts = distinct_predicates(candidates)
    echo = candidates.filter("kind = 'QUERY'").select(
        "kind", "at", "controlId", F.lit(None).cast("long").alias("rideId"), F.col("predicate").alias("text")
    )
    asked = candidates.filter("kind <> 'QUERY'").select("kind", "at", "controlId", "predicate", "ride.*")
    scope = predicate_scope(asked, F.unix_millis("at"))
    check_predicates(scope, texts)
    found = scope.filter(one_of(texts, F.col("predicate"))).select("kind", "at", "controlId", "rideId", rx.ride_text().alias("text"))
    return echo.unionByName(found)


def taxi_query(
    rides: DataFrame,
    controls: DataFrame,
    bucket_ms: int = HOUR_MS,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """User predicates over rides: the newest control (controlId, ts, predicate) is in force.

    kind QUERY echoes the control; PBE is a taxi's latest row, matching when the control arrives;
    PE is a later row that matches while the control is in force. ``watermark`` in a predicate is
    the control time (PBE) or the row's event time (PE). The distinct predicate texts come to the
    driver, because they become part of the plan.
    """
    asked = controls.select("controlId", F.col("ts").alias("controlTime"), "predicate")
    timed = with_event_time(rides).select(*RIDE_COLUMNS, "eventTime")

    known = interval_point_join(
        ride_validity(timed, part_rows),
        asked,
        F.col("_ms"),
        F.col("_until"),
        F.unix_millis("controlTime"),
    )
    in_force = next_time(controls, F.unix_millis("ts"), part_rows).select(
        "controlId", F.col("ts").alias("controlTime"), "predicate", "_until"
    )
    # A row at exactly the control time is part of what the control already sees.
    later = bucket_join(
        in_force,
        timed,
        F.unix_millis("controlTime") + 1,
        F.col("_until") + 1,
        F.unix_millis("eventTime"),
        bucket_ms,
    )
    texts = distinct_predicates(controls)
    check_predicates(predicate_scope(timed, F.unix_millis("eventTime")), texts)
    echo = asked.select(
        F.lit("QUERY").alias("kind"),
        F.col("controlTime").alias("at"),
        "controlId",
        F.lit(None).cast("long").alias("rideId"),
        F.col("predicate").alias("text"),
    )

    def matches(pairs: DataFrame, kind: str, at: Column) -> DataFrame:
        scope = predicate_scope(pairs, F.unix_millis(at))
        return scope.filter(one_of(texts, F.col("predicate"))).select(
            F.lit(kind).alias("kind"), at.alias("at"), "controlId", "rideId", rx.ride_text().alias("text")
        )

    return echo.unionByName(matches(known, "PBE", F.col("controlTime"))).unionByName(
        matches(later, "PE", F.col("eventTime"))
    )
