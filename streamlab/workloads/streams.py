"""Streaming runs over the given tables. Each reads the whole events table as a file stream, runs to the
end of it, and must give the rows of the batch form.

A stream's watermark stops at its last row, so what is still open then would never come out. One more
row in the far future, from a file of its own, lets time pass; its results are filtered away.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlab.operators import joins, rides
from streamlab.plans.lineage import scratch_path
from streamlab.streaming import operators as so
from streamlab.streaming.runs import run_available, run_taxi_query, start_with_late
from streamlab.workloads import batch, tables
from streamlab.workloads.registry import oracle_of, query
from streamlab.workloads.tables import Tables

FLUSH_ID = 1 << 40
FLUSH_USER = -1
DELAY = "1 hour"


def _stream(t: Tables, name: str) -> DataFrame:
    path = f"{t.sf_dir}/{name}.parquet"
    # A pattern, because a file stream refuses a plain file as its folder.
    stream = t.spark.readStream.schema(t.spark.read.parquet(path).schema).parquet(f"{path}*")
    zoneless = [c for c, kind in stream.dtypes if kind == "timestamp_ntz"]
    return stream.withColumns({c: F.col(c).cast("timestamp") for c in zoneless})


def _events(t: Tables, flush_id: int = FLUSH_ID, kind: str = "flush") -> DataFrame:
    events = _stream(t, "events").select("event_id", "ts", "user_id", "event_type", "value")
    path = scratch_path(t.spark, "flush")
    far = F.lit("2100-01-01 00:00:00").cast("timestamp")
    t.spark.range(1).select(
        F.lit(flush_id).cast("long").alias("event_id"),
        far.alias("ts"),
        F.lit(FLUSH_USER).cast("long").alias("user_id"),
        F.lit(kind).alias("event_type"),
        F.lit(0.0).alias("value"),
    ).write.parquet(path)
    return events.unionByName(t.spark.readStream.schema(events.schema).parquet(path))


@query(oracle_of("popular_places"))
def stream_popular_places(t: Tables) -> DataFrame:
    timed = rides.with_event_time(tables.rides_from_events(_events(t)), DELAY)
    found = run_available(rides.popular_places(timed, min_count=2), "popular-places")
    return found.select(
        batch.rounded("lon"), batch.rounded("lat"), "windowStart", "windowEnd", "isStart", "cnt"
    )


@query(oracle_of("hourly_tip_max"))
def stream_hourly_tip_max(t: Tables) -> DataFrame:
    fares = tables.fares_from_events(_events(t)).withWatermark("startTime", DELAY)
    found = run_available(rides.hourly_tip_max(fares), "hourly-tip-max")
    return found.filter(F.col("driverId") != FLUSH_USER).select(
        "windowEnd", "driverId", batch.rounded("tips")
    )


@query(oracle_of("ride_count"))
def stream_ride_count(t: Tables) -> DataFrame:
    counts = rides.ride_count(tables.rides_from_events(_events(t)))
    found = run_available(counts, "ride-count", "update")
    newest = F.max_by("cnt", "batch").alias("cnt")
    return found.filter(F.col("driverId") != FLUSH_USER).groupBy("driverId").agg(newest)


@query(oracle_of("long_rides"))
def stream_long_rides(t: Tables) -> DataFrame:
    found = run_available(so.long_rides(tables.rides_from_events(_events(t)), delay=DELAY), "long-rides")
    return found.filter(F.col("taxiId") != FLUSH_USER).select("rideId", "taxiId", "eventTime")


@query(oracle_of("asof_join"))
def stream_asof_join(t: Tables) -> DataFrame:
    events = _events(t, kind="purchase")
    left = events.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    signups = _stream(t, "events").filter("event_type = 'signup'")
    right = signups.select("user_id", "ts", F.col("event_id").alias("signupId"))
    joined = so.asof_join(left, right, "user_id", "ts", "signupId", delay=DELAY)
    found = run_available(joined, "asof").filter(F.col("user_id") != FLUSH_USER)
    return found.select("event_id", "user_id", "ts", F.col("signupId").cast("long").alias("signupId"))


@query(oracle_of("driving_segments"))
def stream_driving_segments(t: Tables) -> DataFrame:
    cars = tables.cars_from_events(_events(t))
    found = run_available(so.driving_segments(cars, delay=DELAY), "segments")
    return found.select(
        "carId", "startTime", "length", "maxSpeed", batch.rounded("erraticness"), "label"
    )


@query(oracle_of("event_time_order"))
def stream_event_time_sort(t: Tables) -> DataFrame:
    cars = tables.cars_from_events(_events(t))
    found = run_available(
        so.event_time_sort(cars, "carId", "ts", F.col("id").cast("long"), DELAY), "sorted"
    )
    return found.filter(f"carId <> '{FLUSH_USER}'").select("id", "carId", "ts", "seq")


@query(oracle_of("travel_time_predictions"))
def stream_travel_time_predictions(t: Tables) -> DataFrame:
    found = run_available(
        so.travel_time_predictions(tables.rides_from_events(_events(t)), DELAY), "travel-time"
    )
    return found.select("rideId", "prediction")


@query(oracle_of("ongoing_rides"))
def stream_ongoing_rides(t: Tables) -> DataFrame:
    controls = tables.controls_from_nations(_stream(t, "nation"))
    found = run_available(
        so.ongoing_rides(tables.rides_from_events(_events(t)), controls, DELAY, buckets=8), "ongoing"
    )
    return found.select("controlId", "controlTime", "rideId", "taxiId", "eventTime")


@query(
    f"""WITH {tables.RIDES_SQL}, l AS (SELECT * FROM v_rides WHERE "isStart"),
    r AS (SELECT event_id // 2 AS "rideId", ts AS "startTime" FROM events)
    SELECT coalesce(l."rideId", r."rideId") AS "rideId",
    CASE WHEN r."rideId" IS NULL THEN 'left_only' WHEN l."rideId" IS NULL THEN 'right_only'
         ELSE 'matched' END AS status, l."eventTime" AS "rideTime", r."startTime" AS "fareTime"
    FROM l FULL JOIN r ON l."rideId" = r."rideId" AND r."startTime"
      BETWEEN l."eventTime" - INTERVAL 2 MINUTE AND l."eventTime" + INTERVAL 2 MINUTE"""
)
def stream_match_or_expire(t: Tables) -> DataFrame:
    timed = rides.with_event_time(tables.rides_from_events(_events(t)), DELAY)
    paid = _events(t).withColumn("event_id", F.floor(F.col("event_id") / 2))
    fares = tables.fares_from_events(paid.withColumn("value", F.lit(0.0)))
    found = run_available(
        joins.match_or_expire(timed, fares.withWatermark("startTime", DELAY), "2 minutes"), "expire"
    )
    return found.filter(F.col("rideId") < FLUSH_ID >> 2).select(
        "rideId",
        "status",
        F.col("ride.eventTime").alias("rideTime"),
        F.col("fare.startTime").alias("fareTime"),
    )


@query(oracle_of("sequence_rules"))
def stream_sequence_rules(t: Tables) -> DataFrame:
    items = _events(t).select(
        "ts",
        F.col("event_id").alias("seq"),
        F.col("user_id").cast("string").alias("user_id"),
        F.col("event_type").alias("shape"),
    )
    path = scratch_path(t.spark, "rules")
    listed = [(*rule, tables.BASE) for rule in batch.RULES]
    rules = t.spark.createDataFrame(listed, "rule STRING, first STRING, second STRING, ts STRING")
    rules.withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(path)
    given = t.spark.readStream.schema(
        "rule STRING, first STRING, second STRING, ts TIMESTAMP"
    ).parquet(path)
    found = run_available(
        so.match_sequence_rules(items, given, "user_id", "ts", delay=DELAY, buckets=8), "rules"
    )
    return found.select(
        "rule",
        F.col("firstItem.user_id").cast("long").alias("user_id"),
        F.col("firstItem.seq").alias("firstSeq"),
        F.col("secondItem.seq").alias("secondSeq"),
    )


@query(oracle_of("ending_rides_rolling_count"))
def stream_ending_rides_rolling_count(t: Tables) -> DataFrame:
    events = _events(t, flush_id=FLUSH_ID + 1)
    ends = rides.end_rides(rides.with_event_time(tables.rides_from_events(events)))
    located = rides.dest_cells(ends).select("destCell", "eventTime", "taxiId")
    found = run_available(so.rolling_count(located, "destCell", "eventTime", delay=DELAY), "rolling")
    return found.filter(F.col("taxiId") != FLUSH_USER).select(
        F.col("destCell").cast("string").alias("cell"), "eventTime", "cnt"
    )


@query(oracle_of("nearest_taxi_expiring"))
def stream_nearest_taxi(t: Tables) -> DataFrame:
    events = _events(t, flush_id=FLUSH_ID + 1)
    queries = tables.queries_from_nations(_stream(t, "nation"))
    found = run_available(
        so.nearest_taxi(
            tables.rides_from_events(events), queries, "15 minutes", None, DELAY
        ),
        "nearest",
    )
    return found.filter(F.col("taxiId") != FLUSH_USER).select(
        "queryId", "taxiId", F.round(F.col("km").cast("double"), 4).alias("km"), "eventTime"
    )


@query(oracle_of("nearest_taxi_cleanup"))
def stream_nearest_taxi_cleanup(t: Tables) -> DataFrame:
    events = _events(t, flush_id=FLUSH_ID + 1)
    queries = tables.queries_from_nations(_stream(t, "nation"))
    found = run_available(so.nearest_taxi(tables.rides_from_events(events), queries, delay=DELAY), "cleanup")
    return found.filter(F.col("taxiId") != FLUSH_USER).select(
        "queryId", "taxiId", F.round(F.col("km").cast("double"), 4).alias("km"), "eventTime"
    )


def _files(t: Tables, label: str, *parts: DataFrame) -> DataFrame:
    """A stream that reads the parts one after the other, a file at a time."""
    path = scratch_path(t.spark, label)
    for part in parts:
        part.write.mode("append").parquet(path)
    return t.spark.readStream.schema(parts[0].schema).option("maxFilesPerTrigger", 1).parquet(path)


def _flush_row(t: Tables, like: DataFrame, **values: Column) -> DataFrame:
    columns = [values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in like.schema.fields]
    return t.spark.range(1).select(*columns)


@query(oracle_of("taxi_query"))
def stream_taxi_query(t: Tables) -> DataFrame:
    """Rides out of order in four files; the questions come two micro-batches after the first of them."""
    given = tables.rides_from_events(t["events"].withColumn("ts", F.col("ts").cast("timestamp")))
    far = F.lit("2100-01-01 00:00:00")
    last = _flush_row(t, given, isStart=F.lit(True), startTime=far, rideId=F.lit(FLUSH_ID), taxiId=F.lit(FLUSH_USER))
    shuffled = [given.where(F.pmod(F.xxhash64("rideId", "isStart"), F.lit(4)) == k).coalesce(1) for k in range(4)]
    controls = tables.predicates_from_regions(t["region"])
    asked = _files(t, "questions", controls.limit(0).coalesce(1), controls.limit(0).coalesce(1), controls.coalesce(1))
    out, checkpoint = scratch_path(t.spark, "answers"), scratch_path(t.spark, "answers-checkpoint")
    run_taxi_query(_files(t, "rides", *shuffled, last), asked, out, checkpoint, "90 days", once=True).awaitTermination()
    answers = t.spark.read.option("basePath", out).parquet(out)
    # The flush row alone is newer than any question can be.
    return answers.filter(F.col("at") < far.cast("timestamp")).select("kind", "at", "controlId", "rideId")


@query(oracle_of("asof_join"))
def stream_asof_join_provisional(t: Tables) -> DataFrame:
    """Answers on arrival, corrected when the watermark passes; the newest answer of each row."""
    events = t["events"].withColumn("ts", F.col("ts").cast("timestamp"))
    buys = events.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    signups = events.filter("event_type = 'signup'").select("user_id", "ts", F.col("event_id").alias("signupId"))
    last = _flush_row(t, buys, event_id=F.lit(FLUSH_ID), user_id=F.lit(FLUSH_USER), ts=F.lit("2100-01-01 00:00:00"))
    halves = [buys.where(F.col("event_id") % 2 == k).coalesce(1) for k in (0, 1)]
    # Half of the sign-ups come after the rows that they answer.
    known = [signups.where(F.pmod(F.xxhash64("signupId"), F.lit(2)) == k).coalesce(1) for k in (0, 1)]
    joined = so.asof_join(
        _files(t, "buys", *halves, last), _files(t, "signups", *known), "user_id", "ts", "signupId",
        emit="provisional+final", delay="90 days",
    )
    found = run_available(joined, "asof-early").filter(F.col("event_id") != FLUSH_ID)
    newest = F.max_by("signupId", F.struct("batch", "final")).cast("long").alias("signupId")
    return found.groupBy("event_id", "user_id", "ts").agg(newest)


@query(oracle_of("pattern_driving_segments"))
def stream_pattern_driving_segments(t: Tables) -> DataFrame:
    cars = tables.cars_from_events(_events(t))
    found = run_available(
        so.match_pattern(cars, ["carId"], "ts", batch.drive(), tie=F.col("id").cast("long"), delay=DELAY), "pattern"
    )
    return found.select("id", "carId", "ts", "matchedAt", "rowsBetween")


@query(oracle_of("pattern_long_rides"))
def stream_pattern_long_rides(t: Tables) -> DataFrame:
    timed = rides.with_event_time(tables.rides_from_events(_events(t)))
    tie = (~F.col("isStart")).cast("long") * (1 << 32) + F.col("taxiId")
    found = run_available(
        so.match_pattern(timed, ["rideId"], "eventTime", batch.whole_ride(), "120 minutes", tie, DELAY), "pattern-rides"
    )
    return found.filter(F.col("taxiId") != FLUSH_USER).select("rideId", "taxiId", "eventTime", "outcome")


@query(oracle_of("avg_duration_by_passengers"))
def stream_avg_duration_changes(t: Tables) -> DataFrame:
    """The change log over four files of rides, replayed."""
    given = tables.rides_from_events(t["events"].withColumn("ts", F.col("ts").cast("timestamp")))
    parts = [given.where(F.pmod(F.xxhash64("rideId"), F.lit(4)) == k).coalesce(1) for k in range(4)]
    ends = rides.end_rides(_files(t, "rides", *parts))
    log = run_available(so.average_changes(ends, "passengerCnt", F.unix_millis("endTime") - F.unix_millis("startTime")), "changes")
    return so.replay(log, ["passengerCnt"]).select("passengerCnt", F.round("average", 3).alias("avgDurationMs"))


#: Cars arrive in this many parts of as many days; every tenth row comes one part later than its time.
ARRIVALS, ARRIVAL_DAYS, LATE_DELAY_HOURS = 4, 8, 60


@query(
    f"""WITH {tables.CARS_SQL},
    p AS (SELECT *, coalesce(greatest(least(date_diff('day', DATE '{tables.BASE[:10]}', ts::DATE) // {ARRIVAL_DAYS}, {ARRIVALS - 1}), 0)
            + (id::BIGINT % 10 = 0)::INT, 0) AS part FROM v_car),
    w AS (SELECT a.part, max(b.ts) - INTERVAL {LATE_DELAY_HOURS} HOUR AS mark
          FROM (SELECT DISTINCT part FROM p) a LEFT JOIN p b ON b.part < a.part GROUP BY 1),
    m AS (SELECT p.*, ts IS NULL OR coalesce(epoch_us(ts) <= epoch_us(mark) // 1000 * 1000, false) AS late, epoch_us(mark) // 1000 AS mark
          FROM p JOIN w USING (part))
    SELECT id, "carId", ts, late, CASE WHEN late THEN mark - epoch_us(ts) // 1000 END AS "behindMs",
      CASE WHEN NOT late THEN row_number() OVER (PARTITION BY "carId", late ORDER BY ts, id::BIGINT) END AS seq FROM m"""
)
def stream_late_rows(t: Tables) -> DataFrame:
    """Sorted rows and late rows. The stream is stopped and started again for each part that arrives."""
    cars = tables.cars_from_events(t["events"].withColumn("ts", F.col("ts").cast("timestamp")))
    days = F.floor(F.date_diff("ts", F.lit(tables.BASE[:10])) / ARRIVAL_DAYS)
    stray = (F.col("id").cast("long") % 10 == 0).cast("int")
    part = F.coalesce(F.greatest(F.least(days, F.lit(ARRIVALS - 1)), F.lit(0)) + stray, F.lit(0))
    far = F.lit("2100-01-01 00:00:00")
    last = _flush_row(t, cars, id=F.lit(FLUSH_ID), carId=F.lit(FLUSH_USER), ts=far)
    places = [scratch_path(t.spark, label) for label in ("cars", "sorted", "late", "late-checkpoint")]
    given, out, late_out, checkpoint = places
    for rows in [*(cars.where(part == k) for k in range(ARRIVALS + 1)), last]:
        rows.write.mode("append").parquet(given)
        arriving = t.spark.readStream.schema(cars.schema).parquet(given)
        found = so.event_time_sort_with_late(arriving, "carId", "ts", F.col("id").cast("long"), f"{LATE_DELAY_HOURS} hours")
        start_with_late(found, out, late_out, checkpoint, once=True).awaitTermination()
    marked = t.spark.read.option("basePath", out).parquet(out).withColumns({"late": F.lit(False), "behindMs": F.lit(None).cast("long")})
    late = t.spark.read.option("basePath", late_out).parquet(late_out).withColumns({"late": F.lit(True), "seq": F.lit(None).cast("long")})
    both = marked.unionByName(late).filter(F.col("ts") < far.cast("timestamp"))
    return both.select("id", "carId", "ts", "late", "behindMs", "seq")
