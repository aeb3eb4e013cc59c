"""Streaming forms of the operators that need their own state. Each equals its batch form on the rows
that the watermark has passed.

Inputs are streaming DataFrames with an event-time column; ``delay`` is how late rows may come.
Operators with a built-in streaming form (windows, sessions, joins, counts) are not here: the batch
functions take streams directly.
"""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from streamlab.functions import geo
from streamlab.functions.rides import erraticness_label
from streamlab.operators import nearest, patterns, travel
from streamlab.operators.rides import with_event_time
from streamlab.schemas import RIDE_COLUMNS
from streamlab.streaming import processors

# Processors travel to the executors by value, so that workers need no copy of this package.
cloudpickle.register_pickle_by_value(processors)

#: Buckets of nearest-taxi queries. Runs of rides pass every bucket, so there should be no more than the queries need.
QUERY_BUCKETS = 4

#: Rides of so many microseconds wait in one bucket before they become runs.
RUN_SLICE_US = 300_000_000

#: Buckets of keys with state of their own. Fixed, because a query that starts again from its checkpoint must find its
#: keys; many more than a cluster has cores would only add calls to the state store.
KEY_BUCKETS = 256


def _width(df: DataFrame, buckets: int | None) -> int:
    """Buckets that keyed state is spread over. Control rows are repeated once per bucket; rows of a taxi
    live in one. By default as many as the shuffle has partitions; a query that starts again from its
    checkpoint must be given the number that it began with."""
    return buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _apply(
    df: DataFrame, keys: list[str], processor: StatefulProcessor, event_time: str = ""
) -> DataFrame:
    if isinstance(processor, processors.InOrder):
        if keys != ["_bucket"]:
            df = _dealt(df, keys)
        df = df.select("_bucket", *[c for c in ("_time",) if c in df.columns], _packed(processor.fields).alias("packed"))
        return df.groupBy("_bucket").transformWithStateInPandas(
            processor, processor.output, "append", "EventTime", eventTimeColumnName=event_time
        )
    return df.groupBy(*keys).transformWithState(
        processor, processor.output, "append", "EventTime", eventTimeColumnName=event_time
    )


def _dealt(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with their ``key`` as text, and the bucket that holds it."""
    bucket = F.pmod(F.xxhash64(*keys), F.lit(KEY_BUCKETS)).cast("int")
    text = F.to_json(F.struct(*keys), {"timestampFormat": _STAMP})
    return df.withColumn("_bucket", bucket).withColumn("key", text)


def _packed(fields: str) -> Column:
    """The fields of a processor as one text, floats as the doubles that they are."""
    kinds = [part.split() for part in fields.split(", ")]
    given = lambda c, kind: F.col(c).cast("double" if kind == "FLOAT" else kind).alias(c)
    return F.to_json(F.struct(*[given(c, kind) for c, kind in kinds]))


def _timed(df: DataFrame, ts: str, delay: str, wanted: Column | None = None) -> DataFrame:
    """Watermarked ``_time``, ``us`` and the whole row as JSON ``payload``; an empty one where it is not ``wanted``."""
    payload = F.to_json(F.struct(*df.columns), {"timestampFormat": _STAMP})
    if wanted is not None:
        payload = F.when(wanted, payload).otherwise("")
    return (
        df.withColumn("payload", payload)
        .withColumn("_time", F.col(ts))
        .withWatermark("_time", delay)
        .withColumn("us", F.unix_micros("_time"))
    )


_STAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def _unpack(payload: str, like: DataFrame) -> Column:
    return F.from_json(payload, like.schema, {"timestampFormat": _STAMP})


def _micros(interval: str) -> int:
    """Microseconds of text such as '2 hours'."""
    count, unit = interval.split()
    unit = unit.rstrip("s")
    return 1000 * int(count) * {
        "millisecond": 1, "second": 1000, "minute": 60_000, "hour": 3_600_000, "day": 86_400_000,
    }[unit]


def _from_us(name: str) -> Column:
    return F.timestamp_micros(F.col(name))


def long_rides(rides: DataFrame, within: str = "120 minutes", delay: str = "60 seconds") -> DataFrame:
    timed = with_event_time(rides)
    rows = _timed(timed, "eventTime", delay, F.col("isStart")).select("rideId", "isStart", "us", "payload", "_time")
    found = _apply(rows, ["rideId"], processors.OpenStarts(_micros(within)))
    return found.select(_unpack("payload", timed).alias("r")).select("r.*")


def event_time_sort(
    df: DataFrame, key: str, ts: str, tie: Column | None = None, delay: str = "30 seconds"
) -> DataFrame:
    """Rows with their place (``seq``) in the event-time order of their key; late rows are dropped."""
    order = F.lit(0) if tie is None else tie
    rows = _timed(df, ts, delay).select(
        key, "us", order.cast("long").alias("tie"), "payload", "_time"
    )
    found = _apply(rows, [key], processors.SortedRows())
    return found.select(_unpack("payload", df).alias("r"), "seq").select("r.*", "seq")


def event_time_sort_with_late(
    df: DataFrame, key: str, ts: str, tie: Column | None = None, delay: str = "30 seconds"
) -> DataFrame:
    """All rows with ``seq``, ``late`` and ``behindMs``: ``event_time_sort``, and the rows that it drops.

    A row is late if its time is not after the watermark of the micro-batches before it; it comes out in the
    micro-batch in which it arrives, ``behindMs`` behind that watermark, without a place. A row without a time
    is late and has no ``behindMs``. ``runs.start_with_late`` writes the two kinds to outputs of their own.
    """
    order = F.lit(0) if tie is None else tie
    # Without the watermarked column Spark does not drop late rows, and the time still moves the timers.
    rows = _timed(df, ts, delay).select(key, "us", order.cast("long").alias("tie"), "payload")
    found = _apply(rows, [key], processors.SortedRowsAndLate())
    marks = ["seq", "late", "behindMs"]
    return found.select(_unpack("payload", df).alias("r"), *marks).select("r.*", *marks)


def rolling_count(
    df: DataFrame, key: str, ts: str, within: str = "10 minutes", delay: str = "60 seconds"
) -> DataFrame:
    rows = _timed(df, ts, delay).select(
        key, "us", F.lit(0).cast("long").alias("tie"), "payload", "_time"
    )
    found = _apply(rows, [key], processors.RollingCount(_micros(within)))
    return found.select(_unpack("payload", df).alias("r"), "cnt").select("r.*", "cnt")


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: str,
    on: str,
    value: str,
    default: str | None = None,
    emit: str = "final",
    delay: str = "60 seconds",
) -> DataFrame:
    """Left rows with ``value`` (text) of the newest right row at or before their time, and ``final``.

    ``emit='provisional+final'`` answers on arrival too, and corrects the answer when it changes.
    """
    sides = left.select(
        F.col(by),
        F.col(on).alias("_time"),
        F.lit(1).cast("long").alias("tie"),
        F.to_json(F.struct(*left.columns), {"timestampFormat": _STAMP}).alias("payload"),
        F.lit(None).cast("string").alias("value"),
    ).unionByName(
        right.select(
            F.col(by),
            F.col(on).alias("_time"),
            F.lit(0).cast("long").alias("tie"),
            F.lit(None).cast("string").alias("payload"),
            F.col(value).cast("string").alias("value"),
        )
    )
    rows = sides.withWatermark("_time", delay).withColumn("us", F.unix_micros("_time")).withColumn("answered", F.lit(False))
    found = _apply(rows, [by], processors.AsOf(early=emit == "provisional+final"))
    return found.select(
        _unpack("payload", left).alias("r"), F.coalesce("value", F.lit(default)).alias(value), "final"
    ).select("r.*", value, "final")


def driving_segments(
    cars: DataFrame, require_leading_stop: bool = False, delay: str = "30 seconds"
) -> DataFrame:
    rows = cars.select(
        "carId",
        F.col("ts").alias("_time"),
        F.unix_micros("ts").alias("us"),
        F.lit(0).cast("long").alias("tie"),
        "speed",
        "throttle",
    ).withWatermark("_time", delay)
    found = _apply(rows, ["carId"], processors.DrivingSegments(require_leading_stop))
    return found.select(
        "carId",
        _from_us("startUs").alias("startTime"),
        "length",
        "maxSpeed",
        "erraticness",
        erraticness_label(F.col("erraticness")).alias("label"),
    )


def travel_time_predictions(rides: DataFrame, delay: str = "60 seconds") -> DataFrame:
    rows = (
        travel.travel_features(rides)
        .withColumn("_time", F.col("eventTime"))
        .withWatermark("_time", delay)
        .select(
            "destCell",
            "_time",
            F.unix_micros("_time").alias("us"),
            (~F.col("isStart")).cast("long").alias("tie"),
            "bucket",
            "distance",
            "minutes",
            "rideId",
        )
    )
    return _apply(rows, ["destCell"], processors.TravelTimes())


def average_changes(df: DataFrame, key: str, value: Column) -> DataFrame:
    """(key, change, n, average, version): the average of whole numbers per key as deletes and inserts, once per micro-batch
    in which it changes. Null values count for nothing, a null key is a key. ``replay`` gives the table."""
    rows = df.select(F.to_json(F.struct(key)).alias("_key"), value.cast("long").alias("value"))
    changes = processors.AverageChanges()
    found = rows.groupBy("_key").transformWithState(changes, changes.output, "append", "None")
    keyed = F.from_json("key", df.select(key).schema)
    return found.select(keyed[key].alias(key), "change", "n", "average", "version")


def replay(log: DataFrame, keys: list[str]) -> DataFrame:
    """The table after all changes: each insert that no delete of the same version took back."""
    count = F.sum(F.when(F.col("change") == "insert", 1).otherwise(-1))
    return log.groupBy(*keys, "n", "average", "version").agg(count.alias("_left")).where("_left > 0").drop("_left", "version")


def match_pattern(
    df: DataFrame,
    keys: list[str],
    ts: str,
    steps: list[patterns.Step],
    within: str | None = None,
    tie: Column | None = None,
    delay: str = "60 seconds",
) -> DataFrame:
    """Matches and timeouts as ``patterns.match_pattern`` has them, by the same automaton."""
    automaton = patterns.compile_steps(steps)
    fits = patterns.fitting_steps(steps).cast("int")
    order = F.lit(0) if tie is None else tie
    # Only a row that begins an attempt comes out.
    rows = _timed(df.withColumn("_fits", fits), ts, delay, F.col("_fits").bitwiseAND(1) == 1).select(
        *keys, "us", order.cast("long").alias("tie"), "payload", F.col("_fits").alias("fits"), "_time"
    )
    within_us = None if within is None else patterns.micros(within)
    found = _apply(rows, keys, processors.Attempts(automaton.table.tolist(), automaton.first, within_us))
    return found.select(_unpack("payload", df).alias("r"), F.col("kind").alias("outcome"), _from_us("endUs").alias("matchedAt"), "rowsBetween").select(
        "r.*", "outcome", "matchedAt", "rowsBetween"
    )


def _with_controls(
    rows: DataFrame, controls: DataFrame, bucket: Column, delay: str, buckets: int | None
) -> DataFrame:
    """Rows in their bucket and every control row in all buckets, under one watermark: controls can
    move time on but never hold it back."""
    buckets = _width(rows, buckets)
    placed = rows.withColumn("_bucket", F.pmod(F.xxhash64(bucket), F.lit(buckets)).cast("int"))
    repeated = controls.withColumn("_bucket", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    both = placed.unionByName(repeated, allowMissingColumns=True)
    return both.withWatermark("_time", delay).withColumn("us", F.unix_micros("_time"))


def match_sequence_rules(
    items: DataFrame,
    rules: DataFrame,
    key: str,
    ts: str,
    shape: str = "shape",
    order: str = "seq",
    delay: str = "60 seconds",
    buckets: int | None = None,
) -> DataFrame:
    """Items and rules as streams; a rule (with its own ``ts``) applies to the items after it."""
    rows = items.select(
        F.col(ts).alias("_time"),
        F.col(order).cast("long").alias("tie"),
        F.col(key).cast("string").alias("item"),
        F.col(shape).alias("shape"),
        F.to_json(F.struct(*items.columns), {"timestampFormat": _STAMP}).alias("payload"),
    )
    controls = rules.select(
        F.col(ts).alias("_time"), F.lit(-1).cast("long").alias("tie"), "rule", "first", "second"
    )
    both = _with_controls(rows, controls, F.col("item"), delay, buckets)
    found = _apply(both, ["_bucket"], processors.SequenceRules())
    return found.select(
        "rule",
        _unpack("firstPayload", items).alias("firstItem"),
        _unpack("secondPayload", items).alias("secondItem"),
    )


def ongoing_rides(
    rides: DataFrame, controls: DataFrame, delay: str = "60 seconds", buckets: int | None = None
) -> DataFrame:
    timed = with_event_time(rides)
    rows = timed.select(
        F.col("eventTime").alias("_time"),
        (~F.col("isStart")).cast("long").alias("tie"),
        "taxiId",
        "isStart",
        F.to_json(F.struct(*timed.columns), {"timestampFormat": _STAMP}).alias("payload"),
    )
    asked = controls.select(
        F.col("ts").alias("_time"), F.lit(9).cast("long").alias("tie"), "controlId", "minutes"
    )
    both = _with_controls(rows, asked, F.col("taxiId"), delay, buckets)
    found = _apply(both, ["_bucket"], processors.OngoingRides())
    return found.select(
        "controlId", _from_us("controlUs").alias("controlTime"), _unpack("payload", timed).alias("r")
    ).select("controlId", "controlTime", "r.*")


def nearest_taxi(
    rides: DataFrame,
    queries: DataFrame,
    query_ttl: str | None = "15 minutes",
    report_ttl: str | None = "8 hours",
    delay: str = "60 seconds",
    buckets: int = QUERY_BUCKETS,
) -> DataFrame:
    """New nearest taxis per query, as ``nearest.nearest_taxi_improvements`` has them.

    Rides wait once, dealt by slices of time, and leave as runs of many rides. Queries are dealt to buckets and keep
    their best there; runs and the times of all queries pass every bucket. Only improvements come out.
    """
    ends = nearest.located_ends(rides).select(
        F.col("eventTime").alias("_time"), F.col("rideId").alias("tie"), "taxiId", "lon", "lat", "cosLat"
    )
    asked = queries.select(
        F.col("ts").alias("_time"), F.lit(-(1 << 62)).cast("long").alias("tie"), "queryId", "lon", "lat"
    )
    both = ends.unionByName(asked, allowMissingColumns=True)
    both = both.withWatermark("_time", delay).withColumn("us", F.unix_micros("_time"))
    in_slice = F.col("us") - F.pmod(F.col("us"), F.lit(RUN_SLICE_US))
    both = both.withColumn("_bucket", F.pmod(F.xxhash64(in_slice), F.lit(KEY_BUCKETS)).cast("int"))
    runs = _apply(both, ["_bucket"], processors.RideRuns(RUN_SLICE_US), "_time")
    own = F.pmod(F.xxhash64("queryId"), F.lit(buckets)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(buckets - 1)))
    dealt = runs.withColumn("_bucket", every).withColumn("mine", F.col("_bucket") == own)
    ttls = [None if ttl is None else _micros(ttl) for ttl in (query_ttl, report_ttl)]
    best = _apply(dealt, ["_bucket"], processors.NearestTaxi(*ttls, geo.DEGREE_KM))
    return best.select("queryId", "taxiId", "km", _from_us("us").alias("eventTime"))


def taxi_query_candidates(
    rides: DataFrame, controls: DataFrame, delay: str = "60 seconds", buckets: int | None = None
) -> DataFrame:
    """(kind, at, controlId, predicate, ride): every question, and the rides that it is put to.

    Rides and questions wait for the watermark, so the order in which they arrive does not matter.
    ``control.decide_candidates`` says which of them hold.
    """
    timed = with_event_time(rides).select(*RIDE_COLUMNS, "eventTime")
    rows = timed.select(
        F.col("eventTime").alias("_time"),
        F.unix_micros("eventTime").alias("atUs"),
        (~F.col("isStart")).cast("long").alias("tie"),
        "rideId",
        F.coalesce(F.col("taxiId").cast("string"), F.lit("")).alias("taxi"),
        F.to_json(F.struct(*timed.columns), {"timestampFormat": _STAMP}).alias("payload"),
    )
    asked = controls.select(
        F.col("ts").alias("_time"), F.unix_micros("ts").alias("atUs"), F.lit(9).cast("long").alias("tie"), "controlId", "predicate"
    )
    both = _with_controls(rows, asked, F.col("taxi"), delay, buckets)
    # A question sees all rows of its millisecond.
    asked_us = F.floor(F.col("us") / 1000) * 1000 + 999
    both = both.withColumn("us", F.when(F.col("controlId").isNotNull(), asked_us).otherwise(F.col("us")))
    found = _apply(both, ["_bucket"], processors.TaxiQueries())
    return found.select("kind", _from_us("atUs").alias("at"), "controlId", "predicate", _unpack("payload", timed).alias("ride"))
