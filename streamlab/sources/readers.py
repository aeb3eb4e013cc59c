"""Readers. Every text reader has a ``parse_*`` twin that takes a DataFrame with a ``value`` column,
so the same parser serves files, topics and streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streamlab import schemas
from streamlab.operators import mail
from streamlab.operators.rides import with_event_time
from streamlab.plans.once import once


def _lines(spark: SparkSession, path: str, streaming: bool, **options: str) -> DataFrame:
    reader = spark.readStream if streaming else spark.read
    return reader.options(**options).text(path)


def _fields(line: Column, pattern: str, count: int, keep: list[int], strict: bool) -> Column:
    """The wanted tokens of a line; a line with another number of tokens fails or becomes null."""
    tokens = F.split(line, pattern)
    wanted = tokens if len(keep) == count else F.array(*[F.get(tokens, F.lit(i)) for i in keep])
    if not strict:
        return once(F.when(F.size(tokens) == count, wanted))
    refuse = F.raise_error(F.concat(F.lit("Invalid record: "), line))
    return once(F.when(F.size(tokens) == count, wanted).otherwise(refuse))


def _as(token: Column, kind: str, strict: bool) -> Column:
    """A token as a number or time. What cannot be read fails, or becomes null; no text is no value."""
    if kind == "float":
        token = F.when(token == "", F.lit("0")).otherwise(token)
    if kind in (schemas.EVENT_TIME_FORMAT, schemas.CAR_TIME_FORMAT):
        return F.to_timestamp(token, kind) if strict else F.try_to_timestamp(token, F.lit(kind))
    return token.cast(kind) if strict else token.try_cast(kind)


def _kept(rows: DataFrame, fields: dict[str, Column], strict: bool, corrupt: str | None) -> DataFrame:
    """The parsed columns. Unless ``strict``, a line with a field that cannot be read is left out, or,
    with ``corrupt``, stays as a row of nulls with the line in the column of that name."""
    if strict:
        return rows.select(*[c.alias(name) for name, c in fields.items()])
    read = rows.select("_line", "_t", F.struct(*[c.alias(name) for name, c in fields.items()]).alias("_r"))
    unread = F.col("_t").isNull()
    for name in fields:
        unread = unread | F.col(f"_r.{name}").isNull()
    if corrupt is None:
        return read.filter(~unread).select("_r.*")
    kept = [F.when(~unread, F.col(f"_r.{name}")).alias(name) for name in fields]
    return read.select(*kept, F.when(unread, F.col("_line")).alias(corrupt))


def _tokens(df: DataFrame, column: str, pattern: str, count: int, keep: list[int], strict: bool) -> DataFrame:
    line = F.col(column)
    return df.select(line.alias("_line"), _fields(line, pattern, count, keep, strict).alias("_t"))


def parse_rides(
    df: DataFrame, strict: bool = True, column: str = "value", corrupt: str | None = None
) -> DataFrame:
    """Ride lines of 11 tokens. The first time is the event's own: an END line has its end first.

    A line that cannot be read fails; see ``_kept`` for ``strict=False`` and ``corrupt``.
    """
    t = F.col("_t")
    kind = F.upper(t[1])
    known = F.when(kind.isin("START", "END"), kind == "START")
    if strict:
        known = F.coalesce(known, F.raise_error(F.concat(F.lit("Invalid record: "), F.array_join("_t", ","))))
    own, other = (_as(t[i], schemas.EVENT_TIME_FORMAT, strict) for i in (2, 3))
    rows = _tokens(df, column, ",", 11, list(range(11)), strict)
    rows = rows.select("*", known.alias("isStart"), own.alias("_own"), other.alias("_other"))
    fields = {
        "rideId": _as(t[0], "long", strict),
        "isStart": F.col("isStart"),
        "startTime": F.when(F.col("isStart"), F.col("_own")).otherwise(F.col("_other")),
        "endTime": F.when(F.col("isStart"), F.col("_other")).otherwise(F.col("_own")),
    }
    places = ["startLon", "startLat", "endLon", "endLat"]
    fields |= {name: _as(t[i], "float", strict) for i, name in enumerate(places, start=4)}
    fields |= {
        "passengerCnt": _as(t[8], "smallint", strict),
        "taxiId": _as(t[9], "long", strict),
        "driverId": _as(t[10], "long", strict),
    }
    return _kept(rows, fields, strict, corrupt)


def read_rides(
    spark: SparkSession, path: str, streaming: bool = False, strict: bool = True, corrupt: str | None = None
) -> DataFrame:
    return parse_rides(_lines(spark, path, streaming), strict, corrupt=corrupt)


def parse_fares(
    df: DataFrame, strict: bool = True, column: str = "value", corrupt: str | None = None
) -> DataFrame:
    t = F.col("_t")
    fields = {name: _as(t[i], "long", strict) for i, name in enumerate(["rideId", "taxiId", "driverId"])}
    fields |= {"startTime": _as(t[3], schemas.EVENT_TIME_FORMAT, strict), "paymentType": t[4]}
    fields |= {name: _as(t[i], "float", strict) for i, name in enumerate(["tip", "tolls", "totalFare"], start=5)}
    return _kept(_tokens(df, column, ",", 8, list(range(8)), strict), fields, strict, corrupt)


def read_fares(
    spark: SparkSession, path: str, streaming: bool = False, strict: bool = True, corrupt: str | None = None
) -> DataFrame:
    return parse_fares(_lines(spark, path, streaming), strict, corrupt=corrupt)


def parse_car_events(
    df: DataFrame, strict: bool = True, column: str = "value", corrupt: str | None = None
) -> DataFrame:
    """Car lines of 23 tokens between commas or semicolons."""
    # Places of the used tokens, in the order of the output columns.
    places = [1, 0, 22, 20, 21, 7, 9, 12, 19]
    t = F.col("_t")
    numbers = ["longitude", "latitude", "consumption", "speed", "throttle", "engineload"]
    fields = {"id": t[0], "carId": t[1], "ts": _as(t[2], schemas.CAR_TIME_FORMAT, strict)}
    fields |= {name: _as(t[i], "float", strict) for i, name in enumerate(numbers, start=3)}
    return _kept(_tokens(df, column, "(,|;)\\s*", 23, places, strict), fields, strict, corrupt)


def read_car_events(
    spark: SparkSession, path: str, streaming: bool = False, strict: bool = True, corrupt: str | None = None
) -> DataFrame:
    return parse_car_events(_lines(spark, path, streaming), strict, corrupt=corrupt)


def split_mails(df: DataFrame, columns: list[str] | None = None, column: str = "value") -> DataFrame:
    """Mail records to (some of) their six fields."""
    wanted = schemas.MAIL_COLUMNS if columns is None else columns
    tokens = F.split(F.col(column), "#\\|#")
    return df.filter(F.col(column) != "").select(
        *[F.get(tokens, F.lit(schemas.MAIL_COLUMNS.index(name))).alias(name) for name in wanted]
    )


def read_mails(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    return split_mails(
        _lines(spark, path, False, lineSep=mail.RECORD_DELIMITER), columns
    )


def read_mbox(spark: SparkSession, path: str, prefix: str = mail.ARCHIVE_PREFIX) -> DataFrame:
    """Raw mails of an archive, one per row, each with its cut-off prefix put back."""
    raw = _lines(spark, path, False, lineSep=prefix).filter("value <> ''")
    return raw.select(
        F.when(F.col("value").startswith("From "), F.col("value"))
        .otherwise(F.concat(F.lit(prefix), F.col("value")))
        .alias("value")
    )


def read_edges(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", schema=schemas.EDGE)


def read_topic(spark: SparkSession, fmt: str = "kafka", **options: str) -> DataFrame:
    """A stream of ``value`` strings from a message topic, from its earliest message on. ``fmt`` may
    name any streaming source with a value column."""
    defaults = {"startingOffsets": "earliest"} if fmt == "kafka" else {}
    stream = spark.readStream.format(fmt).options(**{**defaults, **options}).load()
    return stream.select(F.col("value").cast("string").alias("value"))


def decode_rides(df: DataFrame, delay: str | None = "60 seconds") -> DataFrame:
    """Message values to rides with event time and a watermark for late messages."""
    return with_event_time(parse_rides(df.select(F.col("value").cast("string").alias("value"))), delay)


def parse_controls(df: DataFrame, kind: str, ts: Column, column: str = "value") -> DataFrame:
    """Control lines, one per row: ``nearest`` (lon, lat), ``ongoing`` (minutes) or ``predicate``.

    ``ts`` is the event time the control is asked at. Ids are a hash of the content.
    """
    line, at = F.col(column), ts.alias("ts")
    if kind == "nearest":
        parts = F.split(line, ",\\s*")
        lon, lat = parts[0].cast("float"), parts[1].cast("float")
        return df.select(
            F.xxhash64(lon, lat, ts).alias("queryId"), at, lon.alias("lon"), lat.alias("lat")
        )
    if kind == "ongoing":
        return df.select(
            F.xxhash64(line, ts).alias("controlId"), at, F.trim(line).cast("long").alias("minutes")
        )
    if kind == "predicate":
        return df.select(F.xxhash64(line, ts).alias("controlId"), at, line.alias("predicate"))
    raise ValueError(f"unknown control kind: {kind}")


def read_controls(
    spark: SparkSession, path: str, kind: str, ts: Column, streaming: bool = True, fmt: str = "text"
) -> DataFrame:
    reader = spark.readStream if streaming else spark.read
    return parse_controls(reader.format(fmt).load(path), kind, ts)


def register_rides(
    spark: SparkSession, rides: DataFrame, name: str = "TaxiRides", delay: str | None = None
) -> DataFrame:
    """Rides as a SQL table: the ride columns without the two times, plus ``eventTime``."""
    columns = [c for c in schemas.RIDE_COLUMNS if c not in ("startTime", "endTime")]
    table = with_event_time(rides, delay).select(*columns, "eventTime")
    table.createOrReplaceTempView(name)
    return table


def register_fares(
    spark: SparkSession, fares: DataFrame, name: str = "TaxiFares", delay: str | None = None
) -> DataFrame:
    """Fares as a SQL table with ``eventTime`` in place of ``startTime``."""
    columns = [c for c in schemas.FARE_COLUMNS if c != "startTime"]
    table = fares.select(*columns, F.col("startTime").alias("eventTime"))
    if delay is not None:
        table = table.withWatermark("eventTime", delay)
    table.createOrReplaceTempView(name)
    return table

