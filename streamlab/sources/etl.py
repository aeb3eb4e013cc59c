"""Raw trip and fare files to ride events and fares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlab.plans.numbering import number_rows
from streamlab.plans.once import once
from streamlab.sources.readers import parse_fares, parse_rides

#: Fixed value: the unknown end time of a START event.
UNKNOWN_TIME = "1970-01-01 00:00:00"


def _tokens(df: DataFrame, column: str) -> DataFrame:
    line = F.translate(F.col(column), "\r", "")
    return df.withColumn("_line", once(line)).withColumn("_t", once(F.split("_line", ",")))


def _numbered(df: DataFrame, time_token: int, row_id: Column | None) -> DataFrame:
    if row_id is not None:
        return df.withColumn("_id", row_id.cast("long"))
    stamp = F.get("_t", F.lit(time_token))
    return number_rows(df, F.substring(stamp, 1, 16), [stamp, F.col("_line")], "_id")


def _line_of(*parts: Column) -> Column:
    """A line that is cut short stays short, and the parser refuses it."""
    return F.concat_ws(",", *parts)


def trip_event_lines(
    trips: DataFrame, row_id: Column | None = None, column: str = "value"
) -> DataFrame:
    """Each raw trip line as a START and an END line (``value``, ``eventTime`` text).

    Trips are numbered by pick-up time (then text), unless ``row_id`` numbers them already.
    """
    t = [F.get("_t", F.lit(i)) for i in range(14)]
    rows = _numbered(_tokens(trips, column), 5, row_id)
    tail = [t[10], t[11], t[12], t[13], t[7], t[0], t[1]]
    start = F.struct(
        t[5].alias("eventTime"),
        _line_of(F.col("_id"), F.lit("START"), t[5], F.lit(UNKNOWN_TIME), *tail).alias("value"),
    )
    end = F.struct(
        t[6].alias("eventTime"),
        _line_of(F.col("_id"), F.lit("END"), t[6], t[5], *tail).alias("value"),
    )
    return rows.select(F.explode(F.array(start, end)).alias("e")).select("e.*")


def trips_to_ride_events(
    trips: DataFrame, row_id: Column | None = None, column: str = "value", ordered: bool = True
) -> DataFrame:
    """Raw trip lines to ride rows, sorted by event time (a range-partitioned sort)."""
    lines = trip_event_lines(trips, row_id, column)
    if ordered:
        lines = lines.orderBy("eventTime", "value")
    return parse_rides(lines)


def raw_fares_to_fares(
    fares: DataFrame, row_id: Column | None = None, column: str = "value"
) -> DataFrame:
    """Raw fare lines to fare rows."""
    # Places of the used tokens.
    places = [0, 1, 3, 4, 8, 9, 10]
    rows = _numbered(_tokens(fares, column), 3, row_id)
    line = _line_of(F.col("_id"), *[F.get("_t", F.lit(i)) for i in places])
    return parse_fares(rows.select(line.alias("value")))
