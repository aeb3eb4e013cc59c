"""Online travel-time prediction: a no-intercept regression per destination cell and direction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streamlab.functions import geo
from streamlab.functions import rides as rx
from streamlab.operators.rides import cleanse_rides, dest_cells, with_event_time
from streamlab.plans.hotkeys import PART_ROWS, split_by_position
from streamlab.plans.scans import Carry, part_window, with_carries

MODEL_KEYS = ["destCell", "bucket"]


def travel_features(rides: DataFrame) -> DataFrame:
    """City rides with destination cell, direction bucket, distance and (END rows) minutes."""
    c = F.col
    angle = geo.direction_angle(c("endLon"), c("endLat"), c("startLon"), c("startLat"))
    length = geo.distance(c("startLon"), c("startLat"), c("endLon"), c("endLat"))
    return (
        dest_cells(cleanse_rides(with_event_time(rides)))
        .withColumn("bucket", geo.direction_bucket(angle))
        .withColumn("distance", length)
        .withColumn(
            "minutes",
            F.when(~c("isStart"), rx.minutes_between(c("startTime"), c("endTime"))),
        )
    )


def predicted_minutes(n: Column, sxy: Column, sxx: Column, distance: Column) -> Column:
    """Whole minutes by slope * distance; -1 until there are two points to learn from."""
    whole = F.greatest(F.least(sxy / sxx * distance, F.lit(2147483647.0)), F.lit(-2147483648.0))
    return F.when((n >= 2) & (sxx > 0), whole.cast("int")).otherwise(F.lit(-1))


def travel_time_predictions(rides: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """``(rideId, prediction)`` for each START row, learnt from the END rows before it. Batch form."""
    features = (
        travel_features(rides)
        .select(*MODEL_KEYS, "eventTime", "isStart", "rideId", "distance", "minutes")
        .withColumn("_xy", F.col("distance") * F.col("minutes"))
        .withColumn("_xx", F.when(~F.col("isStart"), F.col("distance") * F.col("distance")))
    )
    rows = split_by_position(features, MODEL_KEYS, F.unix_micros("eventTime"), part_rows)
    before = part_window(MODEL_KEYS, *rx.ride_order()).rowsBetween(Window.unboundedPreceding, -1)
    local = (
        rows.withColumn("_n", F.count("_xy").over(before))
        .withColumn("_sxy", F.sum("_xy").over(before))
        .withColumn("_sxx", F.sum("_xx").over(before))
        .filter("isStart")
    )
    learnt = with_carries(
        local,
        rows,
        MODEL_KEYS,
        {
            "_n0": Carry(F.count("_xy"), "sum"),
            "_sxy0": Carry(F.sum("_xy"), "sum"),
            "_sxx0": Carry(F.sum("_xx"), "sum"),
        },
    )

    def total(name: str) -> Column:
        return F.coalesce(name, F.lit(0)) + F.coalesce(f"{name}0", F.lit(0))

    return learnt.select(
        "rideId",
        predicted_minutes(total("_n"), total("_sxy"), total("_sxx"), F.col("distance")).alias(
            "prediction"
        ),
    )
